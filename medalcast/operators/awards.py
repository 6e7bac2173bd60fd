"""3-2-1 awards, tallies, accuracy and fit metrics.

Scale notes
-----------
``award_votes`` is a ``row_number() <= k`` filter over a per-contest window.
Catalyst turns that into ``WindowGroupLimit`` on both sides of the shuffle, so
each map task keeps only its top k rows per contest before anything moves:
a contest with a third of the rows costs one local sort, not a giant shuffle
partition. The second window (reverse rank) runs on at most k rows per contest
and reuses the same partitioning.

Group maxima with ties (``season_leaders``) are a partial aggregation joined
back on the group key instead of a window over the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import col, no_nan, row_uniform, safe_ratio


def top_k_ranked(df: DataFrame, partition: Sequence[str], order: Sequence[Column], k: int,
                 rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k within each partition group."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def award_votes(df: DataFrame, contest: str, score: str, tie_keys: Sequence[str],
                k: int = 3, seed: int = 0, votes_col: str = "votes",
                order: Sequence[Column] | None = None, keep_rank: bool = False) -> DataFrame:
    """Award k, k-1, ..., 1 votes per contest by descending score.

    Ties are broken by a uniform number keyed on ``(seed, tie_keys)`` and then by
    the keys themselves, so the result is random-looking but repeatable. A
    contest with m < k scored rows awards m, ..., 1 (``least(k, rows) + 1 - rank``).
    A row whose score is NULL or NaN gets no award and doesn't count.
    Only awarded rows are returned.
    """
    df = df.filter(no_nan(score).isNotNull())
    if order is None:
        order = [col(score).desc_nulls_last(), row_uniform(F.lit(seed), *tie_keys),
                 *[F.col(c) for c in tie_keys]]
    top = top_k_ranked(df, [contest], order, k, "_rank")
    survivors = F.count(F.lit(1)).over(Window.partitionBy(contest))
    out = top.withColumn(votes_col, (survivors + 1 - F.col("_rank")).cast("bigint"))
    return out.withColumnRenamed("_rank", "rank") if keep_rank else out.drop("_rank")


def tally(votes: DataFrame, keys: Sequence[str], votes_col: str = "votes",
          out: str = "medal_tally") -> DataFrame:
    """Sum of votes per key (A5)."""
    return votes.groupBy(*keys).agg(F.sum(votes_col).cast("bigint").alias(out))


def keep_group_max(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """``group_by(g) %>% filter(x == max(x))`` with ties kept."""
    best = df.groupBy(*group).agg(F.max(value).alias("_best"))
    return df.join(best, on=list(group), how="inner").filter(F.col(value) == F.col("_best")) \
        .drop("_best")


def season_leaders(votes: DataFrame, season: str = "season", name: str = "name",
                   votes_col: str = "votes") -> DataFrame:
    """Tally per (season, name) and keep each season's leader(s)."""
    return keep_group_max(tally(votes, [season, name], votes_col), [season], "medal_tally")


def season_tally_one(votes: DataFrame, season_value, season: str = "season",
                     name: str = "name", votes_col: str = "votes") -> DataFrame:
    """One season's tally per name, largest first (D5 single-season variant)."""
    one = votes.filter(F.col(season) == F.lit(season_value))
    return tally(one, [name], votes_col).orderBy(F.desc("medal_tally"), F.col(name))


def entity_history(votes: DataFrame, name_value, season: str = "season", name: str = "name",
                   votes_col: str = "votes") -> DataFrame:
    """One player's tally per season (D5 single-player variant)."""
    one = votes.filter(F.col(name) == F.lit(name_value))
    return season_leaders(one, season, name, votes_col)


def tally_comparison(awarded: DataFrame, full: DataFrame, season: str = "season",
                     name: str = "name", votes_col: str = "votes",
                     true_col: str = "true_votes", before: int = 2022) -> DataFrame:
    """Predicted vs actual season tallies with ``error = actual - predicted``."""
    pred = tally(awarded, [season, name], votes_col, "medal_tally")
    actual = tally(full, [season, name], true_col, "actual_tally")
    return (pred.join(actual, on=[season, name], how="left")
            .filter(F.col(season).try_cast("int") < F.lit(before))
            .withColumn("error", F.col("actual_tally") - F.col("medal_tally")))


def _hit(kind: str, votes: Column, truth: Column) -> tuple[Column, Column]:
    if kind == "exact":
        return (votes == 3) & (truth == 3), truth == 3
    if kind == "any":
        return (votes > 0) & (truth > 0), truth > 0
    raise ValueError(f"kind must be 'exact' or 'any', not {kind!r}")


def vote_accuracy(awarded: DataFrame, by: Sequence[str], kind: str = "exact",
                  scope: str = "predicted", full: DataFrame | None = None,
                  votes_col: str = "votes", true_col: str = "true_votes") -> DataFrame:
    """Share of true vote-getters that the award also picked.

    ``scope='predicted'`` counts true votes among awarded rows only (the
    original behaviour); ``scope='all'`` divides by every true vote-getter in
    ``full`` (true recall).
    """
    hit, truth = _hit(kind, F.col(votes_col), F.col(true_col))
    num = awarded.groupBy(*by).agg(F.count_if(hit).alias("_hits"),
                                   F.count_if(truth).alias("_den"))
    if scope == "all":
        if full is None:
            raise ValueError("scope='all' needs the full table")
        den = full.groupBy(*by).agg(F.count_if(F.col(true_col) == 3 if kind == "exact"
                                               else F.col(true_col) > 0).alias("_den"))
        num = num.drop("_den").join(den, on=list(by), how="right") \
            .withColumn("_hits", F.coalesce(F.col("_hits"), F.lit(0)))
    elif scope != "predicted":
        raise ValueError(f"scope must be 'predicted' or 'all', not {scope!r}")
    return num.select(*by, safe_ratio("_hits", "_den").alias("percentage_correct"))


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """rmse, rsq (squared Pearson correlation) and mae in one pass."""
    err = F.col(label).cast("double") - F.col(pred).cast("double")
    return df.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.pow(F.corr(F.col(label).cast("double"), F.col(pred).cast("double")), 2).alias("rsq"),
        F.avg(F.abs(err)).alias("mae"),
    )
