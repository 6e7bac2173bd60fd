"""Feature operators: group totals, shares, signed margin, position recode.

SURVEY §2.11 D1-D3 and §2.5 A1/A2.

Scale notes
-----------
``group_shares`` defaults to the aggregate-and-join form: the totals are a
partial (map-side combined) aggregation, so a contest holding a third of all
rows still reduces to one row per key before the shuffle; joining the small
totals back is either broadcast by AQE (when its measured size is under the
threshold) or a sort-merge join whose skewed partitions AQE splits. The window
form is kept as an option for inputs already clustered on the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql.window import WindowSpec
from pyspark.sql import functions as F

from ..functions.expr import col, safe_ratio
from ..schema import POSITION_DEFAULT, POSITION_GROUPS


def _total(c: str, null_policy: str, w: WindowSpec | None = None) -> Column:
    def over(e: Column) -> Column:
        return e.over(w) if w is not None else e

    s = over(F.sum(F.col(c)))
    if null_policy == "propagate":
        # R's sum() without na.rm: one missing value makes the total missing
        return F.when(over(F.count(F.col(c))) == over(F.count(F.lit(1))), s)
    if null_policy == "skip":
        return s
    raise ValueError(f"null_policy must be 'propagate' or 'skip', not {null_policy!r}")


def group_totals(df: DataFrame, keys: Sequence[str], stat_cols: Sequence[str],
                 prefix: str, null_policy: str = "propagate") -> DataFrame:
    """``group_by(keys) %>% summarise_at(stat_cols, sum)`` with prefixed names (A1, A2)."""
    return df.groupBy(*keys).agg(*[_total(c, null_policy).alias(prefix + c) for c in stat_cols])


def group_shares(df: DataFrame, keys: Sequence[str], stat_cols: Sequence[str],
                 total_prefix: str = "match_", share_prefix: str = "match_pct_",
                 null_policy: str = "propagate", method: str = "join",
                 keep_totals: bool = True) -> DataFrame:
    """Add ``<total_prefix>stat`` (group total) and ``<share_prefix>stat`` (row / total).

    A zero total gives a NULL share (N2). ``method='join'`` aggregates then
    joins back (skew-safe); ``method='window'`` uses window sums.
    """
    if method == "join":
        totals = group_totals(df, keys, stat_cols, total_prefix, null_policy)
        out = df.join(totals, on=list(keys), how="left")
    elif method == "window":
        w = Window.partitionBy(*keys)
        out = df.withColumns({total_prefix + c: _total(c, null_policy, w) for c in stat_cols})
    else:
        raise ValueError(f"method must be 'join' or 'window', not {method!r}")
    out = out.withColumns({share_prefix + c: safe_ratio(c, total_prefix + c) for c in stat_cols})
    if not keep_totals:
        out = out.drop(*[total_prefix + c for c in stat_cols])
    return out


def team_and_match_shares(df: DataFrame, contest: str, team: str, stat_cols: Sequence[str],
                          null_policy: str = "propagate", method: str = "join") -> DataFrame:
    """Both groupings of the cleaning step: per (contest, team) and per contest.

    The join form sums the rows once, per (contest, team); contest totals are
    sums of those, and the two small tables meet before one join to the rows.
    """
    if method == "window":
        out = group_shares(df, [contest, team], stat_cols, "team_", "team_pct_", null_policy, method)
        return group_shares(out, [contest], stat_cols, "match_", "match_pct_", null_policy, method)
    if method != "join":
        raise ValueError(f"method must be 'join' or 'window', not {method!r}")
    sums = df.groupBy(contest, team).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in stat_cols],
        *[F.count(c).alias(f"_k_{c}") for c in stat_cols])

    def kept(c: str) -> Column:
        if null_policy == "skip":
            return F.col(f"_s_{c}")
        if null_policy == "propagate":     # one missing value makes the total missing (N1)
            return F.when(F.col(f"_k_{c}") == F.col("_n"), F.col(f"_s_{c}"))
        raise ValueError(f"null_policy must be 'propagate' or 'skip', not {null_policy!r}")

    whole = sums.groupBy(contest).agg(F.sum("_n").alias("_n"), *[
        F.sum(f"{p}{c}").alias(f"{p}{c}") for c in stat_cols for p in ("_s_", "_k_")])
    whole = whole.select(F.col(contest).alias("_c"), *[kept(c).alias("match_" + c) for c in stat_cols])
    team_tot = sums.select(F.col(contest).alias("_tc"), F.col(team).alias("_tt"),
                           *[kept(c).alias("team_" + c) for c in stat_cols])
    totals = team_tot.join(whole, F.col("_tc").eqNullSafe(F.col("_c"))).drop("_c")
    out = df.join(totals, df[contest].eqNullSafe(F.col("_tc")) & df[team].eqNullSafe(F.col("_tt")), "left")
    out = out.drop("_tc", "_tt").withColumns(
        {f"{p}_pct_{c}": safe_ratio(c, f"{p}_{c}") for p in ("team", "match") for c in stat_cols})
    order = [f"{p}_{x}{c}" for p in ("team", "match") for x in ("", "pct_") for c in stat_cols]
    return out.select(*df.columns, *order)


def signed_margin(winner: str | Column, team: str | Column, margin: str | Column) -> Column:
    """Margin, positive on the winner's rows and negated elsewhere.

    A missing winner or team gives a missing result, as R's ``ifelse`` does.
    """
    won = col(winner) == col(team)
    m = col(margin)
    return F.when(won, m).when(~won, -m)


def recode(c: str | Column, groups: Sequence[tuple[str, Sequence[str]]],
           default: str) -> Column:
    """``case_when(x %in% codes ~ group, ..., TRUE ~ default)`` (F10); NULL -> default."""
    x = col(c)
    expr = None
    for label, codes in groups:
        cond = x.isin(list(codes))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def recode_position(c: str | Column,
                    groups: Sequence[tuple[str, Sequence[str]]] = POSITION_GROUPS,
                    default: str = POSITION_DEFAULT) -> Column:
    """Position code -> KEYFWD / BENCH / KEYBCK / RUCK / GENERAL (D3)."""
    return recode(c, groups, default)


def add_match_features(df: DataFrame, contest: str, team: str, winner: str, margin: str,
                       position: str, stat_cols: Sequence[str],
                       position_groups: Sequence[tuple[str, Sequence[str]]] = POSITION_GROUPS,
                       null_policy: str = "propagate", method: str = "join") -> DataFrame:
    """The whole cleaning step: shares for both groupings, signed margin, position group."""
    out = team_and_match_shares(df, contest, team, stat_cols, null_policy, method)
    return out.withColumns({
        "team_result": signed_margin(winner, team, margin),
        "player_position_cln": recode_position(position, position_groups),
    })
