"""Report tables: the data behind the three published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import half_even, percent_text


def report_board(board: DataFrame, name: str = "name") -> DataFrame:
    """Round board with ``Player`` heading, largest ``Total`` first."""
    return board.withColumnRenamed(name, "Player").orderBy(F.desc("Total"), F.col("Player"))


def report_contenders(summary: DataFrame, min_win: float = 0.001,
                      name: str = "name") -> DataFrame:
    """Names whose win rate exceeds ``min_win``, formatted."""
    return (summary.filter(F.col("win_perc") > F.lit(min_win))
            .orderBy(F.desc("win_perc"), F.col(name))
            .select(F.col(name).alias("Name"), F.col("p05").alias("P05"),
                    F.col("mdn_votes").alias("Median"), half_even("p95", 0).alias("P95"),
                    percent_text("win_perc").alias("Win_pct")))


def report_teams(team_table: DataFrame, team: str = "player_team", name: str = "name",
                 by: str = "mdn_votes") -> DataFrame:
    """Best names per team, team ascending, votes descending."""
    return (team_table.select(F.col(team).alias("Team"), F.col(name).alias("Name"),
                              F.col(by).alias("Votes"))
            .orderBy(F.col("Team"), F.desc("Votes"), F.col("Name")))


def team_counts(team_table: DataFrame, team: str = "player_team") -> DataFrame:
    """Rows per team: the grouping index of the team report."""
    return team_table.groupBy(team).agg(F.count(F.lit(1)).alias("n"))


def metrics_table(metrics: DataFrame, digits: int = 2) -> DataFrame:
    """Long ``(metric, estimate, estimate_text)``: rounded half-even and printed
    with thousands separators (X14, X7)."""
    long = metrics.unpivot([], list(metrics.columns), "metric", "estimate")
    r = half_even("estimate", digits)
    return long.select("metric", r.alias("estimate"), F.format_number(r, digits)
                       .alias("estimate_text"))
