"""Spark vs DuckDB on the smallest driver tables for a cross-section of queries,
plus the entry() smoke check. The full sweep is ``tools/oracle_check.py``."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

from conftest import SF_SMALL  # noqa: E402
from oracle_check import TABLES, compare  # noqa: E402

import __spark_entry__ as E  # noqa: E402

SAMPLE = ["season_extract", "match_features", "group_share_contest_window", "award_votes",
          "season_leaders", "recall_all", "calibration_counts", "add_anchor_row",
          "probability_long", "sample_votes", "sim_summary_all_sims", "round_leaderboard",
          "team_top_k_fanout", "report_contenders", "latest_version", "stratified_split",
          "pool_rare_levels", "near_zero_variance", "dense_row_id"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert "error" not in r, r
    assert r["exact"], r


def test_every_query_has_a_callable_and_sql_names_exist():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["season", "name", "medal_tally"]
    assert df.count() > 0
