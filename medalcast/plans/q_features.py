"""Queries: extract, filters, ids, totals, shares, margin, position (S1, F1, P*, A1-A2, D1-D3)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.expr import starts_with_digit
from ..operators.features import (add_match_features, group_shares, group_totals,
                                  recode_position, signed_margin)
from ..operators.rows import dense_row_id
from ..sources.standin import LABEL_ORDER, ROW_KEY, STANDIN_POSITION_GROUPS, STAT_COLS, fact, fact_partitions
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources.tables import load, load_seasons, save, save_bucketed, save_seasons, season_range
from .base_sql import BASE
from .registry import register

K = ", ".join(ROW_KEY)


def _sum_sql(c: str, prefix: str) -> str:
    return (f"cast(case when count({c}) = count(*) then sum({c}) end as bigint) as {prefix}{c}")


def _share_sql(c: str, tot: str) -> str:
    return f"{c}::double / nullif({tot}, 0)::double"


@register("season_extract", BASE + """
select * from fact where cast(season as integer) between 1995 and 1997
""")
def season_extract(spark, d):
    return season_range(fact(spark, d), "season", 1995, 1997)


@register("seasons_saved", BASE + """
select * from fact where cast(season as integer) between 1995 and 1997
""")
def seasons_saved(spark, d):
    """The table saved by season and a range of seasons reread; only their folders are scanned."""
    path = os.path.join(ensure_checkpoint_dir(spark), "seasons-" + uuid.uuid4().hex)
    f = fact(spark, d)
    save(f, path, ["season"])
    back = load_seasons(spark, path, 1995, 1997)
    return back.select(*[F.col(x.name).cast(x.dataType) for x in f.schema.fields])


@register("season_refreshed", BASE + """
select season, cast(count(*) as bigint) as n, cast(sum(qty + case when season = '1997' then 1 else 0 end) as bigint) as qty, cast(sum(cents) as bigint) as cents
from fact where season <> '1998' or stage <> 'FINAL' group by season
""")
def season_refreshed(spark, d):
    """All seasons saved, then two of them again (one changed, one with fewer rows); the others' folders stay."""
    path = os.path.join(ensure_checkpoint_dir(spark), "seasons-" + uuid.uuid4().hex)
    f = fact(spark, d)
    save_seasons(f, path)
    save_seasons(f.filter("season in ('1997', '1998')").filter("season <> '1998' or stage <> 'FINAL'")
                 .withColumn("qty", F.col("qty") + F.when(F.col("season") == "1997", 1).otherwise(0)), path)
    return load(spark, path).groupBy(F.col("season").cast("string").alias("season")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty"), F.sum("cents").alias("cents"))


@register("positional_block", BASE + "select ln, pk, entity_id, contest_date from fact")
def positional_block_q(spark, d):
    f = fact(spark, d)
    return f.select(*C.positional_block(f, 2, 5))


@register("nominal_columns", BASE + "select season, stage, team, winner, name, club, pos from fact")
def nominal_columns_q(spark, d):
    f = fact(spark, d)
    return f.select(*C.nominal_columns(f))


@register("regular_stage_rows", BASE + """
select * from fact where regexp_matches(stage, '^[0-9]')
""")
def regular_stage_rows(spark, d):
    return fact(spark, d).filter(starts_with_digit("stage"))


@register("dense_row_id", BASE + f"""
select cast(row_number() over (order by {K}) as bigint) as id, {K}
from fact where regexp_matches(stage, '^[0-9]')
""")
def dense_row_id_q(spark, d):
    f = fact(spark, d).filter(starts_with_digit("stage")).select(*ROW_KEY)
    return dense_row_id(f, ROW_KEY)


_WIDE_ORDER = ["contest_id", *LABEL_ORDER]


@register("dense_row_id_wide", BASE + f"""
select cast(row_number() over (order by {", ".join(_WIDE_ORDER)}) as bigint) as id, * from fact
""")
def dense_row_id_wide(spark, d):
    """Ids on whole rows: every column is carried; the rows are written once, so that the joins run (and shuffle) once."""
    return dense_row_id(cut_lineage(fact(spark, d), "wide-rows"), _WIDE_ORDER)


@register("feature_select_dedup", BASE + """
select contest_id, qty, cents, tax, qty_share from (
  select contest_id, qty, cents, tax, qty::double / nullif(sum(qty) over (partition by contest_id), 0)::double qty_share
  from fact)
""")
def feature_select_dedup(spark, d):
    f = group_shares(fact(spark, d), ["contest_id"], ["qty"], "tot_", "share_", keep_totals=False)
    f = f.withColumnRenamed("share_qty", "qty_share")
    # the variable list repeats a name, as the original feature list does
    return C.select_unique(f, ["contest_id", "qty", "cents", "qty", "tax", "qty_share"])


@register("prefix_select", BASE + f"""
select {K}, t.team_qty, t.team_cents, t.team_disc, t.team_tax, t.team_psize
from fact join (select contest_id, team, {", ".join(_sum_sql(c, "team_") for c in STAT_COLS)}
                from fact group by contest_id, team) t using (contest_id, team)
""")
def prefix_select(spark, d):
    f = group_shares(fact(spark, d), ["contest_id", "team"], STAT_COLS, "team_", "team_pct_")
    return f.select(*ROW_KEY, *[c for c in C.with_prefix(f, "team_")
                                if not c.startswith("team_pct_")])


@register("name_range_select", BASE + """
select contest_id, ln, pk, entity_id, contest_date, season, stage, team from fact
""")
def name_range_select(spark, d):
    f = fact(spark, d)
    return f.select(*C.name_range(f, "contest_id", "team"))


@register("bulk_rename", BASE + """
select contest_id as match_id, entity_id as player_id, name as player_name, team as player_team,
       stage as match_round, qty as stat_qty, cents as stat_cents, disc as stat_disc,
       tax as stat_tax, psize as stat_psize
from fact
""")
def bulk_rename(spark, d):
    f = fact(spark, d).select("contest_id", "entity_id", "name", "team", "stage", *STAT_COLS)
    f = C.bulk_rename(f, {"contest_id": "match_id", "entity_id": "player_id",
                          "name": "player_name", "team": "player_team", "stage": "match_round"})
    return C.prefix_rename(f, STAT_COLS, "stat_")


@register("team_totals", BASE + f"""
select contest_id, team, {", ".join(_sum_sql(c, "team_") for c in STAT_COLS)}
from fact group by contest_id, team
""")
def team_totals(spark, d):
    return group_totals(fact(spark, d), ["contest_id", "team"], STAT_COLS, "team_")


@register("contest_totals", BASE + f"""
select contest_id, {", ".join(_sum_sql(c, "match_") for c in STAT_COLS)}
from fact group by contest_id
""")
def contest_totals(spark, d):
    return group_totals(fact(spark, d), ["contest_id"], STAT_COLS, "match_")


@register("totals_null_propagate", BASE + """
select contest_id,
       cast(case when count(d) = count(*) then sum(d) end as bigint) as match_disc_propagate,
       cast(sum(d) as bigint) as match_disc_skip
from (select contest_id, nullif(disc, 0) d from fact) group by contest_id
""")
def totals_null_propagate(spark, d):
    f = fact(spark, d).select("contest_id", F.nullif(F.col("disc"), F.lit(0)).alias("disc"))
    a = group_totals(f, ["contest_id"], ["disc"], "match_", "propagate") \
        .withColumnRenamed("match_disc", "match_disc_propagate")
    b = group_totals(f, ["contest_id"], ["disc"], "match_", "skip") \
        .withColumnRenamed("match_disc", "match_disc_skip")
    return a.join(b, "contest_id")


def _share_query_sql(keys: str, tprefix: str, sprefix: str, window: bool = False) -> str:
    tot = ", ".join(_sum_sql(c, tprefix) for c in STAT_COLS)
    shares = ", ".join(f"{_share_sql(c, tprefix + c)} as {sprefix}{c}" for c in STAT_COLS)
    tots = ", ".join(tprefix + c for c in STAT_COLS)
    return BASE + f"""
select {K}, {tots}, {shares}
from fact join (select {keys}, {tot} from fact group by {keys}) t using ({keys})
"""


@register("group_share_team", _share_query_sql("contest_id, team", "team_", "team_pct_"))
def group_share_team(spark, d):
    f = group_shares(fact(spark, d), ["contest_id", "team"], STAT_COLS, "team_", "team_pct_")
    return f.select(*ROW_KEY, *["team_" + c for c in STAT_COLS],
                    *["team_pct_" + c for c in STAT_COLS])


@register("group_share_contest", _share_query_sql("contest_id", "match_", "match_pct_"))
def group_share_contest(spark, d):
    f = group_shares(fact(spark, d), ["contest_id"], STAT_COLS, "match_", "match_pct_")
    return f.select(*ROW_KEY, *["match_" + c for c in STAT_COLS],
                    *["match_pct_" + c for c in STAT_COLS])


@register("group_share_contest_window", _share_query_sql("contest_id", "match_", "match_pct_"))
def group_share_contest_window(spark, d):
    f = group_shares(fact(spark, d), ["contest_id"], STAT_COLS, "match_", "match_pct_",
                     method="window")
    return f.select(*ROW_KEY, *["match_" + c for c in STAT_COLS],
                    *["match_pct_" + c for c in STAT_COLS])


@register("signed_margin", BASE + f"""
select {K}, margin, case when winner = team then margin when winner <> team then -margin end
       as team_result
from fact
""")
def signed_margin_q(spark, d):
    f = fact(spark, d)
    return f.select(*ROW_KEY, "margin", signed_margin("winner", "team", "margin")
                    .alias("team_result"))


_POS_SQL = " ".join(f"when pos in ({', '.join(repr(c) for c in codes)}) then '{g}'"
                    for g, codes in STANDIN_POSITION_GROUPS)


@register("recode_position", BASE + f"""
select {K}, pos, case {_POS_SQL} else 'GENERAL' end as player_position_cln from fact
""")
def recode_position_q(spark, d):
    f = fact(spark, d)
    return f.select(*ROW_KEY, "pos", recode_position("pos", STANDIN_POSITION_GROUPS)
                    .alias("player_position_cln"))


_REG = "(select * from fact where regexp_matches(stage, '^[0-9]'))"


_FEATURES_SQL = BASE + f"""
select {K},
       {", ".join(f"{_share_sql(c, 'tt.team_' + c)} as team_pct_{c}" for c in STAT_COLS)},
       {", ".join(f"{_share_sql(c, 'mt.match_' + c)} as match_pct_{c}" for c in STAT_COLS)},
       case when winner = team then margin when winner <> team then -margin end as team_result,
       case {_POS_SQL} else 'GENERAL' end as player_position_cln
from {_REG} f
  join (select contest_id, team, {", ".join(_sum_sql(c, "team_") for c in STAT_COLS)}
        from {_REG} r group by contest_id, team) tt using (contest_id, team)
  join (select contest_id, {", ".join(_sum_sql(c, "match_") for c in STAT_COLS)}
        from {_REG} r group by contest_id) mt using (contest_id)
"""


@register("match_features", _FEATURES_SQL)
def match_features(spark, d):
    f = fact(spark, d).filter(starts_with_digit("stage"))
    return _features(f, "join")


def _features(f, method):
    out = add_match_features(f, "contest_id", "team", "winner", "margin", "pos", STAT_COLS,
                             STANDIN_POSITION_GROUPS, method=method)
    return out.select(*ROW_KEY, *["team_pct_" + c for c in STAT_COLS],
                      *["match_pct_" + c for c in STAT_COLS], "team_result",
                      "player_position_cln")


BUCKETS = 16        # at least; a larger table gets more, so that a bucket, which is one task, stays bounded


def bucketed_fact(spark, d):
    """The fact rows as a table bucketed and sorted by contest, in the shared folder; the catalogue holds its name."""
    tag = uuid.uuid4().hex
    buckets = max(BUCKETS, fact_partitions(spark, d))
    return save_bucketed(fact(spark, d), f"fact_{tag}", os.path.join(ensure_checkpoint_dir(spark), "fact-" + tag), ["contest_id"], buckets)


@register("match_features_bucketed", _FEATURES_SQL)
def match_features_bucketed(spark, d):
    """The cleaning step over a bucketed table: its two window sums need no exchange."""
    return _features(bucketed_fact(spark, d).filter(starts_with_digit("stage")), "window")
