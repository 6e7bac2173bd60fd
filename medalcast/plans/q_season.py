"""Queries: simulated seasons and their summaries.

The season scorer runs on the regular-stage rows of the whole table with the
stand-in 3-vote curve, ``SIMS`` simulated seasons (the original back-test
count) and 3 votes per contest.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.calibrate import apply_curves
from ..operators.report import report_board, report_contenders, report_teams, team_counts
from ..operators.sampling import MASKS, modal_podiums, packed_sims, sample_votes, season_tables, season_totals
from ..operators.summary import (SKETCH_ERROR, merge_sketches, podium_long, round_leaderboard, sketch_quantiles, sketch_totals,
                                 split_podium, summarise_totals, team_top_k, top_names)
from ..schema import SIMS_BACKTEST, TOP_BOARD, TOP_PER_TEAM
from ..session import cut_lineage
from ..sources.standin import SEED, STANDIN_CURVES, scored
from .base_sql import BASE, weight_sql
from .registry import hash32_sql, races_sql, register

SIMS = SIMS_BACKTEST


def season_rows(spark, d):
    """Regular-stage scored rows with the 3-vote probability."""
    return apply_curves(scored(spark, d, regular_only=True), "score", STANDIN_CURVES, ["v3"])


_DRAW = ("contest_id", "name", "v3_prob", SIMS, 3, SEED)
ROUNDS = ["1", "2", "3", "4", "5"]     # the regular stages


def season_samples(spark, d):
    """The vote table, packed: simulations of a (contest_id, name, votes) as bits."""
    return sample_votes(season_rows(spark, d), *_DRAW, packed=True)


def season_summary(spark, d, denominator: str = "appearances", rows=None):
    rows = season_rows(spark, d) if rows is None else rows
    return summarise_totals(season_totals(rows, *_DRAW), SIMS, denominator)


def season_podium(spark, d, rows=None):
    """The most frequent podium of each contest, with its places."""
    return modal_podiums(season_rows(spark, d) if rows is None else rows, *_DRAW)


def _round6(df, cols=("p05", "mdn_votes", "p95")):
    return df.withColumns({c: F.round(c, 6) for c in cols})


# ---- oracle side -----------------------------------------------------------------------

def r6(x: str) -> str:
    return f"cast(round(cast(cast({x} as varchar) as decimal(38, 18)), 6) as double)"


def r_even(x: str, digits: int) -> str:
    return f"cast(round_even(cast(cast({x} as varchar) as decimal(38, 18)), {digits}) as double)"


SEASON = BASE.rstrip() + f""",
season_rows as (select * from probs where regexp_matches(stage, '^[0-9]')),
weights as (
  select contest_id, name, sum(w) as weight
  from (select contest_id, name, {weight_sql('v3_prob')} as w from season_rows)
  where w > 0 group by contest_id, name
),
samples as (
  select sim, contest_id, name, cast(4 - rn_ as bigint) as votes from (
    select sim, contest_id, name,
           row_number() over (partition by contest_id, sim order by key_, name) rn_
    from ({races_sql(f"""(select *, {hash32_sql(str(SEED), 'contest_id', 'name')} as a_,
                          {hash32_sql(str(SEED), 'contest_id', 'name', word=1)} as b_ from weights)""", SIMS)}))
  where rn_ <= 3
),
totals as (
  select name, sim, cast(sum(votes) as bigint) as total_votes from samples group by name, sim
),
wins as (
  select t.*, cast(t.total_votes = b.best as bigint) as win
  from totals t join (select sim, max(total_votes) best from totals group by sim) b using (sim)
),
summary as (
  select name, quantile_cont(total_votes, 0.05) p05, quantile_cont(total_votes, 0.5) mdn_votes,
         quantile_cont(total_votes, 0.95) p95, sum(win)::double / count(*)::double as win_perc
  from wins group by name
),
summary_all as (
  select name, quantile_cont(tv, 0.05) p05, quantile_cont(tv, 0.5) mdn_votes,
         quantile_cont(tv, 0.95) p95, sum(wn)::double / {float(SIMS)!r} as win_perc
  from (select n.name, s.sim, coalesce(w.total_votes, 0) tv, coalesce(w.win, 0) wn
        from (select distinct name from wins) n
        cross join (select range::bigint as sim from range(1, {SIMS + 1})) s
        left join wins w on w.name = n.name and w.sim = s.sim)
  group by name
),
podium as (
  select contest_id, combo321 from (
    select contest_id, combo321,
           row_number() over (partition by contest_id order by n desc, combo321) rn_
    from (select contest_id, combo321, count(*) n from (
            select contest_id, sim, string_agg(name, ' > ' order by votes desc) combo321
            from samples group by contest_id, sim) group by contest_id, combo321))
  where rn_ = 1
),
podium_long as (
  select contest_id, votes, name from (
    select contest_id, cast(3 as integer) votes, string_split_regex(combo321, '\\s>\\s')[1] name from podium
    union all
    select contest_id, cast(2 as integer), string_split_regex(combo321, '\\s>\\s')[2] from podium
    union all
    select contest_id, cast(1 as integer), string_split_regex(combo321, '\\s>\\s')[3] from podium)
),
top20 as (select name from summary order by mdn_votes desc, name limit {TOP_BOARD}),
cells as (
  select l.name, r.stage, max(l.votes) votes
  from podium_long l join (select distinct contest_id, stage from season_rows) r using (contest_id)
  where l.name in (select name from top20) group by l.name, r.stage
),
grid as (
  select p.name, p.stage, coalesce(cast(c.votes as varchar), '0') votes
  from (select distinct name, stage from season_rows where name in (select name from top20)) p
  left join cells c on c.name = p.name and c.stage = p.stage
),
board as (
  select g.name,
         {", ".join(f"coalesce(max(case when stage = '{r}' then votes end), '-') as R{r}" for r in range(1, 6))},
         s.mdn_votes as Total
  from grid g join summary s using (name) group by g.name, s.mdn_votes
),
players_club as (select distinct entity_id as player_id, name, club as player_team from season_rows),
players_team as (select distinct entity_id as player_id, name, team as player_team from season_rows),
team_top as (
  select * from (
    select s.*, p.player_id, p.player_team,
           row_number() over (partition by p.player_team order by s.mdn_votes desc, s.name, p.player_id) as rank
    from summary s left join players_club p using (name))
  where rank <= {TOP_PER_TEAM}
),
team_top_fan as (
  select * from (
    select s.*, p.player_id, p.player_team,
           row_number() over (partition by p.player_team order by s.mdn_votes desc, s.name, p.player_id) as rank
    from summary s left join players_team p using (name))
  where rank <= {TOP_PER_TEAM}
)
"""


# ---- queries ----------------------------------------------------------------------------

@register("sample_votes", SEASON + """
select contest_id, name, votes, cast(count(*) as bigint) as n_sims from samples
group by contest_id, name, votes
""")
def sample_votes_q(spark, d):
    return season_samples(spark, d).groupBy("contest_id", "name", "votes") \
        .agg(F.sum(packed_sims()).alias("n_sims"))


@register("sample_exclusion", SEASON + """
select contest_id, cast(count(*) as bigint) as draws,
       cast(count(distinct (sim, name)) as bigint) as distinct_draws,
       cast(count(distinct sim) as bigint) as sims
from samples group by contest_id
""")
def sample_exclusion(spark, d):
    block = season_samples(spark, d).groupBy("contest_id", "name", "sim").agg(
        F.sum(packed_sims()).alias("draws"), *[F.bit_or(m).alias(m) for m in MASKS])
    named = F.when(F.col("name").isNotNull(), packed_sims()).otherwise(F.lit(0))      # a missing name is no distinct draw
    per = block.groupBy("contest_id", "sim").agg(
        F.sum("draws").alias("draws"), F.sum(named).alias("distinct_draws"), *[F.bit_or(m).alias(m) for m in MASKS])
    return per.groupBy("contest_id").agg(
        F.sum("draws").alias("draws"), F.sum("distinct_draws").alias("distinct_draws"), F.sum(packed_sims()).alias("sims"))


@register("sim_summary", SEASON + f"""
select name, {r6('p05')} p05, {r6('mdn_votes')} mdn_votes, {r6('p95')} p95, win_perc from summary
""")
def sim_summary_q(spark, d):
    return _round6(season_summary(spark, d))


@register("sim_summary_all_sims", SEASON + f"""
select name, {r6('p05')} p05, {r6('mdn_votes')} mdn_votes, {r6('p95')} p95, win_perc
from summary_all
""")
def sim_summary_all_sims(spark, d):
    return _round6(season_summary(spark, d, "all_sims"))


@register("approx_quantiles", SEASON + """
select name, cast(count(*) as bigint) as n, true as p05_ok, true as mdn_ok, true as p95_ok from totals group by name
""")
def approx_quantiles(spark, d):
    """Quantile sketches of batches of simulations, merged; whether each quantile's true rank is within the error bound.

    A value's rank runs from the share of totals below it to the share up to it.
    """
    totals = cut_lineage(season_totals(season_rows(spark, d), *_DRAW), "totals")
    got = sketch_quantiles(merge_sketches(sketch_totals(totals, batch=SIMS // 5)))
    both = totals.join(got.drop("sketch"), "name")
    n = F.count(F.lit(1))

    def near(q, p):
        return ((F.count_if(F.col("total_votes") < F.col(q)) / n <= p + SKETCH_ERROR)
                & (F.count_if(F.col("total_votes") <= F.col(q)) / n >= p - SKETCH_ERROR))
    return both.groupBy("name").agg(n.alias("n"), near("p05", 0.05).alias("p05_ok"), near("mdn_votes", 0.5).alias("mdn_ok"), near("p95", 0.95).alias("p95_ok"))


@register("likely_podium", SEASON + "select contest_id, combo321 from podium")
def likely_podium(spark, d):
    return season_podium(spark, d).select("contest_id", F.col("combo").alias("combo321"))


@register("podium_split_long", SEASON + "select contest_id, votes, name from podium_long")
def podium_split_long(spark, d):
    text = season_podium(spark, d).select("contest_id", F.col("combo").alias("combo321"))
    return podium_long(split_podium(text), ["contest_id"])


@register("top_names", SEASON + "select name from top20")
def top_names_q(spark, d):
    return top_names(season_summary(spark, d), TOP_BOARD)


def _board(spark, d):
    """One scan and one pass over the races: the rows and the summed draws are written, and read from there."""
    rows = cut_lineage(season_rows(spark, d).select("contest_id", "stage", "name", "v3_prob"), "season-rows")
    totals, podium = season_tables(rows, *_DRAW)
    return round_leaderboard(summarise_totals(totals, SIMS), podium, rows, "contest_id", "stage", "name", TOP_BOARD, rounds=ROUNDS)


@register("round_leaderboard", SEASON + "select * from board")
def round_leaderboard_q(spark, d):
    return _board(spark, d)


def _players(rows, team_col):
    return rows.select(F.col("entity_id").alias("player_id"), "name",
                       F.col(team_col).alias("player_team"))


def _team_table(spark, d, team_col, round_first=False):
    rows = cut_lineage(season_rows(spark, d).select("contest_id", "name", "v3_prob", "entity_id", team_col), "season-rows")
    summary = season_summary(spark, d, rows=rows)
    if round_first:
        summary = _round6(summary)
    return team_top_k(summary, _players(rows, team_col), k=TOP_PER_TEAM)


_TEAM_COLS = ("name, {p05} p05, {mdn} mdn_votes, {p95} p95, win_perc, player_id, "
              "player_team, rank").format(p05=r6("p05"), mdn=r6("mdn_votes"), p95=r6("p95"))


@register("team_top_k", SEASON + f"select {_TEAM_COLS} from team_top")
def team_top_k_q(spark, d):
    return _round6(_team_table(spark, d, "club"))


@register("team_top_k_fanout", SEASON + f"select {_TEAM_COLS} from team_top_fan")
def team_top_k_fanout(spark, d):
    return _round6(_team_table(spark, d, "team"))


@register("team_counts", SEASON + """
select player_team, cast(count(*) as bigint) as n from team_top group by player_team
""")
def team_counts_q(spark, d):
    return team_counts(_team_table(spark, d, "club"))


@register("report_board", SEASON + """
select name as Player, R1, R2, R3, R4, R5, Total from board
""")
def report_board_q(spark, d):
    return report_board(_board(spark, d))


@register("report_contenders", SEASON + f"""
select name as Name, {r6('p05')} as P05, {r6('mdn_votes')} as Median,
       {r_even(r6('p95'), 0)} as P95,
       printf('%.2f%%', {r_even('win_perc', 4)} * 100.0) as Win_pct
from summary where win_perc > 0.001
""")
def report_contenders_q(spark, d):
    s = _round6(season_summary(spark, d))
    return report_contenders(s)


@register("report_teams", SEASON + f"""
select player_team as Team, name as Name, {r6('mdn_votes')} as Votes from team_top
""")
def report_teams_q(spark, d):
    return report_teams(_team_table(spark, d, "club", round_first=True))
