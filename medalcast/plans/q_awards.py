"""Queries: 3-2-1 awards, tallies, accuracy, fit metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.awards import (entity_history, regression_metrics, season_leaders,
                                season_tally_one, tally_comparison, vote_accuracy)
from ..operators.report import metrics_table
from ..sources.standin import ROW_KEY, awarded, scored
from .base_sql import BASE
from .registry import register

K = ", ".join(ROW_KEY)
AWARD_COLS = [*ROW_KEY, "season", "name", "score", "true_votes", "votes"]
ONE_SEASON = "1997"
ONE_NAME = "Supplier#000000007"


@register("award_votes", BASE + f"""
select {", ".join(AWARD_COLS)} from awarded
""")
def award_votes_q(spark, d):
    return awarded(spark, d).select(*AWARD_COLS)


@register("award_small_contests", BASE + f"""
select {", ".join(AWARD_COLS)} from awarded
where contest_id in (select contest_id from scored group by contest_id having count(*) < 3)
""")
def award_small_contests(spark, d):
    small = scored(spark, d).groupBy("contest_id").count().filter(F.col("count") < 3)
    return awarded(spark, d).join(small.select("contest_id"), "contest_id", "left_semi") \
        .select(*AWARD_COLS)


_TALLY = "(select season, name, cast(sum(votes) as bigint) medal_tally from awarded group by season, name)"


@register("season_leaders", BASE + f"""
select season, name, medal_tally from (
  select *, max(medal_tally) over (partition by season) best_ from {_TALLY})
where medal_tally = best_
""")
def season_leaders_q(spark, d):
    return season_leaders(awarded(spark, d), "season", "name", "votes")


@register("season_tally_one", BASE + f"""
select name, cast(sum(votes) as bigint) medal_tally from awarded where season = '{ONE_SEASON}'
group by name
""")
def season_tally_one_q(spark, d):
    return season_tally_one(awarded(spark, d), ONE_SEASON)


@register("entity_history", BASE + f"""
select season, name, medal_tally from (
  select *, max(medal_tally) over (partition by season) best_ from
    (select season, name, cast(sum(votes) as bigint) medal_tally from awarded
     where name = '{ONE_NAME}' group by season, name))
where medal_tally = best_
""")
def entity_history_q(spark, d):
    return entity_history(awarded(spark, d), ONE_NAME)


@register("tally_comparison", BASE + """
select p.season, p.name, p.medal_tally, a.actual_tally, a.actual_tally - p.medal_tally as error
from (select season, name, cast(sum(votes) as bigint) medal_tally from awarded group by 1, 2) p
left join (select season, name, cast(sum(true_votes) as bigint) actual_tally from scored
           group by 1, 2) a on p.season = a.season and p.name = a.name
where cast(p.season as integer) < 2000
""")
def tally_comparison_q(spark, d):
    return tally_comparison(awarded(spark, d), scored(spark, d), before=2000)


def _acc_sql(by: str, hit: str, truth: str) -> str:
    return BASE + f"""
select {by}, count_if({hit})::double / nullif(count_if({truth}), 0)::double as percentage_correct
from awarded group by {by}
"""


@register("accuracy_exact", _acc_sql("season", "votes = 3 and true_votes = 3", "true_votes = 3"))
def accuracy_exact(spark, d):
    return vote_accuracy(awarded(spark, d), ["season"], "exact")


@register("accuracy_any", _acc_sql("season", "votes > 0 and true_votes > 0", "true_votes > 0"))
def accuracy_any(spark, d):
    return vote_accuracy(awarded(spark, d), ["season"], "any")


@register("accuracy_by_position", _acc_sql("pos", "votes > 0 and true_votes > 0",
                                           "true_votes > 0"))
def accuracy_by_position(spark, d):
    return vote_accuracy(awarded(spark, d), ["pos"], "any")


@register("recall_all", BASE + """
select s.season, coalesce(a.h, 0)::double / nullif(s.den, 0)::double as percentage_correct
from (select season, count_if(votes > 0 and true_votes > 0) h from awarded group by 1) a
right join (select season, count_if(true_votes > 0) den from scored group by 1) s
  on a.season = s.season
""")
def recall_all(spark, d):
    return vote_accuracy(awarded(spark, d), ["season"], "any", scope="all", full=scored(spark, d))


@register("regression_metrics", BASE + """
select round(sqrt(avg((true_votes - score) * (true_votes - score))), 9) as rmse,
       round(pow(corr(true_votes::double, score), 2), 9) as rsq,
       round(avg(abs(true_votes - score)), 9) as mae
from scored
""")
def regression_metrics_q(spark, d):
    m = regression_metrics(scored(spark, d), "true_votes", "score")
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


def _r2(x: str) -> str:
    return f"cast(round_even(cast(cast({x} as varchar) as decimal(38, 18)), 2) as double)"


@register("metrics_table", BASE + f"""
select metric, {_r2('v')} as estimate, format('{{:,.2f}}', {_r2('v')}) as estimate_text
from (unpivot (select sqrt(avg((true_votes - score) * (true_votes - score))) as rmse,
                      pow(corr(true_votes::double, score), 2) as rsq,
                      avg(abs(true_votes - score)) as mae from scored)
      on rmse, rsq, mae into name metric value v)
""")
def metrics_table_q(spark, d):
    return metrics_table(regression_metrics(scored(spark, d), "true_votes", "score"))
