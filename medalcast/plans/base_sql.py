"""DuckDB CTEs mirroring ``sources.standin`` (oracle side only).

DuckDB inlines unreferenced CTEs away, so every oracle query starts with the
whole prefix and uses what it needs.
"""

from __future__ import annotations

from .registry import horner_sql, u_sql
from ..sources.standin import SEED, STANDIN_CURVES

KEY = "contest_id, ln, pk, entity_id"


def curve_sql(x: str, curve: str) -> str:
    coefs, hi, hi_val = STANDIN_CURVES[curve]
    return (f"(case when {x} > {hi!r} then CAST({hi_val!r} AS DOUBLE) "
            f"when {x} < -0.05 then CAST(0.0 AS DOUBLE) else {horner_sql(x, coefs)} end)")


def weight_sql(p: str) -> str:
    return f"cast(round_even(100 * greatest(coalesce({p}, 0.0), 0.0), 0) as bigint)"


BASE = f"""
with fact as (
  select l_orderkey contest_id, l_linenumber ln, l_partkey pk, l_suppkey entity_id,
         o_orderdate contest_date, substr(cast(o_orderdate as varchar), 1, 4) season,
         case when o_orderkey % 10 = 0 then 'FINAL' else substr(o_orderpriority, 1, 1) end stage,
         l_linestatus team, case when o_orderkey % 2 = 0 then 'O' else 'F' end winner,
         cast(floor(o_totalprice / 1000) as bigint) margin,
         s_name name, n_name club, p_type pos,
         cast(l_quantity as bigint) qty, cast(round(l_extendedprice * 100) as bigint) cents,
         cast(round(l_discount * 100) as bigint) disc, cast(round(l_tax * 100) as bigint) tax,
         cast(p_size as bigint) psize
  from lineitem join orders on l_orderkey = o_orderkey
       join supplier on l_suppkey = s_suppkey
       join nation on s_nationkey = n_nationkey
       join part on l_partkey = p_partkey
),
scored as (
  select * exclude (rk_, n_, tot_),
         4.0e0 * (cents::double / nullif(tot_, 0)::double) - 0.5e0 as score,
         cast(case when rk_ <= least(3, n_) then least(3, n_) + 1 - rk_ else 0 end as bigint)
           as true_votes
  from (select *,
               row_number() over (partition by contest_id order by qty desc, ln, pk, entity_id, cents, disc, tax, psize) rk_,
               count(*) over (partition by contest_id) n_,
               sum(cents) over (partition by contest_id) tot_
        from fact)
),
awarded as (
  select * exclude (rk_, m_), cast(m_ + 1 - rk_ as bigint) as votes
  from (select *, count(*) over (partition by contest_id) m_
        from (select *, row_number() over (partition by contest_id
                        order by score desc nulls last, {u_sql(str(SEED), 'contest_id', 'ln', 'pk', 'entity_id')},
                                 contest_id, ln, pk, entity_id) rk_
              from scored)
        where rk_ <= 3)
),
probs as (
  select *, {curve_sql('score', 'v1')} as v1_prob, {curve_sql('score', 'v2')} as v2_prob,
         {curve_sql('score', 'v3')} as v3_prob
  from scored
)
"""
