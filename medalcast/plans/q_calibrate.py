"""Queries: calibration tables, curve points, fits and probabilities."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.calibrate import (apply_curves, calibration_table, complement_probability,
                                   curve_points, curve_table, degree_moments, fit_degrees, fit_polynomial,
                                   load_curves, merge_moments, probability_long, save_curves)
from ..operators.rows import add_row, drop_ordinals, replicate_rows
from ..functions.expr import copies_weight, horner
from ..schema import BINS_ONE_TWO, BINS_THREE, BINS_VALIDATION, CURVE_DEGREES, FIT_ANCHOR_V2, \
    FIT_DROP_ROWS
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources.standin import ROW_KEY, STANDIN_CURVES, scored
from .base_sql import BASE, weight_sql
from .registry import d, register

K = ", ".join(ROW_KEY)


def bin_sql(x: str, start: float, stop: float, step: float) -> str:
    n = int(round((stop - start) / step))
    return (f"cast(len(list_filter(list_transform(range(0, {n + 1}), "
            f"lambda i: {d(start)} + cast(i as double) * {d(step)}), lambda b: b < {x})) as integer)")


def round2_sql(x: str) -> str:
    # half-even on the shortest decimal text of the double, as Spark's bround does
    return f"cast(round_even(cast(cast({x} as varchar) as decimal(38, 18)), 2) as double)"


def calib_sql(bins, with_p: bool = True, with_v: bool = True) -> str:
    vs = ", ".join(f"cast(sum(case when true_votes = {k} then 1 end) as bigint) as v{k}"
                   for k in range(4))
    inner = f"""(select predicted_grp, {round2_sql('min(score)')} as min_score, {vs},
           cast(count_if(true_votes in (0, 1, 2, 3)) as bigint) as total
    from (select score, true_votes, {bin_sql('score', *bins)} as predicted_grp from scored)
    group by predicted_grp)"""
    cols = ["predicted_grp", "min_score"]
    if with_v:
        cols += [f"v{k}" for k in range(4)] + ["total"]
    if with_p:
        cols += [f"v{k}::double / nullif(total, 0)::double as p{k}" for k in range(4)]
    return f"select {', '.join(cols)} from {inner}"


def _calib(spark, d_, bins):
    return calibration_table(scored(spark, d_), "score", "true_votes", *bins)


@register("calibration_counts", BASE + calib_sql(BINS_VALIDATION, with_p=False))
def calibration_counts(spark, d_):
    t = _calib(spark, d_, BINS_VALIDATION)
    return t.select("predicted_grp", "min_score", "v0", "v1", "v2", "v3", "total")


@register("calibration_probs", BASE + calib_sql(BINS_ONE_TWO, with_v=False))
def calibration_probs(spark, d_):
    t = _calib(spark, d_, BINS_ONE_TWO)
    return t.select("predicted_grp", "min_score", "p0", "p1", "p2", "p3")


@register("bin_min_score", BASE + calib_sql(BINS_THREE, with_p=False, with_v=False))
def bin_min_score(spark, d_):
    return _calib(spark, d_, BINS_THREE).select("predicted_grp", "min_score")


def _points_sql(bins, label: int, drop, anchor=None) -> str:
    drop_list = ", ".join(str(i) for i in drop) or "-1"
    body = f"""select x, y from (
  select min_score as x, p{label} as y, row_number() over (order by predicted_grp) rn_
  from ({calib_sql(bins, with_v=False)})) where rn_ not in ({drop_list})"""
    if anchor is not None:
        body += f"\nunion all select {d(anchor[0])}, {d(anchor[1])}"
    return body


@register("drop_ordinal_rows", BASE + _points_sql(BINS_ONE_TWO, 1, FIT_DROP_ROWS["v1"]))
def drop_ordinal_rows(spark, d_):
    return curve_points(_calib(spark, d_, BINS_ONE_TWO), 1, FIT_DROP_ROWS["v1"])


@register("add_anchor_row", BASE + _points_sql(BINS_ONE_TWO, 2, FIT_DROP_ROWS["v2"],
                                               FIT_ANCHOR_V2))
def add_anchor_row(spark, d_):
    return curve_points(_calib(spark, d_, BINS_ONE_TWO), 2, FIT_DROP_ROWS["v2"], FIT_ANCHOR_V2)


@register("curve_fit_linear", BASE + f"""
select round(regr_slope(y, x), 9) as slope, round(regr_intercept(y, x), 9) as intercept
from ({_points_sql(BINS_THREE, 3, FIT_DROP_ROWS["v3"])})
""")
def curve_fit_linear(spark, d_):
    pts = curve_points(_calib(spark, d_, BINS_THREE), 3, FIT_DROP_ROWS["v3"])
    intercept, slope = fit_polynomial(pts, 1)
    return pts.agg(F.count(F.lit(1))).select(F.round(F.lit(slope), 9).alias("slope"), F.round(F.lit(intercept), 9).alias("intercept"))


def _moments(points, curve: str, degree: int):
    """A least-squares fit leaves residuals orthogonal to x^0 .. x^degree: those means, rounded, and the points used."""
    pts = points.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    left = F.col("y") - horner("x", fit_polynomial(pts, degree))
    per = pts.agg(F.count(F.lit(1)).alias("n_points"), *[F.avg(left * F.pow("x", F.lit(j))).alias(f"m{j}") for j in range(degree + 1)])
    return per.select(F.lit(curve).alias("curve"), "n_points", F.posexplode(F.array(*[f"m{j}" for j in range(degree + 1)])).alias("power", "m")) \
        .select("curve", "n_points", "power", F.abs(F.round("m", 6)).alias("moment"))


def _moments_sql(points: str, curve: str, degree: int) -> str:
    return f"""select '{curve}' as curve, n_points, cast(range as integer) as power, 0.0e0 as moment
from (select cast(count(*) as bigint) as n_points from ({points}) where x is not null and y is not null) cross join range({degree + 1})"""


@register("curve_fit_poly5", BASE + _moments_sql(_points_sql(BINS_ONE_TWO, 1, FIT_DROP_ROWS["v1"]), "v1", CURVE_DEGREES["v1"]))
def curve_fit_poly5(spark, d_):
    """1-vote curve: degree-5 least squares on bin points."""
    pts = curve_points(_calib(spark, d_, BINS_ONE_TWO), 1, FIT_DROP_ROWS["v1"])
    return _moments(pts, "v1", CURVE_DEGREES["v1"])


@register("curve_fit_poly4", BASE + _moments_sql(_points_sql(BINS_ONE_TWO, 2, FIT_DROP_ROWS["v2"], FIT_ANCHOR_V2), "v2", CURVE_DEGREES["v2"]))
def curve_fit_poly4(spark, d_):
    """2-vote curve: degree-4 fit with the anchor point."""
    pts = curve_points(_calib(spark, d_, BINS_ONE_TWO), 2, FIT_DROP_ROWS["v2"], FIT_ANCHOR_V2)
    return _moments(pts, "v2", CURVE_DEGREES["v2"])


@register("curve_fit_rows", BASE + _moments_sql("select score as x, true_votes as y from scored", "v3", CURVE_DEGREES["v3"]))
def curve_fit_rows(spark, d_):
    """3-vote curve fitted on every scored row (indicator of 3 true votes), degree 5."""
    s = scored(spark, d_).select(F.col("score").alias("x"),
                                 (F.col("true_votes") == 3).cast("double").alias("y"))
    return _moments(s, "v3", CURVE_DEGREES["v3"])


DEGREES = 8
_CENTRE, _SCALE = 1.0, 2.0      # the scores' middle and half their range, about; any fixed numbers do


def _degrees_sql() -> str:
    per = " union all ".join(
        f"""select 'v{k}' as curve, cast(count(*) as bigint) as n_points, round(regr_slope(cast(true_votes = {k} as double), score), 6) as slope,
        round(regr_intercept(cast(true_votes = {k} as double), score), 6) as intercept from scored where score is not null""" for k in (1, 2, 3))
    return f"""select curve, cast(d.range as integer) as degree, n_points, case when d.range = 1 then slope end as slope,
       case when d.range = 1 then intercept end as intercept, true as rises, case when d.range = {DEGREES} then 0.0e0 end as moment
from ({per}) cross join range(1, {DEGREES + 1}) d"""


@register("curve_degrees", BASE + _degrees_sql())
def curve_degrees(spark, d_):
    """Three curves of degrees 1 to 8 from one pass of moments, kept per season and merged.

    The straight lines are compared with SQL's; every degree fits no worse than the one before; the residuals of
    degree 8 are orthogonal to every power (the largest mean, rounded).
    """
    s = cut_lineage(scored(spark, d_).select("season", "score", "true_votes"), "scored")
    ys = {f"v{k}": (F.col("true_votes") == k).cast("double") for k in (1, 2, 3)}
    seasons = degree_moments(s, "score", ys, DEGREES, _CENTRE, _SCALE, ["season"])
    fits = fit_degrees(merge_moments(seasons), list(ys), DEGREES, _CENTRE, _SCALE)
    best = {r["curve"]: r["coefs"] for r in fits.filter(F.col("degree") == DEGREES).collect()}       # three rows
    u = (F.col("score") - F.lit(_CENTRE)) / F.lit(_SCALE)
    left = s.filter("score is not null").agg(*[
        F.greatest(*[F.abs(F.avg((y - horner("score", best[c])) * F.pow(u, F.lit(j)))) for j in range(DEGREES + 1)]).alias(c)
        for c, y in ys.items() if c in best] or [F.lit(None).cast("double").alias("none")])
    moment = left.unpivot([], left.columns, "curve", "m")
    before = F.lag("sse").over(Window.partitionBy("curve").orderBy("degree"))                        # eight rows a curve
    out = fits.withColumn("rises", F.coalesce(F.col("sse") <= before * (1 + 1e-9), F.lit(True))).join(moment, "curve")
    one, last = F.col("degree") == 1, F.col("degree") == DEGREES
    return out.select("curve", "degree", F.col("n").alias("n_points"), F.when(one, F.round(F.col("coefs")[1], 6)).alias("slope"),
                      F.when(one, F.round(F.col("coefs")[0], 6)).alias("intercept"), "rises", F.when(last, F.round("m", 6)).alias("moment"))


@register("curve_probability", BASE + f"""
select {K}, score, v3_prob from probs
""")
def curve_probability(spark, d_):
    out = apply_curves(scored(spark, d_), "score", STANDIN_CURVES, ["v3"])
    return out.select(*ROW_KEY, "score", "v3_prob")


@register("curve_saved_probability", BASE + f"select {K}, score, v3_prob from probs")
def curve_saved_probability(spark, d_):
    """The curves as a saved and reread table, then applied."""
    path = os.path.join(ensure_checkpoint_dir(spark), "curves-" + uuid.uuid4().hex)
    save_curves(curve_table(spark, STANDIN_CURVES), path)
    out = apply_curves(scored(spark, d_), "score", load_curves(spark, path), ["v3"])
    return out.select(*ROW_KEY, "score", "v3_prob")


_COMP = """select {k}, score, v1_prob, v2_prob, v3_prob,
       1.0e0 - (v1_prob + v2_prob + v3_prob) as v0_prob,
       (1.0e0 - (v1_prob + v2_prob + v3_prob)) + v1_prob + v2_prob + v3_prob as total_p
from probs"""


@register("complement_probability", BASE + _COMP.format(k=K))
def complement_probability_q(spark, d_):
    out = complement_probability(apply_curves(scored(spark, d_), "score", STANDIN_CURVES))
    return out.select(*ROW_KEY, "score", "v1_prob", "v2_prob", "v3_prob", "v0_prob", "total_p")


@register("probability_long", BASE + f"""
select {K}, v_prob, "values" from (
  unpivot ({_COMP.format(k=K)}) on v0_prob, v1_prob, v2_prob, v3_prob
  into name v_prob value "values")
""")
def probability_long_q(spark, d_):
    wide = complement_probability(apply_curves(scored(spark, d_), "score", STANDIN_CURVES))
    return probability_long(wide, ROW_KEY)


@register("replicate_rows", BASE + f"""
select contest_id, cast(count(*) as bigint) as copies, cast(count(distinct (ln, pk, entity_id)) as bigint) as weighted_rows,
       cast(max(copy) as bigint) as max_copy
from (select contest_id, ln, pk, entity_id, unnest(range(1, w + 1)) as copy
      from (select *, {weight_sql('v3_prob')} as w from probs) where w > 0)
group by contest_id
""")
def replicate_rows_q(spark, d_):
    p = apply_curves(scored(spark, d_), "score", STANDIN_CURVES, ["v3"])
    rep = replicate_rows(p.withColumn("w", copies_weight("v3_prob")), "w")
    return rep.groupBy("contest_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_distinct("ln", "pk", "entity_id").alias("weighted_rows"),
        F.max("copy").alias("max_copy"))
