"""Score calibration: bin tables, polynomial curves, vote probabilities.

SURVEY D8, F6, U3, M14-M17, R1, R3, S6.

Scale notes
-----------
``calibration_table`` is one partial aggregation over the scored rows (bin
ordinal computed per row with arithmetic, no arrays); its output has at most
``n_breaks + 2`` rows, so everything downstream of it (ordinal drops, curve
fits on bins) works on a table whose size is fixed by the parameters.
``fit_curve(unit="row")`` fits on every scored row through MLlib's normal
equations, which aggregate a (d+1)x(d+1) moment matrix across executors.
Fitted coefficients are the only values brought to the driver.
``degree_moments`` sums centred powers in one pass for every curve and degree at
once; a fit of any degree is then solved from one row of sums.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
from numpy.polynomial import Polynomial
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import clamp_curve, half_even, right_closed_bin, safe_ratio
from .rows import add_row, drop_ordinals

LABELS = (0, 1, 2, 3)


def calibration_table(df: DataFrame, score: str, label: str, start: float, stop: float,
                      step: float, labels: Sequence[int] = LABELS,
                      fill: int | None = None) -> DataFrame:
    """Counts of each label per right-closed score bin, bin minimum, total and shares.

    Columns: ``predicted_grp`` (bin ordinal), ``min_score`` (bin minimum,
    half-even to 2 places), ``v<k>`` counts (NULL when a bin has none of label
    k unless ``fill`` is given, N9), ``total`` (rows with a listed label) and
    ``p<k>`` = v<k> / total.
    """
    g = df.select(right_closed_bin(score, start, stop, step).alias("predicted_grp"),
                  F.col(score).alias("_x"), F.col(label).alias("_y"))
    counts = [F.sum(F.when(F.col("_y") == k, F.lit(1))).cast("bigint").alias(f"v{k}")
              for k in labels]
    out = g.groupBy("predicted_grp").agg(
        half_even(F.min("_x"), 2).alias("min_score"), *counts,
        F.count_if(F.col("_y").isin(list(labels))).cast("bigint").alias("total"))
    if fill is not None:
        out = out.fillna(fill, subset=[f"v{k}" for k in labels])
    return out.withColumns({f"p{k}": safe_ratio(f"v{k}", "total") for k in labels})


def curve_points(table: DataFrame, label: int, drop_rows: Sequence[int] = (),
                 anchor: tuple[float, float] | None = None) -> DataFrame:
    """(x, y) points for one curve: bin minimum vs share of label k, bins in order,
    listed 1-based rows dropped (F6), an optional anchor point appended (U3)."""
    pts = table.select("predicted_grp", F.col("min_score").alias("x"),
                       F.col(f"p{label}").alias("y"))
    pts = drop_ordinals(pts, ["predicted_grp"], drop_rows).select("x", "y")
    if anchor is not None:
        pts = add_row(pts, {"x": anchor[0], "y": anchor[1]})
    return pts


def fit_polynomial(points: DataFrame, degree: int, x: str = "x", y: str = "y") -> list[float]:
    """Least-squares polynomial ``y ~ poly(x, degree, raw=TRUE)``.

    Uses MLlib's normal-equation solver on raw powers, so the moments are
    summed on the executors and only d+1 coefficients reach the driver.
    Rows with a missing x or y are left out, as ``lm`` does.
    """
    data = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(y))
    vec = VectorAssembler(inputCols=[x], outputCol="_xv").transform(data)
    poly = PolynomialExpansion(degree=degree, inputCol="_xv", outputCol="_feat").transform(vec)
    lr = LinearRegression(featuresCol="_feat", labelCol=y, solver="normal", regParam=0.0,
                          elasticNetParam=0.0, standardization=False, fitIntercept=True)
    m = lr.fit(poly)
    return [float(m.intercept), *[float(c) for c in m.coefficients.toArray()]]


def degree_moments(df: DataFrame, x: str, ys: dict[str, Column], degree: int, centre: float, scale: float, by: Sequence[str] = ()) -> DataFrame:
    """Power sums of ``u = (x - centre) / scale`` for least squares of every curve in ``ys`` up to ``degree``.

    One pass: ``s0 .. s<2 degree>`` are shared by all curves; each has ``b0 .. b<degree>`` (with y) and ``yy``.
    Sums with the same centre and scale add up, so they can be kept per season (``by``) and merged.
    Rows with a missing x or y are left out of that curve's fit, as ``lm`` does; a y that is missing must be so in all.
    """
    u = (F.col(x).cast("double") - F.lit(float(centre))) / F.lit(float(scale))
    first = next(iter(ys.values()))
    some = df.filter(F.col(x).isNotNull() & ~F.isnan(F.col(x).cast("double")) & first.isNotNull())
    src = some.select(*by, u.alias("_u"), *[y.cast("double").alias(f"_y_{c}") for c, y in ys.items()])
    power = [F.lit(1.0), F.col("_u"), *[F.pow("_u", F.lit(float(j))) for j in range(2, 2 * degree + 1)]]
    sums = [F.sum(p).alias(f"s{j}") for j, p in enumerate(power)]
    for c in ys:
        y = F.col(f"_y_{c}")
        sums += [F.sum(y * power[j]).alias(f"{c}_b{j}") for j in range(degree + 1)] + [F.sum(y * y).alias(f"{c}_yy")]
    return src.groupBy(*by).agg(*sums)


def merge_moments(moments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums of ``degree_moments`` added up over the groups that ``by`` doesn't keep."""
    return moments.groupBy(*by).agg(*[F.sum(c).alias(c) for c in moments.columns if re.fullmatch(r"s\d+|.*_(b\d+|yy)", c)])


DEGREES_SCHEMA = "curve string, degree int, n long, coefs array<double>, sse double, rsq double"


def fit_degrees(moments: DataFrame, curves: Sequence[str], degree: int, centre: float, scale: float) -> DataFrame:
    """Least-squares polynomials of degree 1 .. ``degree`` of every curve, from one row of moments.

    Columns: curve, degree, n, coefs (of x), sse, rsq. A degree that the points don't determine gets the
    least coefficients that fit. No rows: no fits.
    """
    m = moments.first()
    rows = []
    for c in curves if m is not None and m["s0"] else ():
        s = np.array([m[f"s{j}"] for j in range(2 * degree + 1)])
        b, yy = np.array([m[f"{c}_b{j}"] for j in range(degree + 1)]), m[f"{c}_yy"]
        spread = yy - b[0] * b[0] / s[0]
        for d in range(1, degree + 1):
            gram = s[np.add.outer(np.arange(d + 1), np.arange(d + 1))]
            own = np.linalg.lstsq(gram, b[:d + 1], rcond=1e-14)[0]
            sse = float(yy - 2 * own @ b[:d + 1] + own @ gram @ own)
            line = Polynomial([-centre / scale, 1 / scale])
            of_x = Polynomial(own)(line).coef
            rows.append((c, d, int(s[0]), [float(v) for v in np.pad(of_x, (0, d + 1 - len(of_x)))], sse, float(1 - sse / spread) if spread > 0 else None))
    return moments.sparkSession.createDataFrame(rows, DEGREES_SCHEMA)


CURVE_SCHEMA = T.StructType([
    T.StructField("curve", T.StringType()),
    T.StructField("degree", T.IntegerType()),
    T.StructField("coefs", T.ArrayType(T.DoubleType())),
    T.StructField("hi", T.DoubleType()),
    T.StructField("hi_val", T.DoubleType()),
    T.StructField("lo", T.DoubleType()),
    T.StructField("lo_val", T.DoubleType()),
])


def curve_table(spark: SparkSession, curves: dict[str, tuple[Sequence[float], float, float]],
                lo: float = -0.05, lo_val: float = 0.0) -> DataFrame:
    """Curve definitions as a table ``(curve, degree, coefs, hi, hi_val, lo, lo_val)``."""
    rows = [(name, len(c) - 1, [float(v) for v in c], float(hi), float(hv), float(lo),
             float(lo_val)) for name, (c, hi, hv) in curves.items()]
    return spark.createDataFrame(rows, CURVE_SCHEMA)


def save_curves(curves: DataFrame, path: str) -> None:
    curves.write.mode("overwrite").parquet(path)


def load_curves(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CURVE_SCHEMA).parquet(path)


def apply_curves(df: DataFrame, x: str, curves: DataFrame | dict,
                 names: Sequence[str] | None = None, suffix: str = "_prob") -> DataFrame:
    """Add ``<curve>_prob`` columns: clamped polynomial of ``x`` for each curve.

    ``curves`` is a curve table (a handful of rows, read on the driver) or a
    dict ``name -> (coefs, hi, hi_val)``.
    """
    if isinstance(curves, DataFrame):
        defs = {r["curve"]: (r["coefs"], r["hi"], r["hi_val"], r["lo"], r["lo_val"])
                for r in curves.collect()}
    else:
        defs = {k: (c, hi, hv, -0.05, 0.0) for k, (c, hi, hv) in curves.items()}
    names = list(names or defs)
    return df.withColumns({n + suffix: clamp_curve(x, defs[n][0], defs[n][1], defs[n][2],
                                                   defs[n][3], defs[n][4]) for n in names})


def complement_probability(df: DataFrame, parts: Sequence[str] = ("v1_prob", "v2_prob",
                                                                  "v3_prob"),
                           out: str = "v0_prob", total: str = "total_p") -> DataFrame:
    """``v0 = 1 - (v1 + v2 + v3)`` and the stacked total."""
    s = F.col(parts[0])
    for p in parts[1:]:
        s = s + F.col(p)
    df = df.withColumn(out, F.lit(1.0) - s)
    t = F.col(out)
    for p in parts:
        t = t + F.col(p)
    return df.withColumn(total, t)


def probability_long(df: DataFrame, ids: Sequence[str],
                     cols: Sequence[str] = ("v0_prob", "v1_prob", "v2_prob", "v3_prob"),
                     name_col: str = "v_prob", value_col: str = "values") -> DataFrame:
    """Wide probabilities to long ``(ids, v_prob, values)``."""
    return df.unpivot(list(ids), list(cols), name_col, value_col)
