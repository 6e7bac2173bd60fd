"""Stored registry, refresh of one season, bucketed tables, ids on wide rows, sketches, curves of every degree."""

import os
import random
from multiprocessing.pool import ThreadPool

import numpy as np
import pytest
from pyspark.sql import functions as F

from medalcast.operators.calibrate import degree_moments, fit_degrees, merge_moments
from medalcast.operators.modeling import near_zero_variance
from medalcast.operators.rows import dense_row_id
from medalcast.operators.summary import SKETCH_ERROR, merge_sketches, sketch_quantiles, sketch_totals
from medalcast.plans.q_features import bucketed_fact, match_features_bucketed
from medalcast.sources.registry import resolve_versions, save_version, stored_registry, take_version
from medalcast.sources.tables import load, save_seasons

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_racing_saves_take_different_versions(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPool(8) as pool:
        names = pool.map(lambda i: take_version(spark, root, "gbm"), range(40), chunksize=1)
    assert sorted(names) == [f"v{1 + i / 100:.2f}_model_gbm.RData" for i in range(40)]
    assert take_version(spark, root, "other") == "v1.00_model_gbm.RData"
    got = {r.model: r for r in resolve_versions(stored_registry(spark, root)).collect()}
    assert got["gbm"].next_file == "v1.40_model_gbm.RData" and got["other"].current_file == "v1.00_model_gbm.RData"


def test_a_failed_save_leaves_a_gap_and_no_artefact(spark, tmp_path):
    def fails(path):
        raise OSError("full")
    assert stored_registry(spark, str(tmp_path)).count() == 0
    with pytest.raises(OSError):
        save_version(spark, str(tmp_path), "m", fails)
    name, path = save_version(spark, str(tmp_path), "m", spark.range(3).write.parquet)
    assert name.startswith("v1.01") and spark.read.parquet(path).count() == 3


def test_one_season_is_refreshed(spark, tmp_path):
    path = str(tmp_path / "t")
    save_seasons(spark.createDataFrame([("2020", 1), ("2021", 2), ("2021", 3)], "season string, v long"), path)
    before = os.path.getmtime(os.path.join(path, "season=2020"))
    save_seasons(spark.createDataFrame([("2021", 9), ("2022", 4)], "season string, v long"), path)
    assert sorted((r.season, r.v) for r in load(spark, path).select(F.col("season").cast("string").alias("season"), "v").collect()) == [
        ("2020", 1), ("2021", 9), ("2022", 4)]
    assert os.path.getmtime(os.path.join(path, "season=2020")) == before
    save_seasons(spark.createDataFrame([], "season string, v long"), path)
    assert load(spark, path).count() == 3


def test_bucketed_features_have_no_exchange(spark):
    out = match_features_bucketed(spark, SF_SMALL)
    assert "Exchange" not in _plan(out) and "Window" in _plan(out)
    totals = bucketed_fact(spark, SF_SMALL).groupBy("contest_id", "team").agg(F.sum("qty"))
    assert "Exchange" not in _plan(totals)


@pytest.mark.parametrize("n", [1, 3, 40])
def test_dense_ids_of_wide_rows(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, "a", "b", "ü"]), rng.choice([None, *range(-50, 50)]), float(i), "x" * 50) for i in range(700)]
    df = spark.createDataFrame(rows, "k string, v long, own double, wide string").repartition(5)
    got = dense_row_id(df, ["k", "v", "own"], num_partitions=n).collect()
    key = [(r.k is not None, (r.k or "").encode(), r.v is not None, r.v or 0, r.own) for r in sorted(got, key=lambda r: r.id)]
    assert key == sorted(key) and sorted(r.id for r in got) == list(range(1, 701))
    same = spark.createDataFrame([(1, i) for i in range(50)], "k long, v long")           # one key only
    assert sorted(r.id for r in dense_row_id(same, ["k"]).collect()) == list(range(1, 51))
    assert dense_row_id(df.limit(0), ["k", "v"]).count() == 0
    assert "Scan ExistingRDD" not in _plan(dense_row_id(spark.range(9).toDF("k"), ["k"]))  # nothing checkpointed


def test_level_statistics_multiply_no_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 3)], "x string, y int")
    out = near_zero_variance(df, ["x", "y"])
    assert "Generate" not in _plan(out) and "Expand" not in _plan(out)
    assert {r.column: (r.freq_ratio, r.pct_unique) for r in out.collect()} == {"x": (2.0, pytest.approx(200 / 3)), "y": (1.0, 100.0)}


def test_sketches_of_batches_merge_within_their_error(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 5000, 20_000)
    df = spark.createDataFrame([("a", i + 1, int(v)) for i, v in enumerate(values)] + [("b", 1, 7)], "name string, sim long, total_votes long")
    got = {r.name: r for r in sketch_quantiles(merge_sketches(sketch_totals(df, batch=1500))).collect()}
    for p, col in ((0.05, "p05"), (0.5, "mdn_votes"), (0.95, "p95")):
        q = got["a"][col]
        assert (values < q).mean() - SKETCH_ERROR <= p <= (values <= q).mean() + SKETCH_ERROR
        assert got["b"][col] == 7


def test_every_degree_from_merged_moments(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 3, 500)
    y, z = np.sin(2 * x) + rng.normal(0, 0.1, 500), x ** 3 - x
    rows = [(int(i % 4), float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, z))] + [(0, None, 1.0, 1.0), (1, float("nan"), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g long, x double, y double, z double")
    parts = degree_moments(df, "x", {"y": F.col("y"), "z": F.col("z")}, 8, 1.0, 2.0, ["g"])
    assert parts.count() == 4
    fits = {(r.curve, r.degree): r for r in fit_degrees(merge_moments(parts), ["y", "z"], 8, 1.0, 2.0).collect()}
    for d in range(1, 9):
        want = np.polynomial.polynomial.polyfit(x, y, d)
        assert np.allclose(fits["y", d].coefs, want, atol=1e-6) and fits["y", d].n == 500
        assert fits["y", d].sse == pytest.approx(((np.polynomial.polynomial.polyval(x, want) - y) ** 2).sum(), rel=1e-6)
    assert np.allclose(fits["z", 3].coefs, [0, -1, 0, 1], atol=1e-8) and fits["z", 8].rsq == pytest.approx(1)
    assert fit_degrees(degree_moments(df.limit(0), "x", {"y": F.col("y")}, 2, 0.0, 1.0), ["y"], 2, 0.0, 1.0).count() == 0
    one = spark.createDataFrame([(2.0, 5.0)], "x double, y double")
    flat = fit_degrees(degree_moments(one, "x", {"y": F.col("y")}, 3, 0.0, 1.0), ["y"], 3, 0.0, 1.0).collect()
    assert all(np.polynomial.polynomial.polyval(2.0, r.coefs) == pytest.approx(5.0) for r in flat)
