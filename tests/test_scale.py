"""Steps that must not grow with the draws or the table: packed draws, podiums of one pass, bounded batches."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from medalcast.operators import sampling
from medalcast.operators.sampling import MASKS, contest_weights, packed_sims, sample_votes, season_draws


def _contests(spark, names=9):
    return spark.createDataFrame([(c, f"n{i:02d}", ((c * 7 + i * 3) % 10) / 10) for c in range(30) for i in range(1 + c % names)],
                                 "c long, name string, p double")


def test_places_match_a_plain_ranking_of_the_keys():
    rng = np.random.default_rng(5)
    size = np.array([1, 2, 3, 7, 24, 25, 40, 3])
    starts, n = np.cumsum(size) - size, int(size.sum())
    keys = rng.integers(0, 12, (n, 33)).astype(float)          # many ties
    got = sampling._places(starts, n, keys, 3)
    for at, m in zip(starts, size, strict=True):
        for s in range(33):
            order = sorted(range(m), key=lambda i: (keys[at + i, s], i))
            assert [i for p in range(3) for i in range(m) if got[at + i, s] == p] == order[:3]


def test_packed_draws_hold_the_long_ones(spark, monkeypatch):
    df = _contests(spark)
    long = sorted(map(tuple, sample_votes(df, "c", "name", "p", 300, seed=8, first_sim=5).collect()))

    def spread(packed):
        return sorted((r.sim + 64 * i + b, r.c, r.name, r.votes) for r in packed.collect() for i, m in enumerate(MASKS) for b in range(64) if r[m] >> b & 1)
    packed = sample_votes(df, "c", "name", "p", 300, seed=8, first_sim=5, packed=True)
    assert spread(packed) == long
    assert packed.agg(F.sum(packed_sims())).first()[0] == len(long)
    assert packed.count() < len(long) / 20
    monkeypatch.setattr(sampling, "CHUNK", 4)                    # contests in parts
    assert spread(sample_votes(df, "c", "name", "p", 300, seed=8, first_sim=5, packed=True)) == long


def test_one_pass_gives_out_modal_podiums_alone(spark):
    weights = contest_weights(_contests(spark), "c", "name", "p").localCheckpoint()
    every = season_draws(weights, "c", "name", 200, seed=3, totals=False).collect()
    modal = season_draws(weights, "c", "name", 200, seed=3, totals=False, modal=True).collect()
    best = {}
    for r in every:
        best[r.c] = max(best.get(r.c, 0), r.n)
    assert sorted((r.c, r.places, r.n) for r in modal) == sorted((r.c, r.places, r.n) for r in every if r.n == best[r.c])
    assert len(modal) < len(every) / 3


def test_votes_are_given_out_in_bounded_batches(spark):
    held = sampling._Votes(256, 1, 3)
    names = [f"n{i}" for i in range(5000)]
    at = held.rows(names)
    held.votes[at] += 1
    parts = list(held.out("string"))
    assert sum(len(p[0]) for p in parts) == 5000 and max(len(p[2].flatten()) for p in parts) <= sampling.GIVEN
    assert held.votes.dtype == np.int16 and not held.at
    held.most = 32767 - held.step + 1                            # 16 bits could overflow with the next table
    assert held.full()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_rows_of_a_large_table_are_dealt_over_more_partitions(spark, monkeypatch):
    from medalcast.plans.q_features import BUCKETS, bucketed_fact
    from medalcast.sources import standin
    whole = sorted(map(tuple, standin.scored(spark, SF_SMALL).collect()))
    size = standin.table_files(spark, SF_SMALL, "lineitem")[0]
    monkeypatch.setattr(standin, "PART_BYTES", -(-size // 37))
    assert standin.fact_partitions(spark, SF_SMALL) == 37
    rows = standin.scored(spark, SF_SMALL)
    assert _plan(rows).count("37), REPARTITION_BY_NUM") == 2                 # line items and orders, then no exchange for the window
    assert sorted(map(tuple, rows.collect())) == whole
    table = bucketed_fact(spark, SF_SMALL)
    assert "SelectedBucketsCount: 37 out of 37" in _plan(table.groupBy("contest_id").count()) and BUCKETS < 37


def test_keys_and_pooled_rows_are_read_from_a_written_table(spark, monkeypatch):
    from medalcast.operators import rows
    from medalcast.plans import q_model
    from medalcast.plans.q_model import recipe_baked_levels
    assert "lineitem.parquet" not in _plan(recipe_baked_levels(spark, SF_SMALL))
    cut, calls = rows.cut_lineage, []
    monkeypatch.setattr(rows, "cut_lineage", lambda df, name=None: calls.append(df.columns) or cut(df, name))
    df = spark.range(100).selectExpr("id % 7 k", "id v", "'x' wide")
    assert sorted(r.id for r in rows.dense_row_id(df, ["k", "v"]).collect()) == list(range(1, 101))
    assert calls == [["k", "v"]]
    monkeypatch.setattr(q_model, "stratified_split", lambda df, *a: df)
    assert "lineitem.parquet" not in _plan(q_model.model_input(spark, SF_SMALL))


def test_exclusion_of_packed_draws_counts_as_the_long_ones(spark, monkeypatch):
    from medalcast.plans import q_season
    df = _contests(spark).selectExpr("c contest_id", "nullif(name, 'n02') name", "p")
    draw = ("contest_id", "name", "p", 300)
    monkeypatch.setattr(q_season, "season_samples", lambda *_: sample_votes(df, *draw, packed=True))
    want = sample_votes(df, *draw).groupBy("contest_id").agg(
        F.count(F.lit(1)).alias("draws"), F.count_distinct("sim", "name").alias("distinct_draws"), F.count_distinct("sim").alias("sims"))
    got = q_season.sample_exclusion(spark, None)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    times = sample_votes(df, *draw).groupBy("contest_id", "name", "votes").agg(F.count(F.lit(1)).alias("n"))
    assert {tuple(r) for r in q_season.sample_votes_q(spark, None).collect()} == {tuple(r) for r in times.collect()}


def test_votes_leave_few_tasks_once_a_name_and_block(spark):
    rows = [(c, f"n{i}", 0.1 * (1 + (c + i) % 9)) for c in range(300) for i in range(5)]
    weights = contest_weights(spark.createDataFrame(rows, "c long, name string, p double"), "c", "name", "p").localCheckpoint()
    few = {(r.name, r.sim): r.total_votes for r in sampling.draw_totals(season_draws(weights, "c", "name", 300, seed=3), "c", "name", split=False).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        draws = season_draws(weights, "c", "name", 300, seed=3, podiums=False).localCheckpoint()
        assert {(r.name, r.sim): r.total_votes for r in sampling.draw_totals(draws, "c", "name", split=False).collect()} == few
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    tasks = sampling.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert 64 > tasks and draws.count() <= tasks * 5 * 2                  # five names, two blocks of simulations
    sizes = {(r.sim, len(r.votes) // r.n) for r in draws.collect()}
    assert sizes == {(1, 256), (257, 44)} and {r.n for r in draws.collect()} == {1}


def test_written_seasons_hold_modal_podiums_alone(spark, tmp_path):
    df = _contests(spark)
    totals, podiums = sampling.season_tables(df, "c", "name", "p", 600, seed=3, path=str(tmp_path), batch=200)
    base = tmp_path / "k3-seed3-batch200"
    kinds = {p.name: {r.kind for r in spark.read.parquet(str(p)).select("kind").collect()} for p in base.iterdir()}
    assert sorted(kinds) == [f"podiums-600-{i}-of-3" for i in (1, 2, 3)] + ["sims-1-200", "sims-201-400", "sims-401-600"]
    assert all(k == ({"podium"} if n.startswith("podiums") else {"votes"}) for n, k in kinds.items())
    plain = sampling.season_tables(df, "c", "name", "p", 600, seed=3)     # one call, more than one block
    assert sorted(map(tuple, podiums.collect())) == sorted(map(tuple, plain[1].collect()))
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, plain[0].collect()))


def test_podiums_counted_in_an_array_are_the_sorted_ones(monkeypatch):
    rng = np.random.default_rng(2)
    size = np.array([1, 2, 7, 3, 9, 1, 5])
    starts, n = np.cumsum(size) - size, int(size.sum())
    pick = np.array([0, 1, 2, 4, 6])
    blocks = [sampling._places(starts, n, rng.random((n, 90)), 3) for _ in range(2)]

    def run():
        p = sampling._Podiums(starts, n, pick, 3)
        for b in blocks:
            p.add(b)
        seen, times = p.counted()
        return p.dense, sorted(zip(*[c.tolist() for c in seen], times.tolist(), strict=True))
    dense, got = run()
    monkeypatch.setattr(sampling, "DENSE", 1)
    assert dense and run() == (False, got) and sum(r[-1] for r in got) == 2 * 90 * len(pick)


def test_votes_of_a_name_that_stands_often_are_added_whole(monkeypatch):
    votes = np.random.default_rng(4).integers(0, 4, (50, 20)).astype(np.uint8)
    who = np.array([i % 3 if i < 40 else i for i in range(50)])
    order = np.argsort(who, kind="stable").astype(np.int32)
    edge = np.flatnonzero(np.diff(who[order], prepend=-1)).astype(np.int32)
    want = np.zeros((50, 20), np.uint8)
    np.add.at(want, who, votes)
    for most in (32, 5):
        monkeypatch.setattr(sampling, "ROUNDS", most)
        got = np.zeros_like(want)
        sampling._add_votes(got, votes, order, edge, who[order[edge]])
        assert (got == want).all()


def test_features_run_the_fact_joins_once_and_the_fit_reads_even_parts(spark, monkeypatch):
    from medalcast.operators.features import add_match_features
    from medalcast.plans import q_model
    from medalcast.sources.standin import ROW_KEY, STANDIN_POSITION_GROUPS, STAT_COLS, scored
    cut, plans = q_model.cut_lineage, []
    monkeypatch.setattr(q_model, "cut_lineage", lambda df, name=None: plans.append(_plan(df)) or cut(df, name))
    rows = q_model.model_input(spark, SF_SMALL)
    assert plans[0].count("Scan parquet") == 5              # one of each table
    joined = add_match_features(scored(spark, SF_SMALL, regular_only=True), "contest_id", "team", "winner", "margin", "pos", STAT_COLS, STANDIN_POSITION_GROUPS)
    cols = [*ROW_KEY, *q_model.NUMERIC, *q_model.NOMINAL]
    assert sorted(map(repr, rows.select(cols).collect())) == sorted(map(repr, joined.select(cols).collect()))
    parts = [len(p) for p in q_model.fit_rows(rows.coalesce(1)).rdd.glom().collect()]
    assert len(parts) == spark.sparkContext.defaultParallelism and max(parts) - min(parts) <= len(parts)
