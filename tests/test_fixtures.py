"""Hand-made inputs with worked-out answers (FIXTURES.md §3, rules 1-18)."""

import pytest
from pyspark.sql import functions as F

from medalcast.functions.expr import clamp_curve, copies_weight, right_closed_bin
from medalcast.operators.awards import award_votes, vote_accuracy
from medalcast.operators.features import group_shares, recode_position, signed_margin
from medalcast.operators.modeling import pool_rare_levels
from medalcast.operators import sampling
from medalcast.operators.sampling import modal_podiums, sample_votes, season_totals
from medalcast.operators.summary import (round_leaderboard, sim_summary, sim_totals, split_podium,
                                         team_top_k)
from medalcast.sources.registry import resolve_versions


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_shares(spark):
    df = spark.createDataFrame(
        [(1, "A", "p1", 2, 0), (1, "A", "p2", 1, 0), (1, "B", "p3", 3, 0)],
        "contest long, team string, player string, goals long, tackles long")
    t = group_shares(df, ["contest", "team"], ["goals", "tackles"], "team_", "team_pct_")
    m = group_shares(t, ["contest"], ["goals", "tackles"], "match_", "match_pct_")
    got = {r.player: r for r in m.collect()}
    assert got["p1"].team_pct_goals == pytest.approx(2 / 3)
    assert got["p2"].team_pct_goals == pytest.approx(1 / 3)
    assert got["p3"].team_pct_goals == 1.0
    assert [got[p].match_pct_goals for p in ("p1", "p2", "p3")] == pytest.approx([1/3, 1/6, 1/2])
    assert all(got[p].team_pct_tackles is None for p in got)
    assert all(got[p].match_pct_tackles is None for p in got)


@pytest.mark.parametrize("method", ["join", "window"])
def test_null_policy(spark, method):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", None), (1, "c", 3)],
                               "contest long, p string, goals long")
    prop = group_shares(df, ["contest"], ["goals"], null_policy="propagate", method=method)
    skip = group_shares(df, ["contest"], ["goals"], null_policy="skip", method=method)
    assert all(r.match_pct_goals is None for r in prop.collect())
    got = {r.p: r.match_pct_goals for r in skip.collect()}
    assert got["a"] == pytest.approx(0.4) and got["b"] is None and got["c"] == pytest.approx(0.6)


def test_awards_and_ties(spark):
    df = spark.createDataFrame([(1, "w", 0.9), (1, "x", 0.5), (1, "y", 0.5), (1, "z", 0.1)],
                               "c long, k string, s double")
    got = dict(rows(award_votes(df, "c", "s", ["c", "k"], seed=7), "k", "votes"))
    assert got["w"] == 3 and sorted([got["x"], got["y"]]) == [1, 2] and "z" not in got
    # repeatable: the same seed gives the same tie order
    again = dict(rows(award_votes(df.repartition(3), "c", "s", ["c", "k"], seed=7), "k", "votes"))
    assert again == got


def test_small_contests(spark):
    df = spark.createDataFrame([(1, "a", 0.7), (1, "b", 0.2), (2, "c", 0.4)],
                               "c long, k string, s double")
    got = dict(rows(award_votes(df, "c", "s", ["c", "k"]), "k", "votes"))
    assert got == {"a": 2, "b": 1, "c": 1}


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(-1.0,), (-0.95,), (3.0,), (3.01,), (-5.0,), (None,)], "x double")
    got = [r[0] for r in df.select(right_closed_bin("x", -1.0, 3.0, 0.1)).collect()]
    assert got == [0, 1, 40, 41, 0, None]


def test_bins_match_array_definition(spark):
    import random
    random.seed(3)
    xs = [round(random.uniform(-1.2, 3.2), random.choice([1, 2, 3])) for _ in range(400)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    brk = [-1.0 + i * 0.1 for i in range(41)]
    got = [r[0] for r in df.select(right_closed_bin("x", -1.0, 3.0, 0.1)).collect()]
    assert got == [sum(b < x for b in brk) for x in xs]


def test_margin_and_position(spark):
    df = spark.createDataFrame([("A", "A", 12), ("A", "B", 12), (None, "B", 12)],
                               "winner string, team string, margin int")
    assert [r[0] for r in df.select(signed_margin("winner", "team", "margin")).collect()] == \
        [12, -12, None]
    pos = spark.createDataFrame([("FF",), ("CHB",), ("INT",), ("RK",), ("C",), (None,)],
                                "p string")
    assert [r[0] for r in pos.select(recode_position("p")).collect()] == \
        ["KEYFWD", "KEYBCK", "BENCH", "RUCK", "GENERAL", "GENERAL"]


def test_half_even_weights(spark):
    df = spark.createDataFrame([(0.005,), (0.015,), (0.025,), (-0.2,), (None,)], "p double")
    assert [r[0] for r in df.select(copies_weight("p")).collect()] == [0, 2, 2, 0, 0]


def _samples(spark):
    return spark.createDataFrame(
        [(1, 1, "a", 3), (1, 2, "b", 3), (2, 3, "a", 3), (2, 4, "a", 3), (2, 5, "b", 3),
         (3, 6, "b", 2)], "sim long, contest_id long, name string, votes long")


def test_summary_appearances(spark):
    got = {r.name: r for r in sim_summary(_samples(spark), 4).collect()}
    assert (got["a"].p05, got["a"].mdn_votes, got["a"].p95) == pytest.approx((3.15, 4.5, 5.85))
    assert got["a"].win_perc == 1.0
    assert (got["b"].p05, got["b"].mdn_votes, got["b"].p95) == pytest.approx((2.1, 3.0, 3.0))
    assert got["b"].win_perc == pytest.approx(2 / 3)


def test_summary_all_sims(spark):
    got = {r.name: r for r in sim_summary(_samples(spark), 4, "all_sims").collect()}
    assert (got["a"].p05, got["a"].mdn_votes, got["a"].p95) == pytest.approx((0.0, 1.5, 5.55))
    assert (got["b"].p05, got["b"].mdn_votes, got["b"].p95) == pytest.approx((0.3, 2.5, 3.0))
    assert got["a"].win_perc == 0.5 and got["b"].win_perc == 0.5


def test_board(spark):
    summary = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "name string, mdn_votes double")
    podium = spark.createDataFrame([(10, "a > x > y"), (11, "q > r > s")],
                                   "contest_id long, combo321 string")
    played = spark.createDataFrame([(10, "1", "a"), (10, "1", "b"), (11, "2", "a")],
                                   "contest_id long, stage string, name string")
    board = {r.name: r for r in round_leaderboard(summary, split_podium(podium), played).collect()}
    assert (board["a"].R1, board["a"].R2) == ("3", "0")
    assert (board["b"].R1, board["b"].R2) == ("0", "-")
    assert board["a"].Total == 3.0


def test_accuracy_scopes(spark):
    awarded = spark.createDataFrame([("s", 3, 3), ("s", 2, 0), ("s", 1, 1)],
                                    "season string, votes long, true_votes long")
    full = awarded.select("season", "true_votes").unionByName(
        spark.createDataFrame([("s", 2), ("s", 0)], "season string, true_votes long"))
    assert rows(vote_accuracy(awarded, ["season"], "exact"), "percentage_correct") == [(1.0,)]
    assert rows(vote_accuracy(awarded, ["season"], "any"), "percentage_correct") == [(1.0,)]
    got = rows(vote_accuracy(awarded, ["season"], "any", "all", full), "percentage_correct")
    assert got[0][0] == pytest.approx(2 / 3)


def test_curve_clamp(spark):
    df = spark.createDataFrame([(3.6,), (3.5,), (-0.05,), (-0.06,)], "x double")
    got = [r[0] for r in df.select(clamp_curve("x", [0.1, 0.2], 3.5, 0.975)).collect()]
    assert got == pytest.approx([0.975, 0.1 + 0.2 * 3.5, 0.1 + 0.2 * -0.05, 0.0])


def test_versions(spark):
    files = spark.createDataFrame([("m", "v1.23_model_gbm.RData"), ("m", "v1.24_model_gbm.RData"),
                                   ("m", "notes.txt")], "model string, name string")
    r = resolve_versions(files).collect()[0]
    assert r.current_file == "v1.24_model_gbm.RData" and r.next_file == "v1.25_model_gbm.RData"


def test_rare_levels(spark):
    df = spark.createDataFrame([("A",)] * 995 + [("B",)] * 5, "lvl string")
    got = dict(rows(pool_rare_levels(df, df, "lvl", 0.01, out="pooled").distinct(), "lvl", "pooled"))
    assert got == {"A": "A", "B": "other"}


def test_team_fanout(spark):
    summary = spark.createDataFrame([("a", 2.0)], "name string, mdn_votes double")
    players = spark.createDataFrame([(1, "a", "X"), (1, "a", "Y")],
                                    "player_id long, name string, player_team string")
    assert sorted(rows(team_top_k(summary, players), "player_team")) == [("X",), ("Y",)]


def test_short_podium(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.3), (1, "c", 0.0), (2, "only", 0.2), (3, "none", 0.0)],
                               "c long, name string, p double")
    got = {r.c: (r.v3, r.v2, r.v1, r.combo) for r in modal_podiums(df, "c", "name", "p", 50, seed=1).collect()}
    assert got[1][2] is None and got[1][3] in ("a > b", "b > a")
    assert got[2] == ("only", None, None, "only") and 3 not in got


def test_same_name_twice(spark):
    df = spark.createDataFrame([(1, "a", 0.1), (1, "a", 0.2), (1, "b", 0.05)],
                               "c long, name string, p double")
    votes = sample_votes(df, "c", "name", "p", 200, seed=2)
    per_sim = votes.groupBy("sim").agg(F.count("*").alias("n"),
                                       F.count_distinct("name").alias("d"))
    assert per_sim.filter("n != d").count() == 0
    assert per_sim.filter("n != 2").count() == 0
    # "a" carries weight 30 against 5
    first = votes.filter("votes = 3").groupBy("name").count()
    share_a = dict(rows(first, "name", "count"))["a"] / 200
    assert 0.75 < share_a < 0.95


def _by_hand(votes, k=3):
    """(totals, modal podium per contest) from collected vote rows."""
    from collections import Counter, defaultdict
    totals, podium = Counter(), defaultdict(dict)
    for r in votes:
        totals[r.name, r.sim] += r.votes
        podium[r.c, r.sim][r.votes] = r.name
    texts = defaultdict(Counter)
    for (c, _), places in podium.items():
        texts[c][" > ".join(places[v] for v in range(k, 0, -1) if v in places)] += 1
    return totals, {c: min(t, key=lambda x: (-t[x], x)) for c, t in texts.items()}


def _crowd(spark, hot=300):
    """Small contests and one hot contest that holds most names."""
    rows_ = [(c, f"n{i}", 0.05 * (i + 1)) for c in range(12) for i in range(c % 5 + 1)]
    rows_ += [(99, f"h{i:03d}", 0.01 * (1 + i % 7)) for i in range(hot)]
    return spark.createDataFrame(rows_, "c long, name string, p double")


def test_outputs_agree_and_a_split_contest_changes_nothing(spark, monkeypatch):
    from medalcast.operators import sampling
    df = _crowd(spark)
    votes = sample_votes(df, "c", "name", "p", 300, seed=8)
    whole = sorted(rows(votes, "sim", "c", "name", "votes"))
    monkeypatch.setattr(sampling, "CHUNK", 40)          # the hot contest is split by name
    monkeypatch.setattr(sampling, "SIM_BLOCK", 70)
    for _ in range(2):
        assert sorted(rows(sample_votes(df, "c", "name", "p", 300, seed=8), "sim", "c", "name", "votes")) == whole
        totals, modal = _by_hand(votes.collect())
        got = {(r.name, r.sim): r.total_votes for r in season_totals(df, "c", "name", "p", 300, seed=8).collect()}
        assert got == dict(totals) == {(r.name, r.sim): r.total_votes for r in sim_totals(votes).collect()}
        assert {r.c: r.combo for r in modal_podiums(df, "c", "name", "p", 300, seed=8).collect()} == modal
        monkeypatch.setattr(sampling, "CHUNK", 1)       # every contest of two names or more is split
    assert season_totals(df.limit(0), "c", "name", "p", 5).count() == 0


def test_streams_of_names_are_independent():
    """Streams that share one state word, or are one step apart, aren't correlated."""
    import numpy as np
    from medalcast.operators.sampling import stream_uniforms
    sims = np.arange(1, 20001)
    step = (77 + 0x9E3779B9) & 0xFFFFFFFF
    u = stream_uniforms(np.array([77, 77, step, 78]), np.array([5, 6, 6, 5]), sims)
    assert u.min() > 0 and u.max() < 1
    c = np.corrcoef(u)
    assert np.abs(c - np.eye(4)).max() < 0.03
    lag = np.corrcoef(u[0, 1:], u[2, :-1])[0, 1]       # the shifted stream of another name
    assert abs(lag) < 0.03 and abs(u.mean() - 0.5) < 0.01


def test_missing_scores_get_no_award(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 1, nan), (1, 2, 0.5), (1, 3, None), (1, 4, 0.1), (2, 1, None), (3, 1, nan), (3, 2, -1.0)],
                               "c long, i long, s double")
    got = sorted(rows(award_votes(df, "c", "s", ["c", "i"]), "c", "i", "votes"))
    assert got == [(1, 2, 2), (1, 4, 1), (3, 2, 1)]
    x = spark.createDataFrame([(nan,), (None,), (9.0,)], "x double")
    assert [r[0] for r in x.select(clamp_curve("x", [0.1, 0.2], 3.5, 0.975)).collect()] == [None, None, 0.975]


def test_modal_podiums_of_many_names_and_places(spark):
    """Podium codes of 3,900 names and six places don't fit 64 bits as one number."""
    df = spark.createDataFrame([("c", f"n{i:04d}", 9.0 if i < 6 else 0.01) for i in range(3900)] + [("d", "x", 0.5)], "c string, name string, p double")
    got = {r.c: r for r in modal_podiums(df, "c", "name", "p", 40, k=6, seed=2).collect()}
    votes = sample_votes(df, "c", "name", "p", 40, k=6, seed=2).collect()
    podiums = {}
    for r in votes:
        podiums.setdefault((r.c, r.sim), {})[r.votes] = r.name
    for c in ("c", "d"):
        texts = [" > ".join(v[x] for x in sorted(v, reverse=True)) for (k, _), v in podiums.items() if k == c]
        most = max(texts.count(t) for t in texts)
        assert got[c].combo == min((t for t in texts if texts.count(t) == most), key=str.encode)
    assert got["d"].v6 == "x" and got["d"].v5 is None


def test_one_pass_equals_long_votes_with_split_contests(spark, monkeypatch):
    import random
    rng = random.Random(3)
    rows = [(c, f"p{i}", rng.random()) for c in range(12) for i in range(rng.randrange(1, 9))] + [(99, f"q{i}", rng.random()) for i in range(60)]
    df = spark.createDataFrame(rows, "c long, name string, p double")
    monkeypatch.setattr(sampling, "CHUNK", 16)
    monkeypatch.setattr(sampling, "HELD", 500)           # a task gives its sums out several times
    votes = sample_votes(df, "c", "name", "p", 300, seed=5).groupBy("name", "sim").agg(F.sum("votes").alias("v"))
    want = {(r.name, r.sim): r.v for r in votes.collect()}
    totals, podiums = sampling.season_tables(df, "c", "name", "p", 300, seed=5)
    assert {(r.name, r.sim): r.total_votes for r in totals.collect()} == want
    alone = {r.c: r.combo for r in modal_podiums(df, "c", "name", "p", 300, seed=5).collect()}
    assert {r.c: r.combo for r in podiums.collect()} == alone and 99 in alone


def test_a_killed_season_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    rows = [(c, f"p{i}", 0.1 * (i + 1)) for c in range(9) for i in range(c + 1)]
    df = spark.createDataFrame(rows, "c long, name string, p double")
    whole_totals, whole_podiums = sampling.season_tables(df, "c", "name", "p", 70, seed=4, batch=20, path=str(tmp_path / "a"))
    want = sorted(map(tuple, whole_totals.collect())), sorted(map(tuple, whole_podiums.collect()))
    plain = sampling.season_tables(df, "c", "name", "p", 70, seed=4)
    assert want == (sorted(map(tuple, plain[0].collect())), sorted(map(tuple, plain[1].collect())))
    draws, calls = sampling.season_draws, []

    def dies(weights, *args, **kw):
        calls.append(args[-1])
        if len(calls) == 3:
            raise KeyboardInterrupt
        return draws(weights, *args, **kw)
    monkeypatch.setattr(sampling, "season_draws", dies)
    with pytest.raises(KeyboardInterrupt):
        sampling.season_tables(df, "c", "name", "p", 70, seed=4, batch=20, path=str(tmp_path / "b"))
    # what a batch left half-written is replaced
    done = tmp_path / "b" / "k3-seed4-batch20" / "sims-21-40"
    (done / "_SUCCESS").unlink()
    totals, podiums = sampling.season_tables(df, "c", "name", "p", 70, seed=4, batch=20, path=str(tmp_path / "b"))
    assert (sorted(map(tuple, totals.collect())), sorted(map(tuple, podiums.collect()))) == want
    assert calls == [1, 21, 41, 21, 41, 61]              # the first batch was kept
