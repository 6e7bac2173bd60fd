"""Operators against brute force, and their defined results on nulls, empties, long texts, ties, repeats and clashing columns."""

import os
import random
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from medalcast.llm import (  # noqa: E402
    chat, components, decontaminate, line_dedup, near_dedup, pieces, quality_model, quality_rules, setsketch, span_dedup,
    textvec, toxicity, url_filter,
)
from medalcast.llm.stage import Scratch  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
MODEL = corpus_pipeline.MODEL_PATH


def words(rng, n, pool=4000):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def hard():
    """Null, empty, blank, one word, ties, exact and near copies, one huge word, a very long text."""
    rng = random.Random(5)
    base = [words(rng, 120) for _ in range(6)]
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "two words"), (7, "x" * 70_000), (8, words(rng, 15_000))]
    for n, b in enumerate(base):
        w = b.split()
        rows += [(100 + 10 * n, b), (101 + 10 * n, b), (102 + 10 * n, " ".join([*w[:60], "other", *w[61:]])),
                 (103 + 10 * n, " ".join(w[:90])), (104 + 10 * n, b.upper() + " ▁ é 😀 </turn> \\")]
    return rows


def test_words_and_grams_match_python():
    texts = ["Hello wOrld", "", None, "a", "ünï cödé É", "x" * 5000 + " y", "a\nb\tc  d"]
    buf, off = textvec.utf8(pa.array(texts))
    old = textvec.PIECE
    for piece in (old, 7):
        textvec.PIECE = piece
        _, _, h, first = textvec.words(buf, off, textvec.SPACED)
        assert np.diff(first).tolist() == [len((t or "").split()) for t in texts]
        if piece == old:
            keep = h
        assert (h == keep).all()
    textvec.PIECE = old
    again = textvec.words(*textvec.utf8(pa.array(["hello WORLD"])), textvec.SPACED)[2]
    assert (again == keep[:2]).all()
    assert textvec.grams(keep[:2], 2)[0] == textvec.whole(keep[:2])


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 900, dtype=np.uint64)
    a, b = x[:600], x[100:]
    reg = setsketch.registers(np.repeat([0, 1, 2], [600, 800, 900]), np.concatenate([a, b, x]), 3)
    assert (np.maximum(reg[0], reg[1]) == reg[2]).all()          # union: register-wise maximum
    est, lead = setsketch.joint_estimate(reg[:1], reg[1:2], np.array([600.0]), np.array([800.0]), 0.85)
    assert abs(est[0] - 500 / 900) < 0.12 and lead[0] > near_dedup.LEAD
    _, near = setsketch.joint_estimate(reg[:1], reg[:1], np.array([600.0]), np.array([600.0]), 0.85)
    assert near[0] == 0
    one = setsketch.registers(np.array([0]), x[:1], 2)
    assert (one[0] > 0).all() and (one[1] == 0).all()


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(200)] + [(None, 4), (7, 7)]
    up = {}
    for a, b in links:
        if a is not None and a != b:
            up.setdefault(a, a), up.setdefault(b, b)

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(df, Scratch(spark, "t")).collect()}
    assert got == {x: top(x) for x in up}
    assert components.connected_components(df.limit(0), Scratch(spark, "t")).count() == 0


def test_near_duplicates(spark, hard):
    rng = random.Random(9)
    chain, rows = words(rng, 300).split(), list(hard)
    for i in range(40):                                   # a large group, each one word further from the first
        rows.append((1000 + i, " ".join(chain)))
        chain[(i * 7) % 300] = f"z{i}"
    out = near_dedup.near_duplicate_classes(frame(spark, rows)).collect()
    want = brute.classes(rows)
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in out} == want
    assert sum(r["id"] != r["component"] for r in out) > 30
    kept = near_dedup.keep_one(frame(spark, [*rows, (None, "null id"), rows[-40]]))
    assert kept.columns == frame(spark, []).columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter({**{i: 1 for i, (_, c) in want.items() if i == c}, None: 1})
    assert near_dedup.near_duplicate_classes(frame(spark, [])).count() == 0


@pytest.mark.parametrize("num", [85, 80])
def test_containment_at_the_limit_in_both_id_orders(spark, num):
    rng = random.Random(num)
    rows = []
    for n, k in enumerate([1, 2, 5, 7, 10]):              # sets of 20k shingles, and of the limit's share of them
        size = 20 * k
        w = [f"d{n}x{i}" for i in range(size + 4)]
        cut = w[:size * num // 100 + 4]
        rows += [(100 * n + 1, " ".join(w)), (100 * n + 2, " ".join(cut))]
        up = [f"u{x}" for x in w]
        rows += [(100 * n + 11, " ".join(up[:len(cut)])), (100 * n + 12, " ".join(up))]
        short = [f"s{x}" for x in w]                      # one shingle less than the limit
        rows += [(100 * n + 21, " ".join(short)), (100 * n + 22, " ".join(short[:len(cut) - 1]))]
    rng.shuffle(rows)
    out = near_dedup.near_duplicate_classes(frame(spark, rows), num=num, band_rows=7 if num == 80 else 8).collect()
    want = brute.classes(rows, num)
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in out} == want
    assert sum(i != c for i, (_, c) in want.items()) == 10
    for a in range(1, 400):                               # no size pair at the limit is ruled out by rounding
        n_a, n_b = np.array([20.0 * a, num / 5 * a]), np.array([num / 5 * a, 20.0 * a])
        reg = np.ones((2, setsketch.M), np.uint16)
        assert np.isfinite(setsketch.joint_estimate(reg, reg, n_a, n_b, num / 100)[1]).all()


@pytest.mark.parametrize("hot, edits", [(0, 5), (7, 8), (near_dedup.HOT, 8)])
def test_large_bucket_needs_cross_pairs(spark, monkeypatch, hot, edits):
    """However many frequent shingles are ranked in place, the classes are those of all pairs."""
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "HOT", hot)
    monkeypatch.setattr(near_dedup, "COUNTED", 500 if hot else 1_000_000)
    rng = random.Random(2)
    base = words(rng, 200).split()
    rows = []
    for i in range(45):                                   # similar to the base, not all to each other
        w = list(base)
        for _ in range(rng.randrange(1, edits)):
            w[rng.randrange(200)] = f"q{rng.randrange(9999)}"
        rows.append((i, " ".join(w)))
    out = near_dedup.near_duplicate_classes(frame(spark, rows)).collect()
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in out} == brute.classes(rows)


def test_line_dedup(spark, hard):
    long = "a line that is long enough to be compared with an edit"
    rows = [*hard, (20, f"{long}\nshort\n\n{long}!\nother"), (21, f" {long}\t\nshort\n{long[:10] + long[11:]}\nshors"),
            (22, long.replace("edit", "edib") + "\nkept line of its own, longer than the bound"), (23, long[:20] + "é" + long[21:])]
    src = frame(spark, [*rows, (None, long)])
    got = {(r["id"], n): r["n_near"] for r in line_dedup.line_report(src).collect() for n in r["removed"]}
    want = brute.removed_lines(rows)
    assert set(got) == want
    assert {(21, 2), (20, 3), (22, 0), (23, 0)} <= want and (21, 3) not in want
    exact = {(r["id"], n) for r in line_dedup.line_report(src, max_edits=0).collect() for n in r["removed"]}
    assert exact == brute.removed_lines(rows, max_edits=0)
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(src, size_col="n_chars").collect()}
    assert out[22]["text"] == "kept line of its own, longer than the bound" and out[22]["n_chars"] == len(out[22]["text"])
    assert out[None]["text"] == long and out[1]["text"] is None and out[2]["text"] == ""
    assert 23 not in out and out[20]["text"] == f"{long}\nshort\n\nother"
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_texts_of_one_id_are_documents_of_their_own(spark):
    rng = random.Random(12)
    a, b = "\n".join(words(rng, 30) + "." for _ in range(4)), "\n".join(words(rng, 30) + "." for _ in range(4))
    docs = frame(spark, [(1, a), (5, a), (5, b)])
    texts = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs).collect())
    assert texts == [(1, a), (5, b)]
    assert sorted((r["id"], len(r["removed"])) for r in line_dedup.line_report(docs).collect()) == [(1, 0), (5, 0), (5, 4)]
    texts = sorted((r["doc_id"], r["text"]) for r in span_dedup.dedup_spans(docs).collect())
    assert texts == sorted([(1, a), (5, ""), (5, b)])
    assert (5, b) in {(r["doc_id"], r["text"]) for r in near_dedup.keep_one(docs).collect()}
    out = docs
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, out, SF)
    assert (5, b) in {(r["doc_id"], r["text"]) for r in out.collect()}


def test_a_line_may_lose_to_one_of_a_character_less(spark):
    short = "abcdefghijklmnopqrstuvw"
    rows = [(1, short), (2, short + "x"), (3, short[:-1] + "y"), (4, "z" + short[1:] + "x")]
    got = {(r["id"], n) for r in line_dedup.line_report(frame(spark, rows)).collect() for n in r["removed"]}
    assert len(short) == line_dedup.MIN_CHARS - 1 and got == brute.removed_lines(rows) == {(2, 0), (4, 0)}


def test_line_dedup_random_edits(spark):
    rng = random.Random(4)
    lines = ["".join(rng.choices("abcdé ", k=rng.randrange(20, 40))).strip() + "." for _ in range(60)]
    rows = []
    for i in range(120):
        x = list(rng.choice(lines))
        for _ in range(rng.randrange(0, 3)):
            p = rng.randrange(len(x))
            x[p:p + rng.randrange(2)] = rng.choice(["", "q", "ü"])
        rows.append((i, "".join(x)))
    got = {(r["id"], n) for r in line_dedup.line_report(frame(spark, rows)).collect() for n in r["removed"]}
    assert got == brute.removed_lines(rows)


def test_decontamination(spark, hard):
    rng = random.Random(6)
    passage = words(rng, 40)
    items = [(1, passage), (2, passage + " more"), (3, "tiny item text"), (4, None), (5, "!!!"), (10, " ".join(passage.split()[5:18])), (None, "x y")]
    w = passage.split()
    rows = [*hard, (30, f"{words(rng, 30)} {passage.upper()} {words(rng, 30)}"), (31, " ".join(w[:12])), (32, " ".join(w[:13]) + " " + words(rng, 400)),
            (33, "Tiny, item; TEXT here"), (34, " ".join([*w[:13], "gap", *w[13:26], *w[3:20]]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.overlaps(rows, [x for x in items if x[0] is not None])
    src = frame(spark, rows)
    for block in (8 << 20, 60):
        got = decontaminate.find_overlaps(src, bench, block_bytes=block).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in got} == want
        assert len(got) == len(rows)
    assert want[30][1] == 40 and want[31][1] == 0 and want[33][2] == ["3"]
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(src.withColumnRenamed("lang", "n_hit"), bench).collect()}
    assert kept == {i for i, (n, hit, _) in want.items() if not (hit and 20 * hit >= n)}
    assert decontaminate.find_overlaps(src, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.find_overlaps(frame(spark, []), bench).count() == 0


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(MODEL)


def test_pieces(spark, model, hard):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    rows = [*hard, (50, "plain words here"), (51, "  two  spaces "), (52, "▁ literal"), (53, "日本語 😀\r\n"), (54, "a" * 100), (None, "null id")]
    src = frame(spark, rows).withColumnRenamed("lang", "decoded2")
    plain = {r["doc_id"]: r["pieces"] for r in pieces.encode(src, model, dropout=0.0).collect()}
    for i, t in rows:
        if t and t == t.strip() and "  " not in t and "▁" not in t:
            assert plain[i] == sp.encode(t), i
    assert plain[1] is None and plain[2] == []
    for dropout in (0.1, 0.7, 1.0):
        out = pieces.decode(pieces.encode(src, model, dropout=dropout), model).collect()
        assert all(r["decoded"] == r["text"] for r in out) and len(out) == len(rows)
    a, b, c = ([r["pieces"] for r in pieces.encode(src.repartition(p).orderBy("doc_id"), model, seed=s).collect()]
               for p, s in ((3, 1), (7, 1), (3, 2)))
    assert a == b and a != c and a != [plain[i] for i in sorted(plain, key=lambda x: (x is not None, x or 0))]
    assert pieces.encode(frame(spark, []), model).count() == 0
    with pytest.raises(ValueError):
        pieces.encode(src, model, dropout=2)


def test_pieces_remembering_and_paths_agree(model, monkeypatch):
    v = pieces.Vocabulary(model)
    rng = random.Random(8)
    texts = ["".join(rng.choices(["the", " ", "ing", "é", "▁", "\n", "zq", "日", "0", "-"], k=rng.randrange(0, 60))) for _ in range(200)]
    buf, off = textvec.utf8(pa.array(texts))
    ids, counts = pieces.Encoder(v, 3, 0.2).rows(buf, off, np.arange(200))
    data, at = pieces.decode_rows(v, ids.astype(np.int64), counts)
    assert data.tobytes() == buf.tobytes() and (at == off).all()
    monkeypatch.setattr(pieces, "REMEMBER", 3)
    monkeypatch.setattr(pieces, "WIDE", 2)                       # the heap instead of the table
    enc = pieces.Encoder(v, 3, 0.2)
    parts = [enc.rows(buf[off[i]:off[i + 1]], np.array([0, off[i + 1] - off[i]]), np.array([i]))[0] for i in range(200)]
    assert (np.concatenate(parts) == ids).all()
    bad = np.frombuffer(b"ok \xff\xfe text", np.uint8)
    ids, counts = pieces._by_row(enc, bad, np.array([0, len(bad)]), np.array([1]))
    assert pieces.decode_rows(v, ids.astype(np.int64), counts)[0].tobytes() == bad.tobytes()


def test_every_occurrence_of_a_word_draws_its_own_merges(model):
    v = pieces.Vocabulary(model)
    word = " international"
    n = 3000
    buf = np.frombuffer((word * n).encode(), np.uint8)
    enc = pieces.Encoder(v, 17, 0.1)
    ids, _ = enc.rows(buf, np.array([0, len(buf)]), np.array([5]))
    again, _ = enc.rows(buf, np.array([0, len(buf)]), np.array([5]))       # all words remembered by now
    assert (ids == again).all()
    other, _ = enc.rows(buf, np.array([0, len(buf)]), np.array([6]))
    assert len(other) != len(ids) or (other != ids).any()
    text = pieces.decode_rows(v, ids.astype(np.int64), np.array([len(ids)]))[0].tobytes()
    assert text == buf.tobytes()
    seen, now = Counter(), []
    raw = [v.bytes[v.bytes_at[i]:v.bytes_at[i + 1]].tobytes() for i in ids]
    for i, b in zip(ids.tolist(), raw, strict=True):
        if b.startswith(b" ") and now:
            seen[tuple(now)] += 1
            now = []
        now.append(i)
    assert len(seen) > 20
    # the shortcut gives what the plain agenda gives under the same keys
    for text in ("the quick brown fox jumps over it", "word " * 40 + "end"):
        b = np.frombuffer(text.encode(), np.uint8)
        at = np.flatnonzero(np.concatenate([[True], b[:-1] == 0x20]))
        end = np.append(at[1:] - 1, len(b))
        key = pieces.mix(pieces.mix(np.array([9], np.uint64) ^ enc.salt)[0] + at.astype(np.uint64))
        want = [pieces.encode_rows(v, b[i:j], np.array([0, j - i]), key[w:w + 1], 0.1, pad_empty=True)[0]
                for w, (i, j) in enumerate(zip(at, end, strict=True))]
        assert (enc.rows(b, np.array([0, len(b)]), np.array([9]))[0] == np.concatenate(want)).all()


def test_span_dedup(spark, hard):
    rng = random.Random(7)
    passage = ". ".join(words(rng, 17) for _ in range(4)) + "."
    one = words(rng, 60)
    rows = [(1, f"{words(rng, 30)}.\n{passage}\n{words(rng, 20)}."), (2, f"{words(rng, 40)}.\n{passage.upper()}\n{words(rng, 30)}."),
            (3, f"{words(rng, 20)}.\n{one}\nend here."), (4, f"{one}\n{words(rng, 25)}."), (5, words(rng, 200)), (6, None), (7, ""),
            (8, "stock line here.\n" + words(rng, 60)), (9, "stock line here.\n" + words(rng, 60)), (10, "x" * 50_000), (None, passage)]
    out = {r["doc_id"]: r for r in span_dedup.dedup_spans(frame(spark, rows)).collect()}
    texts = dict(rows)
    for i in (1, 3, 5, 6, 7, 8, 9, 10, None):
        assert out[i]["text"] == texts[i] and out[i]["n_removed"] == 0
    assert passage.upper() not in out[2]["text"] and out[2]["cut_words"] == 68
    assert out[2]["text"] == texts[2].replace(passage.upper() + "\n", "")
    assert one not in out[4]["text"] and out[4]["cut_words"] == 60
    cut = "".join(texts[2][a:b] for a, b in zip(out[2]["cut_spans"][::2], out[2]["cut_spans"][1::2]))
    assert cut == passage.upper() + "\n"
    assert span_dedup.dedup_spans(frame(spark, [])).count() == 0


def test_span_dedup_of_any_pieces(spark):
    rng = random.Random(21)
    lists = [" ".join(f"{w}{mark}" for w in words(rng, 60).split()) for mark in ("!!", ",", ";", ".\n")]
    bare = [words(rng, 51) for _ in range(12)]
    rows = [(n, t) for n, t in enumerate(lists)] + [(100 + n, t) for n, t in enumerate(lists)]
    for n, p in enumerate(bare):                          # unpunctuated, starting at any place of an unpunctuated text
        rows += [(200 + n, f"{words(rng, 20 + n)} {p} {words(rng, 30)}"), (300 + n, f"{words(rng, 37 + 3 * n)} {p} {words(rng, 30)}")]
    rows += [(400, " ".join(["spam"] * 200)), (500, "Buy it now, friend. " * 50)]
    out = {r["doc_id"]: r for r in span_dedup.dedup_spans(frame(spark, rows)).collect()}
    for n in range(len(lists)):
        assert out[n]["n_removed"] == 0 and out[100 + n]["text"].strip() == "" and out[100 + n]["cut_words"] == 60
    for n, p in enumerate(bare):
        assert out[200 + n]["n_removed"] == 0 and 20 <= out[300 + n]["cut_words"] <= 51
        cut = "".join(rows_text[a:b] for rows_text in [dict(rows)[300 + n]] for a, b in [out[300 + n]["cut_spans"]])
        assert cut.strip() in p
    least = span_dedup.RUN_WORDS                          # the first run stays whole
    assert out[400]["text"].split() == ["spam"] * least and out[500]["cut_words"] == 200 - least


def test_span_dedup_matches_plain_loops(spark):
    rng = random.Random(77)
    stock = [words(rng, rng.randint(2, 40)) + rng.choice([".", "!", ",", "", "\n"]) for _ in range(40)]
    rows = []
    for n in range(120):
        parts = [rng.choice(stock) if rng.random() < 0.6 else words(rng, rng.randint(1, 50)) + rng.choice([". ", "; ", " ", "\n"])
                 for _ in range(rng.randint(0, 12))]
        if n % 5 == 0:                                    # several consecutive sentences in the same order
            k = rng.randint(0, 30)
            parts += stock[k:k + rng.randint(2, 8)]
        rows.append((n, " ".join(parts)))
    rows += [(500 + n, rows[n][1]) for n in range(0, 40, 4)] + [(900, rows[3][1].upper()), (901, ""), (902, None)]
    for run_words, run_pieces in ((span_dedup.RUN_WORDS, span_dedup.RUN_PIECES), (1, 3), (12, 1)):
        got = span_dedup.dedup_spans(frame(spark, rows), run_words=run_words, run_pieces=run_pieces).collect()
        want = brute.removed_pieces(rows, run_words, run_pieces)
        assert {r["doc_id"]: (r["n_pieces"], r["n_removed"], r["cut_words"], r["text"]) for r in got} == want
        assert sum(x[1] > 0 for x in want.values()) > 20


def test_one_sentence_alone_is_no_run(spark):
    rng = random.Random(5)
    one, two = words(rng, 23) + ".", words(rng, 12) + ".\n" + words(rng, 11) + "."
    rows = [(1, f"{words(rng, 9)}.\n{two}"), (2, f"{words(rng, 9)}.\n{two}"), (3, one), (4, one)]
    out = {r["doc_id"]: r for r in span_dedup.dedup_spans(frame(spark, rows), run_pieces=2).collect()}
    assert out[2]["cut_words"] == 23 and out[1]["n_removed"] == 0
    assert out[4]["n_removed"] == (0 if out[4]["n_pieces"] == 1 else out[4]["n_pieces"])


def test_chat(spark):
    rng = random.Random(1)
    parts = ["#", "### ", "<", "</turn>", "\\", "\n", " ", ": ", ":", "a", "é", "😀", "</tur", "n>"]
    rows = []
    for c in [*range(60), None]:
        for k in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "assistant", None, "sys: ### \\", "a</turn>", ""])
            rows.append((c, k, role, None if rng.random() < 0.1 else "".join(rng.choices(parts, k=rng.randrange(12)))))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat.format_conversations(df.repartition(5))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digest_conversations(done).collect()}
    by = {}
    for c, _, r, t in rows:
        by.setdefault(c, []).append((r, t))
    assert got == {c: brute.conversation(t) for c, t in by.items()}
    assert chat.digest_conversations(chat.format_conversations(df.limit(0))).count() == 0


def test_long_conversation_comes_in_parts(spark, monkeypatch):
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k} " + "x" * 300) for k in range(400)] + [(2, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        done = chat.format_conversations(df)
        assert done.filter("conv_id = 1").count() > 1
        got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digest_conversations(done).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[1] == brute.conversation([(r, t) for c, _, r, t in rows if c == 1])


def test_toxicity(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        s = [words(rng, rng.randrange(5, 15), 300) for _ in range(rng.randrange(3, 9))]
        bad = rng.random() < 0.25
        if bad:
            k = rng.randrange(len(s))
            s[k] += f" {rng.choice(['vile', 'awful', 'nasty'])}"
        rows.append((i, ". ".join(s) + "."))
        labels.append((i, int(bad)))
    rows += [(1000, None), (1001, ""), (1002, "...")]
    lab = spark.createDataFrame([*labels, (2000, None), (None, 1)], "doc_id long, toxic int")
    out = {r["id"]: r for r in toxicity.toxicity(frame(spark, rows), lab).collect()}
    truth, text = dict(labels), dict(rows)
    held = [r["doc_id"] for r in lab.filter(toxicity.held_out()).collect() if r["doc_id"] in truth]
    assert len(held) > 80
    right = sum((out[i]["score"] >= 0.3) == bool(truth[i]) for i in held)
    assert right / len(held) > 0.95
    for i in held:
        if truth[i] and out[i]["score"] >= 0.3:
            a, b = out[i]["offending"][:2]
            assert any(w in text[i].encode()[a:b].decode() for w in ("vile", "awful", "nasty"))
    assert all(out[i]["score"] == 0 for i in (1000, 1001, 1002)) and len(out) == len(rows)
    none = toxicity.toxicity(frame(spark, rows[:5]), lab.limit(0)).collect()
    assert all(0 <= r["score"] < 0.3 for r in none)


def test_toxicity_matches_plain_loops(spark):
    rng = random.Random(23)
    pool = [f"w{chr(97 + n % 26)}{n}" for n in range(60)]
    docs, labels = [], []
    for n in range(150):
        toxic = n % 4 == 0
        said = [" ".join(rng.choices(pool[:40] if not (toxic and k == 1) else pool, k=rng.randint(0, 90)))
                + (" idioti\u0161 MORONS" if toxic and k == 1 else "") for k in range(rng.randint(2, 4))]
        docs.append((n, rng.choice(". |! |?\n|\n".split("|")).join(said)))
        labels.append((n, int(toxic)))
    docs += [(900, ""), (901, None)]
    frames = frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")
    sample = toxicity._sample(*frames, "doc_id", "text", "toxic", 1000)
    leaning = toxicity._leaning(sample)
    assert set(leaning.tolist()) == brute.leaning_features(docs, dict(labels), toxicity.Z)
    vocabulary, bias, weights = toxicity.train(*frames)
    assert 0 < len(vocabulary) <= len(leaning) and (weights != 0).all()
    want = brute.toxic_scores(docs, dict(zip(vocabulary.tolist(), weights.tolist(), strict=True)), bias)
    got = {r["id"]: r["score"] for r in toxicity.score_documents(frames[0], (vocabulary, bias, weights)).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    assert got[900] == got[901] == 0


def test_toxicity_keeps_every_leaning_feature(spark):
    bad = " ".join(f"vile{n:04d}" for n in range(3000))
    docs = [(n, f"{bad}. fine day" if n % 5 == 0 else f"fine day number {n}") for n in range(60)]
    labels = spark.createDataFrame([(n, int(n % 5 == 0)) for n in range(60)], "doc_id long, toxic int")
    sample = toxicity._sample(frame(spark, docs), labels, "doc_id", "text", "toxic", 1000)
    assert len(toxicity._leaning(sample)) > 3000


def good_and_junk(rng, n):
    """Prose, and junk of several kinds; (id, text), ids of the junk."""
    rows, junk = [], set()
    stop = ["the", "of", "and", "to", "in", "that", "is"]
    for i in range(n):
        prose = ".\n".join(" ".join(rng.choice(stop) if rng.random() < 0.3 else f"wo{rng.randrange(3000)}rd" for _ in range(rng.randrange(12, 25)))
                           for _ in range(rng.randrange(6, 12))) + "."
        kind = rng.randrange(12)
        if kind == 0:
            prose = " ".join(["spam offer now"] * 40)
        elif kind == 1:
            prose = " ".join(f"{w}%%% ###" for w in prose.split())
        elif kind == 2:
            prose = " ".join(f"{w}!!" for w in prose.upper().split())
        if kind < 3:
            junk.add(i)
        rows.append((i, prose))
    return rows, junk


def test_quality_rules(spark, hard):
    rows, junk = good_and_junk(random.Random(12), 300)
    extra = [*rows, *[(10_000 + i, t) for i, t in hard], (20_000, "a b c a b c"), (20_001, "x\n\nx\n y\nx")]
    src = frame(spark, extra).withColumnRenamed("lang", "n_words").withColumnRenamed("source", "kept")
    out = {r["id"]: r for r in quality_rules.quality_verdicts(src).collect()}
    for i, t in extra:
        r = out[i]
        m = brute.measures(t)
        assert tuple(r[c] for c in quality_rules.FEATURES[:5]) == m, i
        assert r["base_failed"] == (m[0] < 50 or 100 * m[4] > 50 * m[0])
        assert not (r["kept"] and r["base_failed"])
    assert {i for i, _ in rows if not out[i]["kept"]} == junk
    kept = quality_rules.keep_good(src)
    assert kept.columns == src.columns and {r["doc_id"] for r in kept.collect()} == {i for i in out if out[i]["kept"]}
    assert quality_rules.quality_verdicts(frame(spark, [])).count() == 0


def test_label_model_recovers_accuracies():
    rng = random.Random(13)
    true = [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.9, 0.8]
    pats = Counter()
    for _ in range(20_000):
        y = 1 if rng.random() < 0.7 else -1
        pats[tuple(0 if rng.random() < 0.3 else y if rng.random() < a else -y for a in true)] += 1
    good, acc = quality_rules.fit(list(pats.items()))
    assert abs(good - 0.7) < 0.03 and all(abs(a - t) < 0.03 for a, t in zip(acc, true))


def test_quality_classifier(spark, hard):
    rows, junk = good_and_junk(random.Random(14), 400)
    out = {r["id"]: r for r in quality_model.quality(frame(spark, [*rows, *[(10_000 + i, t) for i, t in hard]])).collect()}
    wrong = {i for i, _ in rows if out[i]["kept"] == (i in junk)}
    assert len(wrong) <= 8, wrong
    assert out[10_001]["score"] == 0 and not out[10_002]["kept"] and len(out) == 400 + len(hard)
    assert quality_model.quality(frame(spark, [])).count() == 0


def test_label_model_matches_plain_em_and_gradient_matches_differences():
    rng = np.random.default_rng(4)
    k = len(quality_model.LABELLERS)
    good = rng.random(3000) < 0.85
    kind = rng.integers(0, 3, 3000)                       # three kinds of junk, each seen by other labellers
    votes = np.ones((3000, k), np.int64)
    for j in range(k):
        votes[good & (rng.random(3000) < 0.5), j] = 2
        votes[good & (rng.random(3000) < 0.005), j] = 0
        votes[~good & (kind == j % 3) & (rng.random(3000) < 0.8), j] = 0
    pattern = votes @ 3 ** np.arange(k)
    model = quality_model.LabelModel(dict(Counter(pattern.tolist())))
    share, rate = 0.8, [[[0.4, 0.5, 0.1], [0.02, 0.5, 0.48]] for _ in range(k)]
    for _ in range(quality_model.EM_ROUNDS):              # over documents instead of pattern counts
        odds = np.log(share / (1 - share)) + sum(np.log(np.array(rate[j][1])[votes[:, j]] / np.array(rate[j][0])[votes[:, j]]) for j in range(k))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        share = min(max(p.mean(), 0.05), 0.99)
        for j in range(k):
            for c, w in ((0, 1 - p), (1, p)):
                seen = [w[votes[:, j] == x].sum() + a for x, a in enumerate((0.5, 1.0, 0.5))]
                r = [x / sum(seen) for x in seen]
                if c and r[0] > quality_model.OBJECTS:
                    r = [quality_model.OBJECTS, *(x * (1 - quality_model.OBJECTS) / (r[1] + r[2]) for x in r[1:])]
                rate[j][c] = r
    assert abs(model.good - share) < 1e-9 and np.allclose(model.rate, rate)
    assert ((model.posterior(pattern) >= 0.5) == good).mean() > 0.97
    y, row, at, value = rng.random(5), rng.integers(0, 5, 30), rng.integers(0, 7, 30), rng.random(30)
    w, bias = rng.normal(size=7), 0.3

    def loss(w, bias):
        z = bias + np.bincount(row, weights=w[at] * value, minlength=5)
        q = 1 / (1 + np.exp(-z))
        return np.mean(y * np.log(q) + (1 - y) * np.log(1 - q)) - quality_model.L2 / 2 * (w ** 2).sum()
    by_w, by_bias = quality_model.gradient(y, bias, w, row, at, value)
    for i in range(7):
        step = np.eye(7)[i] * 1e-6
        assert abs((loss(w + step, bias) - loss(w - step, bias)) / 2e-6 - by_w[i]) < 1e-7
    assert abs((loss(w, bias + 1e-6) - loss(w, bias - 1e-6)) / 2e-6 - by_bias) < 1e-7


def test_quality_scores_rank_given_labels(spark):
    """Labels are read to measure only."""
    sf = "/root/testdata/sf0.01"
    scores = quality_model.quality(spark.read.parquet(f"{sf}/documents.parquet")).join(
        spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("doc_id", "id"), "id").select("score", "quality", "kept").collect()
    bad = [r for r in scores if not r["quality"]]
    good = [r for r in scores if r["quality"]]
    auc = np.mean([(g["score"] > b["score"]) + 0.5 * (g["score"] == b["score"]) for g in good for b in bad])
    assert auc > 0.9
    assert np.mean([r["kept"] for r in good]) > 0.93 and np.mean([r["kept"] for r in bad]) < 0.35


def test_url_filter(spark):
    link = '<a href="{}">x</a>'
    pages = [
        (1, "http://good.example.net/en/a", link.format("https://friend.example.org/x")), (2, "https://friend.example.org/y", ""),
        (3, "http://bad.example.net/shop", ""), (4, "http://farm.example.com/fr/", link.format("http://bad.example.net/shop") * 3),
        (5, "http://other.example.com/en/", None), (6, None, link.format("http://a.b")), (7, "no scheme/x", ""), (8, "http://X.Example.COM/de/q?x=/en/#y", ""),
        (9, "ftp://net", ""), (10, "http://net/", ""), (11, "http://notnet/", ""), (12, "http://u.fr.org/fr/z", ""), (12, "http://u.fr.org/fr/z", ""),
        (None, "http://a.example.net/fr?/en/", ""),
    ]
    pages += [(100 + i, f"http://plain{i}.example.com/en/", "") for i in range(20)]      # what is usual
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = {}
    for r in url_filter.judge_urls(df).collect():
        out.setdefault(r["id"], []).append((r["host"], r["path"], r["rule"], r["verdict"]))
    assert out[1] == [("good.example.net", "/en/a", "example.net/en/", "allow")]
    assert out[2][0][2:] == (None, "allow") and out[3][0][2:] == ("net/", "block")
    assert out[4][0][2:] == (None, "block")                       # links to a blocked host
    assert out[5][0][2:] == (None, "allow")
    assert out[6] == out[7] == [("", "", None, "allow")]
    assert out[8] == [("x.example.com", "/de/q", "example.com/de/", "block")]
    assert out[9] == [("net", "", None, out[9][0][3])] and out[10][0][2:] == ("net/", "block") and out[11][0][2] is None
    assert out[12] == [("u.fr.org", "/fr/z", "org/fr/", "allow")] * 2
    assert out[None] == [("a.example.net", "/fr", "net/", "block")]
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_url_filter_weighs_a_hosts_own_pages(spark):
    def site(host, n_de, n_en, html=""):
        return [(f"http://{host}/de/{i}", html) for i in range(n_de)] + [(f"http://{host}/en/{i}", html) for i in range(n_en)]
    link = '<a href="http://h{}.example.com/x">x</a>'
    rows = site("mixed.example.com", 1, 9) + site("bad.example.com", 9, 1)
    rows += [(f"http://h{i}.example.com/en/", link.format(i + 1)) for i in range(12)] + [("http://h12.example.com/de/", "")]
    for times in (1, 40):                                 # verdicts don't depend on the table's size
        all_rows = [(i, u, h) for i, (u, h) in enumerate(rows * times)]
        out = url_filter.judge_urls(spark.createDataFrame(all_rows, "page_id long, url string, html string")).collect()
        got = {(r["host"], r["path"][:4]): r["verdict"] for r in out}
        assert got["mixed.example.com", "/de/"] == "block" and got["mixed.example.com", "/en/"] == "allow"
        assert got["bad.example.com", "/de/"] == got["bad.example.com", "/en/"] == "block"
        along = [got[f"h{i}.example.com", "/en/"] for i in range(11, -1, -1)]      # from the blocked host away
        assert along[0] == "block" and along[-1] == "allow" and along == sorted(along, reverse=True)
        want = brute.url_verdicts(rows, url_filter.RULES)
        assert {(r["host"], r["path"], r["rule"], r["verdict"]) for r in out} == set(want)


def test_url_verdicts_match_plain_loops_and_decide_on_given_pages(spark):
    for sf in ("0.001", "0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf{sf}/pages.parquet").select("url", "html").collect()]
        df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
        out = {r["id"]: r for r in url_filter.judge_urls(df).collect()}
        assert [(out[i]["host"], out[i]["path"], out[i]["rule"], out[i]["verdict"]) for i in range(len(rows))] == brute.url_verdicts(rows, url_filter.RULES)
        free = [r for r in out.values() if r["rule"] is None]
        assert any(r["verdict"] == "block" for r in free)
        assert all(r["verdict"] == "allow" for r in free if r["trust"] > 0 and not r["distrust"])
        assert sum(r["verdict"] == "block" for r in free) < 0.25 * len(free)


def test_propagation_matches_a_plain_loop(spark):
    rng = random.Random(15)
    links = {(f"h{rng.randrange(12)}", f"h{rng.randrange(12)}"): float(rng.randrange(1, 4)) for _ in range(30)}
    links = {k: w for k, w in links.items() if k[0] != k[1]}
    seeds = {"trust": {"h1": 2.0, "h2": 1.0}, "distrust": {"h3": 1.0}}
    got = {(r["kind"], r["host"]): r["rank"] for r in url_filter.propagate(
        spark.createDataFrame([(a, b, w) for (a, b), w in links.items()], "src string, dst string, w double"),
        spark.createDataFrame([(k, h, w) for k, s in seeds.items() for h, w in s.items()], "kind string, host string, w double"),
        Scratch(spark, "t"), rounds=4).collect()}
    for kind, s in seeds.items():
        edges = links if kind == "trust" else {(b, a): w for (a, b), w in links.items()}
        total = Counter()
        for (a, _), w in edges.items():
            total[a] += w
        seed = {h: w / sum(s.values()) for h, w in s.items()}
        rank = dict(seed)
        for _ in range(4):
            nxt = {h: 0.15 * v for h, v in seed.items()}
            for (a, b), w in edges.items():
                if a in rank:
                    nxt[b] = nxt.get(b, 0) + 0.85 * rank[a] * w / total[a]
            rank = nxt
        assert {h for k, h in got if k == kind} == set(rank)
        assert all(abs(got[kind, h] - v) < 1e-12 for h, v in rank.items())


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    q = {r["id"] for r in quality_rules.quality_verdicts(docs).collect() if r["kept"]}
    rows = [r for r in rows if r[0] in q]
    gone = brute.removed_lines(rows)
    texts = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in rows}
    texts = {i: t for i, t in texts.items() if t.strip(brute.SPACE)}
    texts = {i: texts[i] for i, (_, c) in brute.classes(texts.items(), 80).items() if i == c}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {i: texts[i] for i, (n, hit, _) in brute.overlaps(texts.items(), bench).items() if not (hit and 20 * hit >= n)}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["text"] for r in out} == texts and len(out) == len(texts)
    assert all(r["lossless"] and r["n_chars"] == len(r["text"]) for r in out)


CLASHES = ["id", "no", "line", "gone", "near", "component", "n_hit", "spans", "items", "key", "pieces", "lossless", "n_words", "kept", "quality", "h1"]


@pytest.mark.parametrize("at", range(5))
def test_stages_on_hard_rows_with_clashing_columns(spark, hard, at):
    name, stage = corpus_pipeline.STAGES[at]
    rows = [*hard, (None, "a row without an id"), (None, None), (5, "one"), (104, None)]
    docs = frame(spark, rows)
    for c in CLASHES:
        docs = docs.withColumn(c, docs.n_chars)
    out = stage(spark, docs, SF)
    if at < 4:
        assert out.columns == docs.columns
    else:
        assert out.columns[:len(docs.columns)] == docs.columns and out.count() == len(rows)
    got = out.collect()
    assert {(r["doc_id"], r["text"]) for r in got} <= {(i, t) for i, t in rows} or at == 1
    empty = stage(spark, docs.limit(0), SF)
    assert empty.count() == 0 and empty.columns == out.columns
