"""WARC archives, conversation repair and tokenizer alignment against brute force, and their defined results on hard rows."""

import hashlib
import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from medalcast.llm import align, repair, warc  # noqa: E402
from medalcast.llm.queries import BYTE_BPE_PATH, LLM_QUERIES  # noqa: E402
from medalcast.llm.stage import Scratch  # noqa: E402

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, record_id string, digest string"
TURNS = "conv_id long, turn long, role string, text string, pos long, copies string"


def _all(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# ---- archives ----

HARD_PAGES = [(5, "http://a/\r\nX: y", "<p>one</p>"), (3, "http://b/", "<p>one</p>"), (3, "http://b/", "<p>one</p>"), (9, None, None), (2, "", ""),
              (7, "http://c/", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (8, "http://c/WARC/1.0", "WARC/1.0\r\n\r\n" * 3), (None, "http://d/", "<p>one</p>"),
              (11, "http://e/", "é😀 " * 200_000), (12, "http://e/", "é😀 " * 200_000), (20, "http://f/", "\x00\r\n")]


def test_archives_match_brute_force_on_hard_pages(spark):
    df = spark.createDataFrame([(*p, "clash", "clash") for p in HARD_PAGES], PAGES).repartition(3)
    for min_bytes in (0, 11):
        got = _all(warc.archive_pages(df, min_bytes=min_bytes), "source_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        want = sorted(brute.first_records([(p[0], p[2]) for p in HARD_PAGES], min_bytes), key=str)
        assert got == want
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_archives_hold_the_payloads_and_fresh_headers(spark):
    base = Scratch(spark, "t").base
    df = spark.createDataFrame([(*p, "", "") for p in HARD_PAGES], PAGES).repartition(2)
    warc.write_archives(warc.records_of(df, date="2020-01-01T00:00:00Z"), f"{base}/a")
    back = warc.read_archives(spark, f"{base}/a").collect()
    assert sorted((r["source_id"] or 0, bytes(r["payload"])) for r in back) == sorted((p[0] or 0, (p[2] or "").encode()) for p in HARD_PAGES)
    assert {r["uri"] for r in back} >= {"http://a/%0D%0AX: y", "http://c/WARC/1.0", None}
    assert len({r["record_id"] for r in back}) == len(HARD_PAGES)
    warc.dedupe_archives(spark, f"{base}/a", f"{base}/b", date="2021-01-01T00:00:00Z")
    warc.dedupe_archives(spark, f"{base}/b", f"{base}/c")                      # revisits stay revisits
    rows = warc.read_archives(spark, f"{base}/c").collect()
    stored = {r["record_id"]: r for r in rows if r["record_type"] == "response"}
    assert len(rows) == len(HARD_PAGES)
    for r in rows:
        if r["record_type"] == "revisit":
            of = stored[r["refers_to"]]
            assert of["digest"] == r["digest"] and r["refers_uri"] == of["uri"] and r["refers_date"] == "2020-01-01T00:00:00Z" and bytes(r["payload"]) == b""
    raw = b"".join(bytes(r["content"]) for r in spark.read.format("binaryFile").load(f"{base}/b/*.gz").collect())
    assert raw[:2] == b"\x1f\x8b"


def test_a_broken_archive_raises(spark, tmp_path):
    import gzip
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nshort"))
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_foreign_archives_of_several_members(spark, tmp_path):
    import gzip

    def rec(kind, body, extra=""):
        return gzip.compress(f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{kind}>\r\n{extra}Content-Length: {len(body)}\r\n\r\n{body}\r\n\r\n".encode())
    (tmp_path / "x.warc.gz").write_bytes(rec("warcinfo", "software: x") + rec("resource", "body") + rec("metadata", "body"))
    rows = {r["record_type"]: r for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert bytes(rows["resource"]["payload"]) == b"body" and rows["resource"]["payload_bytes"] == 4 and len(rows) == 3
    out = Scratch(spark, "t").base
    warc.dedupe_archives(spark, str(tmp_path), f"{out}/d")
    assert {r["record_type"] for r in warc.read_archives(spark, f"{out}/d").collect()} == {"warcinfo", "resource", "metadata"}


def test_hot_digest_is_joined_whole(spark, monkeypatch):
    rows = [(i, "http://h/", "same" if i % 3 == 0 else f"own {i % 50}") for i in range(900)]
    df = spark.createDataFrame([(*r, "", "") for r in rows], PAGES)
    monkeypatch.setattr(warc, "HOT", 4)                       # only the large group goes by broadcast
    got = _all(warc.archive_pages(df), "source_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == sorted(brute.first_records([(r[0], r[2]) for r in rows]), key=str)


# ---- conversation repair ----

def _repaired(df):
    cols = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_search_matches_working_backwards():
    rng = random.Random(4)
    for _ in range(1500):
        n = rng.randrange(0, 12)
        rows = [(rng.random() < 0.2, int(rng.random() < 0.2), rng.choice("uuaauas txU")) for _ in range(n)]
        units = [(int(g), 0 if g else c, repair.SYMBOL.get(x, repair.OTHER)) for g, c, x in rows]
        got = repair.search([u[0] for u in units], [u[1] for u in units], [u[2] for u in units])
        assert got == brute.cheapest([(g, 0 if g else c, x) for g, c, x in rows]), rows


def test_chained_blocks_match_the_whole_search():
    rng = random.Random(5)
    for _ in range(300):
        rows = [(int(rng.random() < 0.3), 0, rng.choice([1, 2, 2, 3, 3, 4])) for _ in range(rng.randrange(0, 24))]
        blocks, i = [], 0
        while i < len(rows) or not blocks:
            j = i + rng.randrange(1, 7)
            blocks.append(rows[i:j])
            i = j
        made = [repair._block(0, k, [("r", "t", s, f, c) for f, c, s in b], repair._Stats()) for k, b in enumerate(blocks)]
        ways = repair.chain([m[2] for m in made], [m[3] for m in made])
        got = sum(m[2][w] for m, w in zip(made, ways)), "".join(m[4][w] for m, w in zip(made, ways))
        assert got == repair.search([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]), rows


def _talk(rng, conv, n, base=0):
    out = []
    for t in range(n):
        role = ["user", "assistant"][t % 2] if rng.random() < 0.85 else rng.choice(["system", "tool", "user", "", None, "assistant"])
        text = rng.choice(["Yes.", "No", "", None, " \t", f"w{rng.randrange(40)}!", f"said {t}.", "e" * 300 + "?"])
        out.append((conv, base + t if rng.random() < 0.95 else rng.choice([None, t]), role, text))
    return out


def test_repair_matches_brute_force_with_long_conversations(spark, monkeypatch):
    rng = random.Random(6)
    rows = [r for c in range(60) for r in _talk(rng, c, rng.randrange(1, 9))] + _talk(rng, 100, 900) + _talk(rng, None, 5) + _talk(rng, 101, 30, base=10**12)
    rows += [(102, 1, "user", "Same."), (102, 1, "user", "Same."), (102, 1, "user", "Other."), (102, None, "assistant", "Same.")]
    rows += [(103, 7, "user", "Again.")] * 700
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    monkeypatch.setattr(repair, "BLOCK", 16)
    want = brute.repairs(brute.damaged(rows))
    assert _repaired(repair.repair(repair.damage(df))) == want
    as_is = {}
    for c, t, r, x in rows:
        as_is.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    as_is = {c: sorted(v, key=lambda k: (k[0] is not None, k[0] or 0, k[1], k[2])) for c, v in as_is.items()}
    assert _repaired(repair.repair(repair.intact(df.repartition(7)))) == brute.repairs(as_is)
    assert repair.repair(repair.damage(df.limit(0))).count() == 0


def test_repair_query_over_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = LLM_QUERIES["op12_conversation_repair"](spark, SF).withColumnRenamed("conv_id", "conv")
    assert _repaired(got) == brute.repairs(brute.damaged(rows))


# ---- tokenizer alignment ----

@pytest.fixture(scope="module")
def files():
    with open(BYTE_BPE_PATH, "rb") as a, open(corpus_pipeline.MODEL_PATH, "rb") as b:
        return a.read(), b.read()


@pytest.fixture(scope="module")
def encoders(files):
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    a = Tokenizer.from_str(files[0].decode())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    own = {chr(x): x for x in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    rest = sorted(set(ByteLevel.alphabet()) - set(own))
    own.update(zip(rest, [x for x in range(256) if x not in own.values()]))

    def of_a(t):
        return [(i, bytes(own[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]

    def of_b(t):
        return [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(t)]
    return of_a, of_b


def _aligned(df):
    cols = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return {r["id"]: tuple(r[c] for c in cols) for r in df.collect()}


def _digested(want):
    return {i: (*v[:6], hashlib.sha256(v[6].encode()).hexdigest() if v[0] else "") for i, v in want.items()}


@pytest.mark.parametrize("hot", [align.HOT, 5])
def test_alignment_matches_brute_force_on_hard_texts(spark, files, encoders, hot):
    rng = random.Random(8)
    parts = ["a", "b", " ", "  ", "\n", "é", "😀", "中", "▁", "\x00", "'s", "1", ".", " ", "\x1c", "\x85", "<|endoftext|>", "<s>", "the ", "ﬁ", "\t", "‍", "ö"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(250)]
    texts += [None, "", " ", "  a", "a ", "x" * 3000, "中" * 400, "the the the", "the the the"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "n", "g", 5) for i, t in rows], "doc_id long, text string, row string, pairs string, n long").repartition(3)
    want = _digested(brute.alignments(rows, *encoders))
    assert _aligned(align.align_corpus(df, *files, hot=hot)) == want
    if hot == 5:
        assert align.align_corpus(df.limit(0), *files).count() == 0


def test_alignment_of_given_documents_and_its_memory_reset(spark, files, encoders, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter("length(text) < 6000").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert _aligned(align.align_corpus(df, *files)) == _digested(brute.alignments(rows, *encoders))
    tok = align.Tokenizers(*files)
    whole = align._rows(align._Chunks(tok), [t for _, t in rows])
    monkeypatch.setattr(align, "REMEMBER", 500)
    monkeypatch.setattr(align, "BESIDE", 700)
    chunks = align._Chunks(tok)
    for i, (_, t) in enumerate(rows[:40]):
        stat, text, _, _, _ = align._rows(chunks, [t])
        assert tuple(stat[0]) == tuple(whole[0][i]) and text[0] == whole[1][i]


def test_repeated_ids_are_documents_of_their_own(spark, files):
    df = spark.createDataFrame([(1, "the cat"), (1, "the cat"), (1, "a dog"), (None, "the cat")], "doc_id long, text string")
    rows = align.align_corpus(df, *files).collect()
    assert len(rows) == 4 and sum(r["count_sum"] == 3 * r["n_links"] for r in rows) == 3
