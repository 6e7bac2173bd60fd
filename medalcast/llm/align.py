"""Cross-tokenizer alignment: byte groups and links between the tokens of two tokenizers over one text.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library, B a
SentencePiece model with byte fallback. Both read the text with one space in
front (B adds its own). The spans that the libraries report are coarse cuts:
A's are character offsets, so tokens inside a multibyte character share one,
and B's byte-fallback pieces have empty spans up to the last. A token whose span
is whole ends where its span does; any other is refined by counting the decoded
bytes of its tokens on from the last whole span. Byte offsets where tokens of
both end cut the text into groups; an A and a B token are linked where their
byte ranges overlap. A text that either tokenizer doesn't give back byte for
byte has no tokens.

No piece of B holds a space behind another character, and A's pattern starts a
new word at a space between two other characters, so neither merges across such
a space. A text is cut there; a task keeps the alignment of up to ``REMEMBER``
bytes' worth of distinct chunks, and texts are put together from them by
vectorised look-ups. (If a model doesn't hold to that, texts stay whole.)

Corpus counts: a pair of ids counts the documents that hold it linked. Each
document's distinct pairs are written once, packed; counts are summed per task
before the shuffle. Pairs with more than 1 / ``HOT`` of all such links (at most
``HOT`` pairs, whatever the corpus) are sent to the tasks that sum over their
documents; the rarer ones, of which none is a large share, are joined by
shuffle. Nothing is capped: every link gets its exact count.

sentencepiece 0.2.2 and later calls the immutable proto ``proto``.

Cases: null and empty texts, texts of invalid UTF-8 and texts that don't come
back byte for byte have no tokens: zeros and ''. Repeated rows and ids are rows
of their own, each a document in the counts. Other columns are ignored. An
empty table gives an empty one.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .pieces import _once
from .stage import Scratch

HOT = 200_000            # pairs above 1 / HOT of all links are looked up in the task; there are fewer than HOT
REMEMBER = 8 << 20       # bytes of distinct chunks a worker keeps, counting 8 a chunk; about 20 times that in memory
BESIDE = 1 << 20         # and of later ones, before they are forgotten
SLICE = 1 << 20          # bytes of text worked on at once
COUNTED = 2_000_000      # pairs gathered before they are summed
#: a space between two characters that are not white space
CUT = re.compile(r"(?<=\S) (?=\S)")


def _byte_level() -> dict[str, int]:
    """The printable character of each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(0x100 + i): b for i, b in enumerate(rest)}}


class Tokenizers:
    """Both tokenizers, with the decoded bytes of each id."""

    def __init__(self, a_json: bytes, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte = _byte_level()
        n_a, n_b = self.a.get_vocab_size(with_added_tokens=True), self.b.vocab_size()
        words = [self.a.id_to_token(i) or "" for i in range(n_a)]
        # a special token is never encoded, so its bytes don't matter
        self.a_bytes = [bytes(byte[c] for c in w) if all(c in byte for c in w) else w.encode() for w in words]
        pieces = [self.b.id_to_piece(i) for i in range(n_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.n_b = n_b
        self.flat = [(np.frombuffer(b"".join(t), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in t])])) for t in (self.a_bytes, self.b_bytes)]
        self.n_text = max(n_a, n_b)
        #: decimal ids, once for each mark that may follow them
        self.text = np.array([f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(self.n_text)], object)
        pre = (json.loads(a_json).get("pre_tokenizer") or {})
        regular = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        plain = json.loads(a_json).get("normalizer") is None
        self.cuts = bool(regular and plain and not any("▁" in p.lstrip("▁") for p in pieces)
                         and not any(self.b.is_unused(i) and "▁" in p for i, p in enumerate(pieces)))


def refine(size: np.ndarray, coarse: np.ndarray, whole: np.ndarray, first: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Byte end of each token.

    ``size``: decoded bytes; ``coarse``: byte end of its span, right where ``whole``;
    ``first``: index of the first token of its text; ``start``: byte where that text starts.
    """
    total = np.cumsum(size)
    last = np.maximum.accumulate(np.where(whole, np.arange(len(size)), -1))
    held = last >= first
    before = np.where(first > 0, total[first - 1], 0)
    return total + np.where(held, coarse[last] - total[last], start - before)


def _ragged(at: np.ndarray, idx: np.ndarray) -> np.ndarray:
    """Positions of the entries of each ``idx`` in a flat array with offsets ``at``."""
    n = at[idx + 1] - at[idx]
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at[idx] - (ends - n), n)


def _same(ids: np.ndarray, row: np.ndarray, data: np.ndarray, data_at: np.ndarray, want: np.ndarray, want_at: np.ndarray) -> np.ndarray:
    """Whether the decoded bytes of each row's tokens are the wanted ones."""
    n = len(want_at) - 1
    size = np.bincount(row, weights=(data_at[ids + 1] - data_at[ids]), minlength=n).astype(np.int64)
    fits = size == np.diff(want_at)
    mine = data[_ragged(data_at, ids if fits.all() else ids[fits[row]])]
    which = np.arange(n) if fits.all() else np.flatnonzero(fits)
    theirs = want if fits.all() else want[_ragged(want_at, which)]
    wrong = np.flatnonzero(mine != theirs)
    if len(wrong):
        ends = np.cumsum(size[which])
        fits[which[np.unique(np.searchsorted(ends, wrong, side="right"))]] = False
    return fits


def align(tok: Tokenizers, texts: list[str]):
    """Alignments of ``texts`` (none empty), each with a space in front.

    Returns (rows of n_a, n_b, n_groups, n_links; whether it comes back byte for byte;
    the groups' text; flat pair keys a * vocabulary of B + b of all links; their offsets).
    """
    n = len(texts)
    joined = [" " + t for t in texts]
    raw = [t.encode("utf-8") for t in joined]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    char_at = np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf))          # byte where each character starts
    chars = np.concatenate([[0], np.cumsum([len(t) for t in joined])]).astype(np.int64)

    enc = tok.a.encode_batch(joined, add_special_tokens=False)
    a_ids = [e.ids for e in enc]
    na = np.array([len(x) for x in a_ids], np.int64)
    a_row = np.repeat(np.arange(n), na)
    a = np.fromiter(chain.from_iterable(a_ids), np.int64, int(na.sum()))
    offsets = chain.from_iterable(chain.from_iterable(e.offsets for e in enc))
    span = np.fromiter(offsets, np.int64, 2 * len(a)).reshape(-1, 2)
    proto = tok.b.encode(texts, return_type="proto", num_threads=1)
    nb = np.array([len(x.pieces) for x in proto], np.int64)
    b_row = np.repeat(np.arange(n), nb)
    b, b_span = np.fromiter((v for x in proto for p in x.pieces for v in (p.id, p.end)), np.int64, 2 * int(nb.sum())).reshape(-1, 2).T

    def last_of_row(row):
        return np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)

    # A: a span is whole if no other token has a part of its last character
    a_first = (np.cumsum(na) - na)[a_row]
    shared = np.append(span[1:, 0] < span[:-1, 1], False) & ~last_of_row(a_row)
    a_end = refine(tok.a_len[a], char_at[chars[a_row] + span[:, 1]], ~shared & (span[:, 1] > span[:, 0]), a_first, at[a_row])
    # B: byte spans, one behind the other, over the text without the space in front; all but the last byte piece of a character are empty
    b_first = (np.cumsum(nb) - nb)[b_row]
    b_begin = np.where(np.arange(len(b)) == b_first, 0, np.append(0, b_span[:-1]) if len(b) else b_span)
    b_end = refine(tok.b_len[b], at[b_row] + 1 + b_span, b_span > b_begin, b_first, at[b_row])

    ok = _same(a, a_row, *tok.flat[0], buf, at) & _same(b, b_row, *tok.flat[1], buf, at)
    if not ok.all():
        ka, kb = ok[a_row], ok[b_row]
        a, a_end, a_row, b, b_end, b_row = a[ka], a_end[ka], a_row[ka], b[kb], b_end[kb], b_row[kb]
        na, nb = np.where(ok, na, 0), np.where(ok, nb, 0)

    near = np.searchsorted(b_end, a_end)                     # both ascend
    cuts = a_end[b_end[near] == a_end] if len(b_end) else a_end[:0]      # ends of texts among them
    ga, gb = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
    groups = np.bincount(np.searchsorted(at, cuts, side="left") - 1, minlength=n) if len(cuts) else np.zeros(n, np.int64)
    # links: B tokens that end behind an A token's start and start before its end
    a_start, b_start = (np.concatenate([[0], e[:-1]]) if len(e) else e for e in (a_end, b_end))
    for s, row in ((a_start, a_row), (b_start, b_row)):
        if len(s):
            new = np.append(True, row[1:] != row[:-1])
            s[new] = at[row[new]]
    lo, hi = np.searchsorted(b_end, a_start, side="right"), np.searchsorted(b_start, a_end, side="left")
    n_links = hi - lo
    ends = np.cumsum(n_links)
    j = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(lo - (ends - n_links), n_links)
    keys = np.repeat(a, n_links) * tok.n_b + b[j]
    per = np.bincount(a_row, weights=n_links, minlength=n).astype(np.int64)

    # the groups' text: ids in order of (group, side), each with what follows it
    size = len(cuts)
    ca, cb = np.bincount(ga, minlength=size), np.bincount(gb, minlength=size)
    out = np.empty(len(a) + len(b), object)
    behind_a = np.cumsum(cb) - cb
    before_b = np.cumsum(ca)
    ends_a = np.append(ga[1:] != ga[:-1], True) if len(ga) else np.zeros(0, bool)
    ends_b = np.append(gb[1:] != gb[:-1], True) if len(gb) else np.zeros(0, bool)
    close = last_of_row(b_row)
    out[np.arange(len(a)) + behind_a[ga]] = tok.text[a + tok.n_text * ends_a]
    out[np.arange(len(b)) + before_b[gb]] = tok.text[b + tok.n_text * np.where(close, 3, 2 * ends_b)]
    out = out.tolist()
    edge = np.concatenate([[0], np.cumsum(na + nb)])
    text = ["".join(out[edge[k]:edge[k + 1]]) for k in range(n)]
    return (np.stack([na, nb, groups, per], axis=1), ok, text, keys, np.concatenate([[0], np.cumsum(per)]))


class _Chunks:
    """Alignments of the chunks seen by a worker, looked up by chunk."""

    def __init__(self, tok: Tokenizers):
        self.tok = tok
        self.known, self.text, self.n, self.used, self.weight = {}, [], 0, 0, 0
        self.stat, self.ok = np.zeros((1024, 4), np.int32), np.zeros(1024, bool)
        self.at, self.keys = np.zeros(1025, np.int64), np.zeros(4096, np.uint32)
        self.kept, self.beside, self.later = None, 0, []

    def _room(self, rows, keys):
        def grown(x, need):
            if need <= len(x):
                return x
            y = np.zeros((max(need, len(x) * 3 // 2), *x.shape[1:]), x.dtype)
            y[:len(x)] = x
            return y
        self.stat, self.ok = grown(self.stat, self.n + rows), grown(self.ok, self.n + rows)
        self.at, self.keys = grown(self.at, self.n + rows + 1), grown(self.keys, self.used + keys)

    def _forget(self):
        """Once the first chunks fill the memory, drop the later ones when they do."""
        if self.kept is None:
            if self.weight > REMEMBER:
                self.kept = self.n, self.used
        elif self.beside > BESIDE:
            for c in self.later:
                del self.known[c]
            self.n, self.used = self.kept
            del self.text[self.n:]
            self.later, self.beside = [], 0

    def find(self, chunks: list[str]) -> np.ndarray:
        self._forget()
        known = self.known
        fresh = [c for c in dict.fromkeys(chunks) if c not in known]
        if fresh:
            collects = gc.isenabled()
            gc.disable()                  # nothing made here is cyclic, and a collection walks all that is kept
            try:
                self._add(fresh)
            finally:
                if collects:
                    gc.enable()
        return np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))

    def _add(self, fresh: list[str]) -> None:
        for i in range(0, len(fresh), 10_000):
            part = fresh[i:i + 10_000]
            stat, ok, text, keys, at = align(self.tok, part)
            self._room(len(part), len(keys))
            self.stat[self.n:self.n + len(part)], self.ok[self.n:self.n + len(part)] = stat, ok
            self.keys[self.used:self.used + len(keys)] = keys
            self.at[self.n + 1:self.n + len(part) + 1] = at[1:] + self.used
            self.known.update(zip(part, range(self.n, self.n + len(part)), strict=True))
            self.text += text
            self.n, self.used = self.n + len(part), self.used + len(keys)
            weight = sum(map(len, part)) + 8 * len(part)
            if self.kept is None:
                self.weight += weight
            else:
                self.beside += weight
                self.later += part


def _rows(chunks: _Chunks, texts: list):
    """(n_a, n_b, n_groups, n_links; groups text or None; packed distinct pairs) of each text."""
    flat, ends, n = [], [], 0
    for t in texts:
        if t:
            parts = CUT.split(t) if chunks.tok.cuts else [t]
            flat += parts
            n += len(parts)
        ends.append(n)
    ends = np.array(ends, np.int64)
    idx = chunks.find(flat)
    starts = ends - np.diff(ends, prepend=0)
    bad = np.concatenate([[0], np.cumsum(~chunks.ok[idx])])
    good = (bad[ends] == bad[starts]) & (ends > starts)
    stat = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(chunks.stat[idx], axis=0, dtype=np.int64)])
    stat = np.where(good[:, None], stat[ends] - stat[starts], 0)
    where = idx.tolist()
    text = [";".join([chunks.text[i] for i in where[s:e]]) if g else None for s, e, g in zip(starts.tolist(), ends.tolist(), good.tolist(), strict=True)]
    row_of = np.repeat(np.arange(len(texts)), ends - starts)
    keep = good[row_of]
    per = (chunks.at[idx + 1] - chunks.at[idx])[keep]
    keys = chunks.keys[_ragged(chunks.at, idx[keep])]
    both, mult = np.unique((np.repeat(row_of[keep], per).astype(np.uint64) << np.uint64(32)) | keys, return_counts=True)
    return stat, text, (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.uint32), mult.astype(np.uint32)


def _pack(z, keys: np.ndarray, mult: np.ndarray) -> bytes:
    """Ascending keys as differences, and their multiplicities, by byte planes."""
    both = np.concatenate([np.diff(keys, prepend=np.uint32(0)), mult]).astype(np.uint32)
    return z.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(z, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(z.decompress(packed), np.uint8)
    both = np.ascontiguousarray(flat.reshape(4, -1).T).view(np.uint32).ravel()
    n = len(both) // 2
    return np.cumsum(both[:n], dtype=np.uint32), both[n:]


def _texts(col: pa.Array) -> list:
    try:
        return col.to_pylist()
    except UnicodeDecodeError:
        def read(x):
            try:
                return x and x.decode("utf-8")
            except UnicodeDecodeError:
                return None
        return [read(x) for x in col.cast(pa.binary()).to_pylist()]


def tokens(docs: DataFrame, a_json: bytes, b_model: bytes, id_col: str = "doc_id", text_col: str = "text",
           with_groups: bool = False) -> DataFrame:
    """(row, id, n_a, n_b, n_groups, n_links, groups_sha256, pairs[, groups]) of every document.

    ``row`` is unique; ``pairs`` are the packed distinct pairs; ``groups`` the text that is hashed.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((a_json, b_model))                  # two vocabulary files
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))
    schema = ("row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
              + (", groups string" if with_groups else ""))

    def run(batches):
        chunks = _once(("align", *held.value), lambda: _Chunks(Tokenizers(*held.value)))
        z = zstandard.ZstdCompressor(level=1)
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            _, off = tv.utf8(b.column(1))
            for i, j in tv.slices(off, SLICE):
                s = b.slice(i, j - i)
                stat, text, at, keys, mult = _rows(chunks, _texts(s.column(1)))
                cut = np.searchsorted(at, np.arange(len(s) + 1))
                packed = [_pack(z, keys[x:y], mult[x:y]) if y > x else None for x, y in zip(cut[:-1], cut[1:], strict=True)]
                sha = [hashlib.sha256(t.encode()).hexdigest() if t is not None else "" for t in text]
                cols = [pa.array(np.arange(row, row + len(s))), s.column(0), *(pa.array(stat[:, k]) for k in range(4)), pa.array(sha), pa.array(packed, pa.binary())]
                if with_groups:
                    cols.append(pa.array([t or "" for t in text]))
                row += len(s)
                yield pa.RecordBatch.from_arrays(cols, names=[f.strip().split(" ")[0] for f in schema.split(",")])
    return src.mapInArrow(tv.lean(run), schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(key, n): how many rows hold each pair linked; summed in the task before the shuffle."""
    def run(batches):
        z = zstandard.ZstdDecompressor()
        keys, counts, waiting, size = np.zeros(0, np.uint32), np.zeros(0, np.int64), [], 0

        def summed():
            k, inverse = np.unique(np.concatenate([keys, *waiting]), return_inverse=True)
            weight = np.concatenate([counts, np.ones(size, np.int64)])
            return k, np.bincount(inverse, weights=weight, minlength=len(k)).astype(np.int64)

        def batch(k, c):
            return pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(c)], names=["key", "n"])
        for b in batches:
            for packed in b.column(0).to_pylist():
                if packed is not None:
                    waiting.append(_unpack(z, packed)[0])
                    size += len(waiting[-1])
                if size > COUNTED:
                    keys, counts = summed()
                    waiting, size = [], 0
                    if len(keys) > 2 * COUNTED:             # a task of very many pairs gives them in parts
                        yield batch(keys, counts)
                        keys, counts = keys[:0], counts[:0]
        keys, counts = summed()
        for i in range(0, len(keys), 100_000):
            yield batch(keys[i:i + 100_000], counts[i:i + 100_000])
    return aligned.select("pairs").mapInArrow(tv.lean(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def align_corpus(docs: DataFrame, a_json: bytes, b_model: bytes, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    ``n_best``: links whose pair has its A id's highest count; ``count_sum``: counts summed over links.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "align")
    n_b = Tokenizers(a_json, b_model).n_b
    rows = scratch.write(tokens(docs, a_json, b_model, id_col, text_col), "rows")
    counts = scratch.write(pair_counts(rows), "counts")
    most = counts.groupBy(F.expr(f"key div {n_b}").alias("a")).agg(F.max("n").alias("most"))
    marked = scratch.write(counts.withColumn("a", F.expr(f"key div {n_b}")).join(most, "a")
                           .select("key", "n", (F.col("n") == F.col("most")).alias("best")), "marked")
    total = marked.agg(F.sum("n")).first()[0] or 0
    # counts above total / hot: fewer than hot pairs, as they add up to total at most
    top = marked.filter(F.col("n") * hot > total)
    found = top.toPandas().sort_values("key")
    sent = spark.sparkContext.broadcast((found["key"].to_numpy(np.uint32), found["n"].to_numpy(np.int64), found["best"].to_numpy(bool)))

    def look(keys):
        k, n, best = sent.value
        if not len(k):
            return np.zeros(len(keys), bool), n, best
        at = np.minimum(np.searchsorted(k, keys), len(k) - 1)
        return k[at] == keys, n[at], best[at]

    def common(batches):
        z = zstandard.ZstdDecompressor()
        for b in batches:
            out = np.zeros((len(b), 2), np.int64)
            for r, packed in enumerate(b.column(1).to_pylist()):
                if packed is not None:
                    keys, mult = _unpack(z, packed)
                    hit, n, best = look(keys)
                    if hit.any():
                        m = mult[hit].astype(np.int64)
                        out[r] = m[best[hit]].sum(), (m * n[hit]).sum()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out[:, 0]), pa.array(out[:, 1])], names=["row", "best", "sum"])

    def rare(batches):
        z = zstandard.ZstdDecompressor()
        for b in batches:
            for row, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if packed is not None:
                    keys, mult = _unpack(z, packed)
                    hit = ~look(keys)[0]
                    if hit.any():
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(int(hit.sum()), row)), pa.array(keys[hit].astype(np.int64)),
                                                          pa.array(mult[hit].astype(np.int64))], names=["row", "key", "m"])
    pairs = rows.select("row", "pairs")
    hot_sums = pairs.mapInArrow(tv.lean(common), "row long, best long, sum long")
    rare_links = pairs.mapInArrow(tv.lean(rare), "row long, key long, m long")
    rest = marked.filter(F.col("n") * hot <= total)
    rare_sums = (rare_links.join(rest, "key").groupBy("row")
                 .agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("best"), F.sum(F.col("m") * F.col("n")).alias("sum")))
    sums = hot_sums.unionByName(rare_sums).groupBy("row").agg(F.sum("best").alias("n_best"), F.sum("sum").alias("count_sum"))
    return rows.drop("pairs").join(sums, "row").select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

