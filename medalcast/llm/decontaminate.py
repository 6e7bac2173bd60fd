"""Benchmark decontamination by winnowed fingerprints.

Schleimer, Wilkerson & Aiken, "Winnowing" (2003). From every run of 13 words
(``n``), the smallest of its 8-word hashes (``k``) is kept as fingerprint, for
training texts and benchmark items alike, so any shared run of ``n`` words has
a common fingerprint. Fingerprints of both sides are joined; every hit is
extended to the ``n``-word windows that contain it, and windows that are a
window of an item mark their words. An item of fewer than ``n`` words is one
window of its own length.

The benchmark side is read in blocks of at most ``BLOCK_BYTES`` of text (one
item at least), checked by a count before anything is sent; each block's index
is broadcast and the documents stream past it, so nothing of the documents is
shuffled. More blocks mean more scans, never a larger broadcast. A benchmark
in one block, the usual case, adds columns to the rows in place.

Cases: null or wordless texts have no words, no hits, and are not
contaminated; wordless items are ignored. Items with equal ids count once.
Repeated rows get equal results, row by row. An empty table gives an empty
one, an empty benchmark no hits. Other columns are ignored or passed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .textvec import U

WINDOW = 13
GRAM = 8
BLOCK_BYTES = 8 << 20

RESULT = {"n_words": T.LongType(), "n_hit": T.LongType(), "spans": T.ArrayType(T.IntegerType()), "items": T.ArrayType(T.StringType())}


def _windows(h: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each start; equals ``textvec.grams``."""
    acc = np.zeros(len(starts), U)
    for j, c in enumerate(tv.gram_consts(n)):
        acc += h[starts + j] * c
    return tv.mix(acc)


def _fits(first: np.ndarray, n_words: int, n: int) -> np.ndarray:
    """Whether n words from each word on lie in one row."""
    row = tv.row_ids(first)
    return np.arange(n_words) + n <= first[1:][row]


def winnow(h: np.ndarray, first: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes): the smallest k-word hash, leftmost if tied, of every run of n words of a row."""
    g = tv.grams(h, k)
    runs = len(h) - n + 1
    if runs <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    ok = _fits(first, len(h), n)[:runs]
    best, at = g[:runs].copy(), np.arange(runs)
    for d in range(1, n - k + 1):
        c = g[d:d + runs]
        lower = c < best
        best[lower] = c[lower]
        at[lower] = np.flatnonzero(lower) + d
    mark = np.zeros(len(g), bool)
    mark[at[ok]] = True
    pos = np.flatnonzero(mark)
    return pos, g[pos]


class Index:
    """A block of items: sorted fingerprints, and sorted window hashes with the items of each."""

    def __init__(self, items: list[tuple[str, bytes]], n: int, k: int):
        self.n, self.k = n, k
        ids = sorted({i for i, _ in items})
        number = {x: j for j, x in enumerate(ids)}
        buf, off = tv.utf8(pa.array([t for _, t in items], pa.large_binary()))
        _, _, h, first = tv.words(buf, off, tv.ALNUM)
        owner = np.array([number[i] for i, _ in items], np.int64)
        size = np.diff(first)
        self.ids = ids
        _, fp = winnow(h, first, n, k)
        self.fingerprints = np.unique(fp)
        starts = np.flatnonzero(_fits(first, len(h), n)) if len(h) else np.zeros(0, np.int64)
        self.by_length = {}
        if len(starts):
            self.by_length[n] = self._csr(_windows(h, starts, n), owner[tv.row_ids(first)[starts]])
        for length in np.unique(size[(size > 0) & (size < n)]):
            rows = np.flatnonzero(size == length)
            self.by_length[int(length)] = self._csr(_windows(h, first[rows], int(length)), owner[rows])

    @staticmethod
    def _csr(hashes, owners):
        order = np.lexsort((owners, hashes))
        hashes, owners = hashes[order], owners[order]
        keep = np.ones(len(hashes), bool)
        keep[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        hashes, owners = hashes[keep], owners[keep]
        uniq, begin = np.unique(hashes, return_index=True)
        return uniq, np.append(begin, len(hashes)), owners

    def hits(self, h: np.ndarray, first: np.ndarray):
        """(start word, length, index of the window's hash) of every item window found."""
        out = []
        for length, (uniq, _, _) in self.by_length.items():
            if length == self.n:
                pos, fp = winnow(h, first, self.n, self.k)
                anchors = pos[_isin(fp, self.fingerprints)]
                fits = _fits(first, len(h), self.n) if len(anchors) else None
                around = (anchors[:, None] - np.arange(self.n - self.k + 1)[None, :]).ravel()
                around = np.unique(around[around >= 0])
                starts = around[fits[around]] if len(around) else around
            else:
                starts = np.flatnonzero(_fits(first, len(h), length)) if len(h) else np.zeros(0, np.int64)
            if not len(starts):
                continue
            wh = _windows(h, starts, length)
            at = np.searchsorted(uniq, wh)
            at[at == len(uniq)] = 0
            ok = uniq[at] == wh
            out.append((starts[ok], np.full(int(ok.sum()), length), at[ok]))
        return out

    def rows(self, h: np.ndarray, first: np.ndarray):
        """(n_words, n_hit, spans, items) per row; spans are flat, merged [start, end) word positions."""
        n = len(first) - 1
        n_words = np.diff(first)
        n_hit, spans, items = np.zeros(n, np.int64), [[] for _ in range(n)], [[] for _ in range(n)]
        found = self.hits(h, first)
        if found and sum(len(s) for s, _, _ in found):
            start, length, at = (np.concatenate(x) for x in zip(*found, strict=True))
            row = np.searchsorted(first, start, side="right") - 1
            order = np.argsort(row, kind="stable")
            start, length, at, row = start[order], length[order], at[order], row[order]
            edge = np.flatnonzero(np.diff(row, prepend=-1))
            for a, z in zip(edge, np.append(edge[1:], len(row)), strict=True):
                r = int(row[a])
                spans[r] = merge(start[a:z] - first[r], start[a:z] + length[a:z] - first[r])
                n_hit[r] = sum(spans[r][1::2]) - sum(spans[r][::2])
                got = set()
                for ln in np.unique(length[a:z]):
                    _, begin, owners = self.by_length[int(ln)]
                    for w in np.unique(at[a:z][length[a:z] == ln]):
                        got.update(owners[begin[w]:begin[w + 1]].tolist())
                items[r] = [self.ids[x] for x in sorted(got)]
        return n_words, n_hit, spans, items


def _isin(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    at = np.searchsorted(ordered, x)
    at[at == len(ordered)] = 0
    return ordered[at] == x


def merge(starts, ends) -> list[int]:
    """Flat list of the disjoint, sorted [start, end) spans that cover the given ones."""
    out: list[int] = []
    for i in np.argsort(starts, kind="stable"):
        s, e = int(starts[i]), int(ends[i])
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def _blocks(bench: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Items with a block number, and how many blocks keep each one within the bound."""
    size = F.octet_length("text")
    total = bench.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    while True:
        dealt = bench.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
        over = (dealt.groupBy("block").agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("c"))
                .filter((F.col("b") > block_bytes) & (F.col("c") > 1)).limit(1).count()) if n > 1 or total > block_bytes else 0
        if not over:
            return dealt, n
        n *= 2


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", n: int = WINDOW, k: int = GRAM, block_bytes: int = BLOCK_BYTES,
                  prefix: str = "") -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` (flat word positions) and ``items`` (sorted ids as strings).

    ``prefix`` goes before the added names; choose it so that none clashes with a column of ``docs``.
    """
    if not 0 < k <= n:
        raise ValueError("fingerprints need 0 < k <= n")
    sc = docs.sparkSession.sparkContext
    bench = (benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                              F.col(f"`{item_text_col}`").cast("string").alias("text"))
             .filter("text is not null and item is not null").distinct())
    dealt, n_blocks = _blocks(bench, block_bytes)
    col = docs.columns.index(text_col)
    added = [prefix + c for c in RESULT]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(prefix + c, kind) for c, kind in RESULT.items()]])

    def scan(block: int) -> DataFrame:
        rows = dealt.filter(F.col("block") == block).select("item", F.encode("text", "UTF-8").alias("t")).collect()
        index = sc.broadcast(Index([(r["item"], bytes(r["t"])) for r in rows], n, k))   # within block_bytes of text

        def run(batches):
            for batch in batches:
                buf, off = tv.utf8(batch.column(col))
                for i, j in tv.slices(off):
                    _, _, h, first = tv.words(buf[off[i]:off[j]], off[i:j + 1] - off[i], tv.ALNUM)
                    n_words, n_hit, spans, items = index.value.rows(h, first)
                    cols = [pa.array(n_words, pa.int64()), pa.array(n_hit), pa.array(spans, pa.list_(pa.int32())),
                            pa.array(items, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, *cols],
                                                     names=[*batch.schema.names, *added])
        return docs.mapInArrow(tv.lean(run), schema)

    if n_blocks == 1:
        return scan(0)
    return _union_blocks(docs, [scan(b) for b in range(n_blocks)], text_col, prefix)


def _union_blocks(docs: DataFrame, scans: list[DataFrame], text_col: str, prefix: str) -> DataFrame:
    """Results of all blocks per distinct text, joined to the rows by the text's digest."""
    digest = F.sha2(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), 256)
    parts = None
    for s in scans:
        p = (s.filter(F.col(prefix + "n_hit") > 0)
             .select(digest.alias("__digest"), F.col(prefix + "spans").alias("spans"), F.col(prefix + "items").alias("items"))
             .dropDuplicates(["__digest"]))
        parts = p if parts is None else parts.unionByName(p)
    per = parts.groupBy("__digest").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def run(batches):
        for b in batches:
            spans = [merge(np.array(x[::2]), np.array(x[1::2])) for x in b.column("spans").to_pylist()]
            hit = [sum(x[1::2]) - sum(x[::2]) for x in spans]
            yield pa.RecordBatch.from_arrays(
                [b.column("__digest"), pa.array(hit, pa.int64()), pa.array(spans, pa.list_(pa.int32())), b.column("items")],
                names=["__digest", "n_hit", "spans", "items"])
    per = per.mapInArrow(tv.lean(run), "__digest string, n_hit long, spans array<int>, items array<string>")
    per = per.toDF("__digest", "__hit", "__spans", "__items")
    base = scans[0].drop(*[prefix + c for c in ("n_hit", "spans", "items")]).withColumn("__digest", digest)
    return base.join(per, "__digest", "left").select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col(prefix + "n_words"),
        F.coalesce("__hit", F.lit(0).cast("long")).alias(prefix + "n_hit"),
        F.coalesce("__spans", F.array().cast("array<int>")).alias(prefix + "spans"),
        F.coalesce("__items", F.array().cast("array<string>")).alias(prefix + "items"))


def contaminated(prefix: str = ""):
    """A hit covers at least a twentieth of the words."""
    return (F.col(prefix + "n_hit") > 0) & (20 * F.col(prefix + "n_hit") >= F.col(prefix + "n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with their columns unchanged."""
    found = find_overlaps(docs, benchmark, text_col, prefix="__d_", **options)
    return found.filter(~contaminated("__d_")).select(*[F.col(f"`{c}`") for c in docs.columns])
