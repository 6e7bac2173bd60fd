"""Substring dedup by sliding runs of consecutive sentence pieces.

A text is cut into pieces: a piece ends at sentence or clause punctuation
(``.!?,;:`` at a word's end) or at a line end. Longer ones than ``PIECE_WORDS``
are cut again by content: behind every word whose hash is the least among its
``REACH`` neighbours on either side, and behind every local minimum where more
than twice ``PIECE_WORDS`` are left. The cuts inside a passage thus don't depend
on where it starts. Runs are several (``RUN_PIECES`` or more) consecutive pieces
of at least ``RUN_WORDS`` words together: the shortest from every piece onwards,
and the shortest back from every piece that ends none of these. They are hashed
(96 bits over their words, A-Z folded), the hashes are joined over all
documents, and every piece inside a run that occurred before, by (document id,
piece number), is removed. A repeated passage of more than 50 words thus loses
all pieces that begin and end inside it; shorter repeats than a run, such as
single stock lines, stay.

Half hashes are counted first, by themselves; only the runs whose half hash
repeats are kept with all 96 bits, ids and piece numbers. Their first occurrences
are minima, combined before the shuffle and joined back; a run that a third of
the corpus shares is split by the skew join, never held in one task. The last
join brings piece numbers to the texts.

Cases: null text stays null; rows with a null id pass untouched and hold back
nothing. Rows that repeat an id and its text get equal results; rows of one id
with different texts are different documents, in order of the texts' hashes. Overlapping
repeats inside one text (one sentence over and over) keep the first run whole.
Empty tables give empty ones; other columns are passed on whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .stage import Scratch
from .textvec import U

PIECE_WORDS = 12
REACH = 4
RUN_WORDS = 20
RUN_PIECES = 2
LENGTHS = 32               # a run is packed as its first piece * LENGTHS + its number of pieces,
LOW = (1 << 32) - 1        # in 32 bits below ``WHICH``
WHICH = "__s_w"            # 31 bits of a text's hash where its id has several texts, else 0
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?,;:")] = True
_BASES = [(x & ~7) | 5 for x in (tv._mix_int(9001), tv._mix_int(9002))]      # powers repeat after 2**62 only


def _least(h: np.ndarray, part: np.ndarray, reach: int) -> np.ndarray:
    """Words with ``reach`` neighbours of their part on either side, none of which has a smaller hash."""
    n = len(h)
    out = np.zeros(n, bool)
    if n <= 2 * reach:
        return out
    mid = slice(reach, n - reach)
    ok = (part[:n - 2 * reach] == part[mid]) & (part[2 * reach:] == part[mid])
    for d in range(1, reach + 1):
        ok &= (h[mid] <= h[reach - d:n - reach - d]) & (h[mid] <= h[reach + d:n - reach + d])
    out[mid] = ok
    return out


def _cut_again(cut: np.ndarray, h: np.ndarray, longest: int, reach: int) -> np.ndarray:
    """``cut`` (word ends a piece) with pieces of more than ``longest`` words cut at their least hashes."""
    size = np.diff(np.concatenate([[-1], np.flatnonzero(cut)]))
    part = np.repeat(np.arange(len(size)), size)
    return cut | (_least(h, part, reach) & np.repeat(size > longest, size))


def _span_hashes(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int) -> np.ndarray:
    """Hash of the words lo..hi-1 of every span, by differences of one running polynomial."""
    power = np.full(len(h) + 1, U(base))
    power[0] = 1
    np.cumprod(power, out=power)
    total = np.concatenate([np.zeros(1, U), np.cumsum(h * power[:-1])])
    power[1:] = U(pow(base, -1, 1 << 64))
    np.cumprod(power, out=power)
    return tv.mix((total[hi] - total[lo]) * power[lo] ^ (hi - lo).astype(U))


class Pieces:
    """Pieces of a slice of rows: first word's byte, word count, the words' hashes, and the rows' first pieces."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        starts, ends, h, first = tv.words(buf, off, tv.SPACED)
        self.h = h
        if not len(starts):
            self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.first = np.zeros(len(off), np.int64)
            return
        lines = np.concatenate([[0], np.cumsum(buf == 0x0A)])
        cut = _ENDS[buf[ends - 1]]
        cut[:-1] |= lines[starts[1:]] != lines[ends[:-1]]
        cut[-1] = True
        cut[first[1:][first[1:] > 0] - 1] = True
        cut = _cut_again(cut, h, PIECE_WORDS, REACH)
        cut = _cut_again(cut, h, 2 * PIECE_WORDS, 1)
        head = np.flatnonzero(np.concatenate([[True], cut[:-1]]))
        self.size = np.diff(np.append(head, len(starts)))
        self.begin = starts[head]
        self.first = np.searchsorted(head, first)

    def runs(self, run_words: int, run_pieces: int):
        """(row, packed run, hash, second hash) of every run."""
        n = len(self.size)
        at = np.concatenate([[0], np.cumsum(self.size)])
        row = tv.row_ids(self.first)
        b = np.arange(n)
        e = np.maximum(np.searchsorted(at, at[:-1] + run_words), b + run_pieces)     # shortest onwards
        e[e > self.first[1:][row]] = 0                                      # past the row's end
        back = np.minimum(np.searchsorted(at, at[1:] - run_words, side="right"), b + 2 - run_pieces) - 1    # to each piece
        more = np.flatnonzero((back >= self.first[:-1][row]) & (e[back] != b + 1))
        fits = e > 0
        lo, hi = np.concatenate([b[fits], back[more]]), np.concatenate([e[fits], more + 1])
        row = row[lo]
        h1, h2 = (_span_hashes(self.h, at[lo], at[hi], x) for x in _BASES)
        return row, (lo - self.first[row]) * LENGTHS + (hi - lo), h1, h2


def _told_apart(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """``docs`` with ``WHICH``; ids with several texts are found by an aggregation of hashes, and are few or none."""
    key, h = F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.col(f"`{text_col}`").cast("string"))
    several = scratch.write(docs.select(key.alias("__s_of"), h.alias("h")).groupBy("__s_of").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
                            .filter("lo <> hi").select("__s_of"), "several-texts")
    if several.isEmpty():
        return docs.withColumn(WHICH, F.lit(0).cast("long"))
    both = docs.join(several, key == F.col("__s_of"), "left")
    return both.withColumn(WHICH, F.when(F.col("__s_of").isNull(), 0).otherwise(F.shiftrightunsigned(h, 33)).cast("long")).drop("__s_of")


def _runs(docs: DataFrame, id_col: str, text_col: str, run_words: int, run_pieces: int) -> DataFrame:
    def emit(batches):
        for b in batches:
            ids, which = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 2))
            buf, off = tv.utf8(b.column(1))
            for i, j in tv.slices(off):
                row, at, h1, h2 = Pieces(buf[off[i]:off[j]], off[i:j + 1] - off[i]).runs(run_words, run_pieces)
                at = at + (which[i:j][row] << 32)
                for k in range(0, len(row), 100_000):
                    z = slice(k, k + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[i:j][row[z]]), pa.array(at[z]), pa.array(tv.as_long(h1[z])), pa.array((h2[z] >> U(32)).astype(np.uint32).view(np.int32))],
                        names=["id", "no", "h1", "h2"])
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"),
                      F.col(WHICH).alias("w")).filter("id is not null")
    return src.mapInArrow(tv.lean(emit), "id long, no long, h1 long, h2 int")


def repeated_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_words: int = RUN_WORDS,
                    run_pieces: int = RUN_PIECES) -> DataFrame:
    """(id, w, starts): sorted runs (packed) of each document (its id and ``WHICH``) that occurred before."""
    return _repeated(_told_apart(docs, id_col, text_col, Scratch(docs.sparkSession, "span-dedup-ids")), id_col, text_col, run_words, run_pieces)


def _repeated(docs: DataFrame, id_col: str, text_col: str, run_words: int, run_pieces: int) -> DataFrame:
    if not (0 < run_words < LENGTHS and 0 < run_pieces < LENGTHS):
        raise ValueError(f"run_words and run_pieces must be from 1 to {LENGTHS - 1}, not {run_words} and {run_pieces}")
    scratch = Scratch(docs.sparkSession, "span-dedup")
    runs = _runs(docs, id_col, text_col, run_words, run_pieces)
    often = scratch.write(runs.groupBy("h1").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h1"), "repeated-halves")
    copies = scratch.write(runs.join(often, "h1"), "copies")
    seen = (copies.groupBy("h1", "h2").agg(F.min(F.struct("id", "no")).alias("f"), F.count(F.lit(1)).alias("c"))
            .filter("c > 1").select("h1", "h2", "f"))
    seen = scratch.write(seen, "repeated-runs")        # a written side: the join can split a hot run
    again = copies.join(seen, ["h1", "h2"]).filter(F.struct("id", "no") != F.col("f"))
    lo, first = (F.shiftright(F.col(x).bitwiseAND(F.lit(LOW)), LENGTHS.bit_length() - 1) for x in ("no", "f.no"))
    end, first_end = lo + F.col("no") % LENGTHS, first + F.col("f.no") % LENGTHS
    w = F.shiftright("no", 32)
    same = (F.col("id") == F.col("f.id")) & (w == F.shiftright("f.no", 32))
    lo = F.when(same, F.greatest(lo, first_end)).otherwise(lo)     # the first one stays whole
    left = again.filter(lo < end).select("id", w.alias("w"), (lo * LENGTHS + end - lo).alias("no"))
    return left.groupBy("id", "w").agg(F.array_sort(F.collect_set("no")).alias("starts"))


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_words: int = RUN_WORDS,
                run_pieces: int = RUN_PIECES) -> DataFrame:
    """``docs`` with repeated pieces cut out of the text, and ``n_pieces``, ``n_removed``, ``cut_words``,
    ``cut_spans`` (flat code point ranges of the old text) added; select other names first if they clash."""
    apart = _told_apart(docs, id_col, text_col, Scratch(docs.sparkSession, "span-dedup-ids"))
    gone = _repeated(apart, id_col, text_col, run_words, run_pieces).withColumnsRenamed({"id": "__s_id", "w": "__s_gw"})
    mine = (F.col(f"`{id_col}`").cast("long") == F.col("__s_id")) & (F.col(WHICH) == F.col("__s_gw"))
    both = apart.join(gone, mine, "left").drop("__s_id", "__s_gw", WHICH)
    added = [T.StructField("n_pieces", T.LongType()), T.StructField("n_removed", T.LongType()),
             T.StructField("cut_words", T.LongType()), T.StructField("cut_spans", T.ArrayType(T.LongType()))]
    schema = T.StructType([*docs.schema.fields, *added])
    t = docs.columns.index(text_col)
    names = [f.name for f in schema.fields]

    def cut(batches):
        for b in batches:
            buf, off = tv.utf8(b.column(t))
            null = b.column(t).is_null().to_numpy(zero_copy_only=False)
            starts = b.column(b.num_columns - 1)
            for i, j in tv.slices(off):
                part, at = buf[off[i]:off[j]], off[i:j + 1] - off[i]
                p = Pieces(part, at)
                counts = np.diff(p.first)
                removed, words, spans, texts = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64), [], []
                for r in range(j - i):
                    s = starts[i + r].as_py()
                    row = part[at[r]:at[r + 1]]
                    if not s:
                        spans.append([])
                        texts.append(None if null[i + r] else row.tobytes())
                        continue
                    no, length = np.divmod(np.array(s), LENGTHS)
                    depth = np.zeros(counts[r] + 1, np.int64)
                    np.add.at(depth, no, 1)
                    np.add.at(depth, no + length, -1)
                    mark = np.cumsum(depth)[:-1] > 0
                    begin = np.append(p.begin[p.first[r]:p.first[r + 1]] - at[r], len(row))
                    edge = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
                    lo, hi = begin[np.flatnonzero(edge == 1)], begin[np.flatnonzero(edge == -1)]
                    step = np.zeros(len(row) + 1, np.int32)
                    step[lo] += 1
                    step[hi] -= 1
                    keep = np.cumsum(step)[:-1] == 0
                    chars = np.concatenate([[0], np.cumsum((row & 0xC0) != 0x80)])
                    removed[r], words[r] = mark.sum(), p.size[p.first[r]:p.first[r + 1]][mark].sum()
                    spans.append(np.stack([chars[lo], chars[hi]], axis=1).ravel().tolist())
                    texts.append(row[keep].tobytes())
                cols = b.slice(i, j - i).columns[:-1]
                cols[t] = pa.array(texts, pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(counts, pa.int64()), pa.array(removed), pa.array(words), pa.array(spans, pa.list_(pa.int64()))],
                    names=names)
    return both.mapInArrow(tv.lean(cut), schema)
