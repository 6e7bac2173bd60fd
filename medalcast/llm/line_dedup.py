"""Line dedup over all documents, exact and within one edit, by a deletion-neighbourhood join.

Lines are the ``\\n``-split parts of a text, stripped of white space at both
ends; lines without a word are never touched. The earliest line, by (document
id, line number), of equal lines stays. A line of at least ``MIN_CHARS`` code
points also goes if an earlier one (of ``MIN_CHARS - 1`` or more) is within edit
distance 1 (one code point inserted, deleted or replaced): every line emits itself and all its one-deletion
variants as 64-bit keys, equal variants meet, and met texts are verified.

* Two lines are one replacement apart iff deleting the same position of both
  gives the same variant, and one insertion apart iff one is a variant of the
  other. So a line needs to meet only the earliest line of each (variant,
  position) and of each whole-line key: minima over a key, never pairs within it.
* Only lines that can have a near line emit variants: an edit leaves at least
  half of the shorter line unchanged at its front or its end, so near lines share
  a key of (length, first half) or (length, last half), with the length or one
  less. Lines whose keys nobody shares are done. This loses nothing.
* Line texts are not shuffled: hashes are, and the texts of the lines that
  remain are read again from the documents.

``max_edits`` is 0 (exact only) or 1; the neighbourhood of a bound e has L^e
keys a line, which is why more isn't offered.

Cases: null text has no lines. Rows with a null id are passed on untouched and
hold back no other line. Rows that repeat an id and its text are treated alike
(the same lines stay in each); rows of one id with different texts are different
documents, in order of the texts' hashes. Empty and very long lines are fine; an empty
table gives an empty one. Other columns, whatever their names, are passed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import textvec as tv
from .stage import Scratch
from .textvec import U, as_long, mix

MIN_CHARS = 24
BROADCAST_ROWS = 100_000   # candidate lines sent to every task; more are joined by shuffle
_P = U(0x9E3779B97F4A7C15 | 1)
_P_INV = U(pow(int(_P), -1, 1 << 64))


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def strip(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def _which(text: Column) -> Column:
    """31 bits of a text's hash: rows with one id and different texts are different documents."""
    return F.shiftrightunsigned(F.xxhash64(text.cast("string")), 33)


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, no, line) of every line with a word, stripped; ``no`` is the text's ``_which`` and, below 32 bits, the line's number."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t")).filter("id is not null")
    ex = src.select("id", _which(F.col("t")).alias("w"), F.posexplode(_split(F.col("t"))).alias("n", "raw"))
    return ex.select("id", (F.shiftleft("w", 32) + F.col("n")).alias("no"), strip(F.col("raw")).alias("line")).filter(F.col("line") != "")


def _half(m: Column) -> Column:
    """Half of m, rounded down to its three leading bits, so that lengths near each other agree."""
    h = F.floor(m / 2).cast("int")
    width = F.greatest(F.length(F.bin(h)) - 3, F.lit(0)).cast("int")
    return (h - F.pmod(h, F.pow(F.lit(2), width).cast("int"))).cast("int")


def _block_keys(line: Column, n: Column) -> Column:
    keys = []
    for m in (n, n - 1):
        g = _half(m)
        keys.append(F.xxhash64(F.lit("front"), m, F.substring(line, F.lit(1), g)))
        keys.append(F.xxhash64(F.lit("end"), m, F.right(line, g)))
    return F.array(*keys)


def _variants(cand: DataFrame) -> DataFrame:
    """(key, id, no, pos) of a line itself (pos -1) and of each of its one-deletion variants."""
    def run(batches):
        for b in batches:
            for id_, no, line in zip(*(b.column(c).to_pylist() for c in ("id", "no", "line")), strict=True):
                cp = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
                n = len(cp)
                power = np.full(n, _P, U)
                power[0] = 1
                pre = np.concatenate([np.zeros(1, U), np.cumsum(mix(cp + U(1)) * np.cumprod(power))])
                full = mix(pre[-1:] ^ U(n))
                less = mix((pre[:-1] + _P_INV * (pre[-1] - pre[1:])) ^ U(n - 1))
                keys = as_long(np.concatenate([full, less]))
                for i in range(0, n + 1, 50_000):
                    k = keys[i:i + 50_000]
                    pos = np.arange(i - 1, i - 1 + len(k), dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k), pa.array(np.full(len(k), id_, np.int64)), pa.array(np.full(len(k), no, np.int64)), pa.array(pos)],
                        names=["key", "id", "no", "pos"])

    def packed(batches):   # one Arrow batch for many short lines
        held, rows = [], 0
        for x in run(batches):
            held.append(x)
            rows += x.num_rows
            if rows >= 50_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return cand.select("id", "no", "line").mapInArrow(tv.lean(packed), "key long, id long, no long, pos int")


def _near(cand: DataFrame, min_chars: int) -> DataFrame:
    """(id, no) of candidate lines of ``min_chars`` or more with an earlier candidate line within one edit.

    One row per distinct line comes in; one of a character less may be the earlier line.
    """
    occ = F.struct("id", "no")
    whole, part = F.col("pos") < 0, F.col("pos") >= 0
    by_key, by_pos = W.partitionBy("key"), W.partitionBy("key", "pos")
    v = (_variants(cand).repartition("key")
         .withColumns({"n": F.count(F.lit(1)).over(by_key)}).filter("n > 1")
         .withColumns({"whole_first": F.min(F.when(whole, occ)).over(by_key), "part_first": F.min(F.when(part, occ)).over(by_key),
                       "same_first": F.min(occ).over(by_pos)}))
    leads = F.when(whole, F.array("part_first")).otherwise(F.array("whole_first", "same_first"))
    pairs = (v.select("id", "no", F.explode(leads).alias("lead")).filter(F.col("lead").isNotNull() & (F.col("lead") < F.struct("id", "no")))
             .select("id", "no", F.col("lead.id").alias("e_id"), F.col("lead.no").alias("e_no")).distinct())
    earlier = cand.select(F.col("id").alias("e_id"), F.col("no").alias("e_no"), F.col("line").alias("e_line"))
    met = pairs.join(cand.select("id", "no", "line"), ["id", "no"]).join(earlier, ["e_id", "e_no"])
    return met.filter((F.char_length("line") >= min_chars) & (F.levenshtein("line", "e_line", 1) >= 0)).select("id", "no").distinct()


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = 1,
                   min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, no, near): every line to remove (``no`` as in ``lines_of``); ``near`` tells one removed for an earlier line one edit away."""
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    scratch = Scratch(docs.sparkSession, "line-dedup")
    ln = lines_of(docs, id_col, text_col)
    n = F.char_length("line")
    keyed = ln.select("id", "no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"),
                      F.when(n >= min_chars - 1, _block_keys(F.col("line"), n)).alias("k"))
    first = scratch.write(
        keyed.groupBy("h1", "h2").agg(F.min(F.struct("id", "no")).alias("f"), F.count(F.lit(1)).alias("c"),
                                      *[F.min(F.get("k", F.lit(i))).alias(f"k{i}") for i in range(4)]), "distinct-lines")
    again = (keyed.select("id", "no", "h1", "h2").join(first.filter("c > 1").select("h1", "h2", "f"), ["h1", "h2"])
             .filter(F.struct("id", "no") != F.col("f")).select("id", "no", F.lit(False).alias("near")).distinct())
    if max_edits == 0:
        return again
    keys = (first.filter("k0 is not null")
            .select(F.col("f.id").alias("id"), F.col("f.no").alias("no"), F.explode(F.array("k0", "k1", "k2", "k3")).alias("key")))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    named = scratch.write(keys.join(shared, "key", "left_semi").select("id", "no").distinct(), "candidates")
    small = named.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    cand = scratch.write(ln.join(F.broadcast(named) if small else named, ["id", "no"], "left_semi")
                         .dropDuplicates(["id", "no"]), "candidate-lines", compression="zstd")
    near = _near(cand, min_chars).select("id", "no", F.lit(True).alias("near"))
    return again.unionByName(near)


def _removals(docs, id_col, text_col, **options) -> DataFrame:
    """(id, w, gone, near): sorted line numbers to remove of each document (its id and ``_which``) that loses any."""
    gone = repeated_lines(docs, id_col, text_col, **options)
    line = F.col("no").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    return (gone.groupBy("id", F.shiftright("no", 32).alias("w"))
            .agg(F.array_sort(F.collect_set(line)).alias("gone"), F.sum(F.col("near").cast("long")).alias("near")))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: (id, n_lines with a word, n_near, removed line numbers)."""
    per = _removals(docs, id_col, text_col, **options)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), _which(F.col(f"`{text_col}`")).alias("w"),
                       F.size(F.filter(_split(F.col(f"`{text_col}`")), lambda x: strip(x) != "")).cast("long").alias("n_lines"))
    return rows.join(per, ["id", "w"], "left").select("id", "n_lines", F.coalesce("near", F.lit(0).cast("long")).alias("n_near"),
                                               F.coalesce("gone", F.array().cast("array<int>")).alias("removed"))


def drop_lines(text: Column, gone: Column) -> Column:
    """The text without the lines numbered in the sorted array ``gone``."""
    def rest(lines):
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)   # by hashing, in order
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    return F.get(F.transform(F.array(_split(text)), rest), F.lit(0))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_emptied: bool = True,
                size_col: str | None = None, **options) -> DataFrame:
    """``docs`` with repeated lines removed from the text and the other columns as they are.

    Documents that had a word and lost every line with one are dropped if ``drop_emptied``. ``size_col``, if
    given, gets the new text's length in code points where the text changed.
    """
    per = _removals(docs, id_col, text_col, **options).select(F.col("id").alias("__l_id"), F.col("w").alias("__l_w"), F.col("gone").alias("__l_gone"))
    out = docs.join(per, (F.col(f"`{id_col}`").cast("long") == F.col("__l_id")) & (_which(F.col(f"`{text_col}`")) == F.col("__l_w")), "left")
    text = F.when(F.col("__l_gone").isNull(), F.col(f"`{text_col}`")).otherwise(drop_lines(F.col(f"`{text_col}`"), F.col("__l_gone")))
    out = out.withColumn("__l_new", text)
    if drop_emptied:
        out = out.filter(F.col("__l_gone").isNull() | (strip(F.col("__l_new")) != ""))
    if size_col:
        kind = docs.schema[size_col].dataType
        out = out.withColumn(size_col, F.when(F.col("__l_gone").isNull(), F.col(f"`{size_col}`"))
                             .otherwise(F.char_length("__l_new").cast(kind)))
    return out.select(*[F.col("__l_new").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
