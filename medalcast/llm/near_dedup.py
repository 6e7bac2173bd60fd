"""MinHash-style near-duplicate classes of documents by SetSketch registers.

Method
------
1. Every document's distinct k-word shingles give a SetSketch (256 registers,
   ``setsketch``), its size and a 128-bit digest of the set. Documents with one
   digest are one node, named by its smallest id; sketches are written once.
2. Registers are banded (32 bands of 8). Nodes that share a band are
   candidates. A band bucket of up to ``SMALL`` nodes gives all its pairs. A
   larger one gives a sparse chain over a band-specific order, in blocks, so a
   bucket of any size is split over tasks and gives a linear number of pairs.
3. Pairs whose sizes can't reach the similarity are dropped, in whole numbers.
   The joint likelihood of the two sketches drops another only if the best
   similarity at or above the threshold is e^-``LEAD`` times less likely than
   the most likely one. The rest is verified on full shingle sets.
4. Verified links give components. For large buckets that still hold several,
   an exact prefix filter over their nodes' shingles gives every pair of
   different components that can reach the similarity; these are verified too.
   No link between components is lost; only links inside one are left out.

With 32 bands of 8 rows a pair at similarity 0.85 is a candidate with
probability 1 - (1 - 0.85^8)^32 > 0.9999, with 36 bands of 7 (``band_rows``) one
at 0.8 with more than 0.9997; above that more surely.

Cases: a null or wordless text has an empty set, links with nothing and is its
own class. Fewer than k words: the whole sequence is the one shingle. Repeated
rows fall in one class. Rows with a null id have a null class and link nothing.
Extra columns of the input are ignored. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import setsketch as sk
from . import textvec as tv
from .components import connected_components
from .stage import Scratch

SMALL = 12            # buckets up to this many nodes give all their pairs at once
BLOCK = 4096          # larger buckets are chained in blocks of about this many nodes
BAND_ROWS = 8
LEAD = 14.0           # log-likelihood by which a pair must fall short to be dropped unverified
HOT = 10_000          # most frequent shingles ranked in place when prefixes are taken; the others are joined
COUNTED = 1_000_000   # shingles a task counts in arrays before it gives the sums out
BROADCAST_IDS = 100_000  # ids sent to every task when reading candidates' sets; more are joined by shuffle


def _sets(batch: pa.RecordBatch, k: int):
    """Per bounded slice of a batch: (ids, row, hash, n_rows) of distinct shingles."""
    buf, off = tv.utf8(batch.column(1))
    for i, j in tv.slices(off):
        part = buf[off[i]:off[j]]
        _, _, h, first = tv.words(part, off[i:j + 1] - off[i], tv.SPACED)
        row, g = tv.shingles(h, first, k)
        yield batch.column(0).slice(i, j - i), row, g, j - i


def sketch_documents(docs: DataFrame, id_col: str, text_col: str, k: int, band_rows: int = BAND_ROWS) -> DataFrame:
    """(id, n_shingles, d1, d2, bands, regs) of every document; d1, d2 are 0 for an empty set."""
    schema = "id long, n_shingles long, d1 long, d2 long, bands array<long>, regs binary"

    def run(batches: Iterator[pa.RecordBatch]):
        n_bands = sk.M // band_rows
        for batch in batches:
            for ids, row, h, n in _sets(batch, k):
                size = np.bincount(row, minlength=n).astype(np.int64)
                reg = sk.registers(row, h, n)
                bands = tv.as_long(sk.band_keys(reg, band_rows))
                at = np.concatenate([[0], np.cumsum(size)])
                dig = np.zeros((n, 2), np.int64)
                for r in np.flatnonzero(size):
                    dig[r] = np.frombuffer(hashlib.md5(h[at[r]:at[r + 1]].tobytes()).digest(), np.int64)
                yield pa.RecordBatch.from_arrays([
                    ids.cast(pa.int64()), pa.array(size), pa.array(dig[:, 0]), pa.array(dig[:, 1]),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * n_bands), pa.array(bands.ravel())),
                    pa.array([x.tobytes() for x in reg], pa.binary()),
                ], names=["id", "n_shingles", "d1", "d2", "bands", "regs"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(tv.lean(run), schema)


def _shingle_sets(docs: DataFrame, id_col: str, text_col: str, ids: DataFrame, k: int) -> DataFrame:
    """(id, s) full shingle sets of the documents named in ``ids``."""
    def run(batches):
        for batch in batches:
            for got, row, h, n in _sets(batch, k):
                at = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [got.cast(pa.int64()), pa.ListArray.from_arrays(pa.array(at), pa.array(tv.as_long(h)))], names=["id", "s"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    right = F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids
    return src.join(right, "id", "left_semi").mapInArrow(tv.lean(run), "id long, s array<long>").dropDuplicates(["id"])


def _likely(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that neither their sizes nor the sketches' joint likelihood rule out."""
    def run(batches):
        for t in batches:
            if not t.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint16).reshape(-1, sk.M) for c in ("ra", "rb"))
            na, nb = (t.column(c).to_numpy() for c in ("na", "nb"))
            keep = den * np.minimum(na, nb) >= num * np.maximum(na, nb)
            for i in range(0, t.num_rows, 2000):
                z = slice(i, i + 2000)
                _, lead = sk.joint_estimate(ra[z], rb[z], na[z].astype(float), nb[z].astype(float), num / den)
                keep[z] &= lead <= LEAD
            yield t.select(["a", "b"]).filter(pa.array(keep))

    def side(x):
        return nodes.select(F.col("id").alias(x), F.col("n_shingles").alias("n" + x), F.col("regs").alias("r" + x))
    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ra", "rb")
            .mapInArrow(tv.lean(run), "a long, b long"))


def _linked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose full sets reach the similarity: den * |A and B| >= num * |A or B|."""
    def side(x):
        return sets.select(F.col("id").alias(x), F.col("s").alias("s" + x))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (pairs.join(side("a"), "a").join(side("b"), "b").withColumn("both", both)
            .filter(F.col("both") * den >= (F.size("sa") + F.size("sb") - F.col("both")) * num).select("a", "b"))


def _first_pairs(members: DataFrame) -> DataFrame:
    """All pairs of small buckets; a chain with one skip, in blocks, for larger ones."""
    m = members.filter(F.col("g") <= SMALL).select("key", "id")
    small = (m.withColumnRenamed("id", "a").join(m.withColumnRenamed("id", "b"), "key")
             .filter(F.col("a") < F.col("b")).select("a", "b"))
    big = members.filter(F.col("g") > SMALL).withColumn("o", F.xxhash64("key", "id"))
    big = big.withColumn("block", F.pmod(F.col("o"), F.ceil(F.col("g") / BLOCK)))
    w = W.partitionBy("key", "block").orderBy("o", "id")
    chain = big.withColumns({"p1": F.lag("id", 1).over(w), "p2": F.lag("id", 2).over(w)})
    chained = (chain.select(F.explode(F.array("p1", "p2")).alias("a"), F.col("id").alias("b")).filter(F.col("a").isNotNull()))
    heads = chain.filter(F.col("p1").isNull() & (F.col("g") > BLOCK)).select("key", "id")
    low = heads.groupBy("key").agg(F.min("id").alias("a"))
    tied = heads.join(low, "key").select("a", F.col("id").alias("b"))
    return _ordered(small.unionByName(chained).unionByName(tied))


def _ordered(pairs: DataFrame) -> DataFrame:
    return (pairs.filter(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _bounded(batches):
    """Slices of the batches with at most ``COUNTED`` shingles in ``s`` (one set at least)."""
    for b in batches:
        at = b.column("s").offsets.to_numpy().astype(np.int64)
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + COUNTED, side="right")) - 1)
            yield b.slice(i, j - i)
            i = j


def _shingle_counts(sets: DataFrame) -> DataFrame:
    """(x, df, lo) per task and shingle: sets that hold it and the smallest id, added up in arrays given out at a bound."""
    def summed(parts):
        x, df, lo = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(x, kind="stable")
        x = x[order]
        at = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        return x[at], np.add.reduceat(df[order], at), np.minimum.reduceat(lo[order], at)

    def run(batches):
        parts, held, floor = [], 0, 0
        for b in _bounded(batches):
            flat = b.column("s").flatten().to_numpy()
            ids = np.repeat(b.column("id").to_numpy(), b.column("s").value_lengths().to_numpy())
            parts.append((flat, np.ones(len(flat), np.int64), ids))
            held += len(flat)
            if held - floor > COUNTED:
                parts = [summed(parts)]
                held = floor = len(parts[0][0])
                if held > COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in parts[0]], names=["x", "df", "lo"])
                    parts, held, floor = [], 0, 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in summed(parts)], names=["x", "df", "lo"])

    return sets.select("id", "s").mapInArrow(tv.lean(run), "x long, df long, lo long")


def _split_hot(held: DataFrame, counts: DataFrame) -> DataFrame:
    """(id, c, alone, n, p, others, hot): the ``HOT`` most frequent shingles of ``counts`` leave each set, in place.

    They come last in the prefix order, so their ranks need no shuffle; ``others`` is empty where none but shingles
    of one set alone are left. The list sent to every task has at most ``HOT`` entries.
    """
    top = counts.filter("df > 1").orderBy(F.desc("df"), "x").limit(HOT).select("x", "df").toPandas()
    x, df = top["x"].to_numpy(np.int64), top["df"].to_numpy(np.int64)
    order = np.argsort(x, kind="stable")
    rank = np.empty(len(x), np.int64)
    rank[np.lexsort((x, df))] = np.arange(len(x))
    sent = held.sparkSession.sparkContext.broadcast((x[order], rank[order], x[np.lexsort((x, df))]))

    def run(batches):
        ordered, ranks, by_rank = sent.value
        for b in _bounded(batches):
            flat = b.column("s").flatten().to_numpy()
            at = np.append(0, np.cumsum(b.column("s").value_lengths().to_numpy()))
            i = np.minimum(np.searchsorted(ordered, flat), max(len(ordered) - 1, 0))
            hot = ordered[i] == flat if len(ordered) else np.zeros(len(flat), bool)
            others, tops = [], []
            for lo, hi, alone, p in zip(at[:-1], at[1:], b.column("alone").to_pylist(), b.column("p").to_pylist(), strict=True):
                h = hot[lo:hi]
                left = flat[lo:hi][~h]
                others.append(left if len(left) > alone else left[:0])
                tops.append(by_rank[np.sort(ranks[i[lo:hi][h]])[:max(p - alone, 0)]] if h.any() else left[:0])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("c"), b.column("alone"), pa.array(np.diff(at).astype(np.int32)), b.column("p"),
                 pa.array(others, pa.list_(pa.int64())), pa.array(tops, pa.list_(pa.int64()))],
                names=["id", "c", "alone", "n", "p", "others", "hot"])
    src = held.withColumn("p", F.col("p").cast("long"))
    return src.mapInArrow(tv.lean(run), "id long, c long, alone long, n int, p long, others array<long>, hot array<long>")


def _cross_pairs(big: DataFrame, comp: DataFrame, sets: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Pairs of different components, among nodes of large buckets that hold several, that can reach the similarity.

    Exact prefix filter (Bayardo et al., 2007; Xiao et al., 2008): with shingles ordered from rare to frequent, two
    sets that reach it share one of each one's first ``n - ceil(t n) + 1``, at positions that leave enough behind.
    Shingles of one set alone stand first, the ``HOT`` most frequent last; both need no join.
    """
    lab = scratch.write(big.join(comp.withColumnRenamed("node", "id"), "id", "left")
                        .select("key", "id", F.coalesce("component", "id").alias("c")), "labelled")
    mixed = lab.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("key")
    rest = scratch.write(lab.join(mixed, "key", "left_semi").select("id", "c").distinct().join(sets, "id"), "rest")
    prefix_size = F.size("s") - F.floor((F.size("s") * num + (den - 1)) / den) + 1
    counts = scratch.write(_shingle_counts(rest).groupBy("x").agg(F.sum("df").alias("df"), F.min("lo").alias("lo")), "shingle-counts")
    # shingles of one set alone stand first; a set whose prefix has no other can't reach any of the rest
    alone = counts.filter("df = 1").groupBy(F.col("lo").alias("id")).agg(F.count(F.lit(1)).alias("alone"))
    open_ = rest.join(alone, "id", "left").withColumn("alone", F.coalesce("alone", F.lit(0))).filter(F.col("alone") < prefix_size)
    open_ = scratch.write(open_.select("id", "c", "alone"), "open")
    still = lab.join(open_.select("id"), "id", "left_semi")
    both = still.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("key")
    open_ = open_.join(still.join(both, "key", "left_semi").select("id").distinct(), "id", "left_semi")
    held = scratch.write(_split_hot(rest.drop("c").join(open_, "id").select("id", "c", "alone", prefix_size.alias("p"), "s"), counts), "held")
    mid = (held.filter(F.size("others") > F.col("alone")).select("id", F.explode("others").alias("x"))
           .join(counts.filter("df > 1").select("x", "df"), "x").groupBy("id")
           .agg(F.sort_array(F.collect_list(F.struct("df", "x"))).alias("mid")))                     # one document's
    ranked = held.join(mid, "id", "left").withColumn("r", F.concat(F.coalesce(F.col("mid.x"), F.array().cast("array<long>")), "hot"))
    first = scratch.write(ranked.select("id", "c", "n", "alone", F.posexplode(F.slice("r", F.lit(1), (F.col("p") - F.col("alone")).cast("int"))).alias("at", "x"))
                          .select("id", "c", "n", (F.col("at") + F.col("alone")).alias("at"), "x"), "prefixes")
    # per shingle, the component that has most of its sets only meets the others
    main = (first.groupBy("x", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("x")
            .agg(F.max(F.struct("k", "c"))["c"].alias("top"), F.count(F.lit(1)).alias("cs")).filter("cs > 1").select("x", "top"))
    some = first.join(main, "x").filter("c <> top")
    a, b = some.alias("a"), first.alias("b")
    shared = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    need = F.floor(((F.col("a.n") + F.col("b.n")) * num + (num + den - 1)) / (num + den))     # whole numbers, rounded up
    fits = ((F.col("a.c") != F.col("b.c")) & (F.least("a.n", "b.n") * den >= F.greatest("a.n", "b.n") * num) & (shared >= need))
    return _ordered(a.join(b, (F.col("a.x") == F.col("b.x")) & fits).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                           num: int = 85, den: int = 100, band_rows: int = BAND_ROWS) -> DataFrame:
    """One row per input row: (id, n_shingles, n_links, component).

    ``component`` is the smallest id reachable over links of similarity
    ``num / den`` or more; ``n_links`` counts the verified links found from
    the row's distinct text set to others (links inside a large class may be
    left out once it is connected).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    sk_all = scratch.write(sketch_documents(docs, id_col, text_col, k, band_rows), "sketches")
    solid = sk_all.filter((F.col("n_shingles") > 0) & F.col("id").isNotNull())
    reps = scratch.write(solid.groupBy("d1", "d2").agg(F.min("id").alias("rep")), "nodes")
    nodes = (solid.join(reps.select(F.col("rep").alias("id"), "d1", "d2"), ["id", "d1", "d2"], "left_semi")
             .select("id", "n_shingles", "bands", "regs").dropDuplicates(["id"]))
    spread = nodes.select("id", F.explode("bands").alias("key"))
    live = (spread.groupBy("key").agg(F.count(F.lit(1)).alias("g"), F.min("id").alias("lo"), F.max("id").alias("hi"))
            .filter("lo <> hi").select("key", "g"))
    members = scratch.write(spread.join(live, "key"), "members")

    named = scratch.write(members.select("id").distinct(), "candidates")
    cand = scratch.write(nodes.select("id", "n_shingles", "regs").join(named, "id", "left_semi"), "candidate-sketches")
    sets = scratch.write(_shingle_sets(docs, id_col, text_col, named, k), "sets")

    def links(pairs):
        return _linked(_likely(pairs, cand, num, den), sets, num, den)

    edges = scratch.write(links(_first_pairs(members)), "edges")
    comp = scratch.write(connected_components(edges, scratch), "components")
    # links between components: their components are those of a graph of components
    more = scratch.write(links(_cross_pairs(members.filter(F.col("g") > SMALL), comp, sets, num, den, scratch)), "cross-edges")
    if not more.isEmpty():
        lone = comp.select(F.col("node").alias("n"), F.col("component").alias("c"))
        ends = (more.join(lone.toDF("a", "ca"), "a", "left").join(lone.toDF("b", "cb"), "b", "left")
                .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
        over = scratch.write(connected_components(ends, scratch), "components-of-components").toDF("component", "whole")
        nodes_all = comp.unionByName(more.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                                     .join(comp.select("node"), "node", "left_anti").withColumn("component", F.col("node")))
        comp = nodes_all.join(over, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
        edges = edges.unionByName(more)
    both = edges.select("a").unionByName(edges.select(F.col("b").alias("a")))
    degree = both.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("deg"))
    label = (reps.join(comp, F.col("rep") == F.col("node"), "left").drop("node")
             .join(degree, F.col("rep") == F.col("node"), "left")
             .select("d1", "d2", F.coalesce("component", "rep").alias("component"), F.coalesce("deg", F.lit(0)).cast("long").alias("n_links")))
    out = sk_all.select("id", "n_shingles", "d1", "d2").join(label, ["d1", "d2"], "left")
    return out.select(
        "id", "n_shingles", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one document (the smallest id) of each class; rows that repeat it are kept once.

    Rows with a null id and empty documents stay.
    """
    scratch = Scratch(docs.sparkSession, "near-dedup-keep")
    cls = scratch.write(near_duplicate_classes(docs, id_col, text_col, **options).select("id", "n_shingles", "component"), "classes")
    key = F.col(f"`{id_col}`").cast("long")

    def named(ids):
        ids = ids.withColumnRenamed("id", "__n_id")
        return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids
    cond = key == F.col("__n_id")
    lead = cls.filter("n_shingles > 0 and id = component").select("id")
    # an id whose rows are of several classes stays if it leads one of them
    out = docs.join(named(cls.filter("id <> component").select("id").distinct().join(lead, "id", "left_anti")), cond, "left_anti")
    twice = scratch.write(lead.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"), "repeated")
    if not twice.isEmpty():
        again = named(twice)
        out = out.join(again, cond, "left_anti").unionByName(docs.join(again, cond, "left_semi").dropDuplicates([id_col, text_col]))
    return out
