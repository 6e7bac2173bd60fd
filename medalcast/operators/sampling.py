"""Replicated weighted sampling of 3-2-1 votes.

The original draws, per simulated season and per match, a 3-vote winner with
probability proportional to ``round(100 p)``, removes every row of that
(match, name), draws the 2-vote winner from the rest, then the 1-vote winner.

Here the three dependent draws are one ranking: each (contest, name) gets the
exponential race key ``-ln(u) / w`` with ``u`` uniform and ``w`` its summed
weight, and the k smallest keys are the ordered draws (Efraimidis & Spirakis,
2006: ordering by ``u^(1/w)`` is weighted sampling without replacement,
equal in law to the sequential draws). ``u`` is a pure function of
(seed, contest, name, sim): 64 bits of an MD5 digest of (seed, contest, name),
computed once per weighted name, drive a stream of 52-bit uniforms indexed by
the simulation number, so a retried task redraws the same values and two names
share a stream only if all 64 bits agree.

Scale notes
-----------
* Weights are summed per (contest, name) first (partial aggregation) and written
  once. Each weighted name is shipped once, by contest; simulations exist only
  inside the tasks, in numpy blocks of names x simulations.
* A task of ``season_draws`` holds its contests' rows, a few bytes each, and draws
  them block by block of simulations: the votes of all of them are summed per
  (name, simulation) before anything leaves it, as one narrow array per name and
  block. Tasks are as few as ``TASK_ROWS`` and the cores allow, since each gives
  out every name it has. Podiums are counted contest by contest.
* A contest with more than ``CHUNK`` names is split by a hash of the name. The
  k smallest keys of a union are the k smallest of the parts' k smallest, so
  each part sends its k best per simulation and these are ranked again.
* Runs of any number of simulations keep the same memory; ``first_sim`` lets a
  run be cut into batches that draw the same values. ``resumable_draws`` writes
  each batch to a folder of its own, which a replay overwrites, so a season of
  10,000 simulations goes on after a lost driver where it stopped.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import MIX_C1, MIX_C2, MIX_STEP, copies_weight, hash32
from ..session import cut_lineage

CHUNK = 4096            # names of a contest ranked in one task
SIM_BLOCK = 256         # simulations drawn at once
CELLS = 1 << 19         # names x simulations held at once, about
HELD = 1 << 27          # names x simulations of a block whose votes a task sums before it gives them out
TASK_ROWS = 1 << 22     # weighted names that a task holds and sums at once
TASKS_PER_CORE = 4      # tasks of a pass over the races, if the session's shuffle partitions are more
SIM_BATCH = 1000        # simulations of a resumable batch
TILE = 1 << 15          # names x simulations of one numpy step
PAIRED = 24             # names of a contest that are compared pair by pair
DENSE = 1 << 10         # possible podiums of a contest that are counted in an array
ROUNDS = 32             # times that a name may stand in a table of runs to be added row by row
GIVEN = 1 << 18         # values that a task gives out at once


def contest_weights(df: DataFrame, contest: str, name: str, prob: str,
                    scale: int = 100) -> DataFrame:
    """Integer weight per (contest, name): summed ``round(scale * p)`` copies, only > 0."""
    w = copies_weight(prob, scale)
    return (df.select(F.col(contest), F.col(name), w.alias("_w")).filter(F.col("_w") > 0)
            .groupBy(contest, name).agg(F.sum("_w").alias("weight")))


# ---- the draws, in numpy ------------------------------------------------------------------

def _mix32(h: np.ndarray) -> np.ndarray:
    """MurmurHash3's finaliser, in place."""
    h ^= h >> np.uint32(16)
    h *= np.uint32(MIX_C1)
    h ^= h >> np.uint32(13)
    h *= np.uint32(MIX_C2)
    h ^= h >> np.uint32(16)
    return h


def stream_uniforms(a: np.ndarray, b: np.ndarray, sims: np.ndarray) -> np.ndarray:
    """[names, sims] uniforms in (0, 1) of the streams with state words a, b (32 bits each)."""
    a, b = a.astype(np.uint32)[:, None], b.astype(np.uint32)[:, None]
    x = _mix32(a + (sims.astype(np.int64) * MIX_STEP & 0xFFFFFFFF).astype(np.uint32)[None, :])
    y = _mix32(x ^ b)
    x += y
    z = _mix32(x)
    u = y.astype(np.float64)          # 52 bits and a half: every step is exact
    u *= 1048576.0
    u += z >> np.uint32(12)
    u += 0.5
    u /= 4503599627370496.0
    return u


def _keys(weight: np.ndarray, a: np.ndarray, b: np.ndarray, sims: np.ndarray) -> np.ndarray:
    """[names, sims] race keys ``-ln(u) / weight``, a few rows at a time, so that the steps stay in the cache."""
    keys = np.empty((len(weight), len(sims)))
    step = max(1, TILE // len(sims))
    for i in range(0, len(weight), step):
        u = stream_uniforms(a[i:i + step], b[i:i + step], sims)
        np.log(u, out=u)
        np.negative(u, out=u)
        np.divide(u, weight[i:i + step, None], out=keys[i:i + step])
    return keys


def _places(starts: np.ndarray, n: int, keys: np.ndarray, k: int) -> np.ndarray:
    """Place of each row in its contest as [names, sims]: 0 for the smallest key; ``k`` or more gets nothing.

    Rows of a contest lie together, in name order, from ``starts`` on; the first name wins where keys tie. The
    names of a small contest are compared pair by pair, for all contests of that size at once; of a larger one
    the k smallest keys are taken one by one.
    """
    size = np.diff(np.append(starts, n))
    out = np.empty(keys.shape, np.uint8 if k < 255 else np.int32)
    for m in np.unique(size[size <= PAIRED]):
        first = starts[size == m]
        step = max(1, TILE // (int(m) * keys.shape[1]))
        for i in range(0, len(first), step):
            rows = first[i:i + step]
            key = [keys[rows + j] for j in range(m)]
            place = [np.zeros(key[0].shape, out.dtype) for _ in range(m)]
            for j in range(m):
                for later in range(j + 1, m):
                    ahead = key[j] <= key[later]
                    place[later] += ahead
                    place[j] += ~ahead
            for j in range(m):
                out[rows + j] = place[j]
    for at, m in zip(starts[size > PAIRED], size[size > PAIRED], strict=True):
        own, places = keys[at:at + m].copy(), out[at:at + m]
        places[:] = k
        s = np.arange(keys.shape[1])
        for j in range(min(k, int(m))):
            win = own.argmin(axis=0)                  # the first name, if keys tie
            places[win, s] = j
            own[win, s] = np.inf
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of whole (contest, part) runs of sorted rows, about CELLS / SIM_BLOCK rows each."""
    held, limit = None, max(1, CELLS // SIM_BLOCK)
    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        mark = held.column("_run").to_numpy()
        edge = np.flatnonzero(mark[1:] != mark[:-1]) + 1
        at = 0
        while len(edge) and held.num_rows - at > limit:
            cut = edge[np.searchsorted(edge, at + limit, side="right") - 1]
            if cut <= at:
                later = edge[edge > at]
                if not len(later):
                    break
                cut = later[0]
            yield held.slice(at, cut - at)
            at = int(cut)
        held = held.slice(at)
    if held is not None and held.num_rows:
        yield held


def _blocks(t: pa.Table, n_sims: int, k: int, first_sim: int):
    """(simulations, keys, places) of every block of simulations of a table of whole runs, and where its runs start."""
    run = t.column("_run").to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    w, a, b = (t.column(c).to_numpy() for c in ("weight", "_a", "_b"))

    def drawn():
        for s in range(first_sim, first_sim + n_sims, SIM_BLOCK):
            sims = np.arange(s, min(s + SIM_BLOCK, first_sim + n_sims))
            keys = _keys(w, a, b, sims)
            yield sims, keys, _places(starts, t.num_rows, keys, k)
    return starts, drawn()


# ---- layout -------------------------------------------------------------------------------

def _large(weights: DataFrame, contest: str) -> DataFrame:
    """Contests of too many names for one task, with their ``_names``."""
    return weights.groupBy(contest).agg(F.count(F.lit(1)).alias("_names")).filter(F.col("_names") > CHUNK)


def _draw_tasks(weights: DataFrame) -> int:
    """Tasks of a pass: the votes that leave it grow with their number, and small tables of runs draw slowly; what they hold is at most ``TASK_ROWS``."""
    spark = weights.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(n, TASKS_PER_CORE * spark.sparkContext.defaultParallelism), -(-weights.count() // TASK_ROWS))


def _laid_out(weights: DataFrame, contest: str, name: str, weight: str, seed: int, split: bool, tasks: int | None = None) -> DataFrame:
    """Weighted names with their stream words, dealt by (contest, part) over ``tasks`` (the shuffle partitions) and sorted.

    ``weights`` is a written table; ``split`` tells whether any contest is ``_large``. ``_run`` numbers the runs of
    a task; ``_part`` is -1 for a contest that isn't split.
    """
    rows = weights.select(contest, name, F.col(weight).cast("double").alias("weight"),
                          hash32(F.lit(seed), F.col(contest), F.col(name)).alias("_a"),
                          hash32(F.lit(seed), F.col(contest), F.col(name), word=1).alias("_b"))
    if split:
        parts = F.ceil(F.col("_names") / F.lit(CHUNK)).cast("int")
        rows = (rows.join(_large(weights, contest), contest, "left")
                .withColumn("_part", F.when(F.col("_names").isNull(), F.lit(-1))
                            .otherwise(F.pmod(F.xxhash64(name), F.greatest(parts, F.lit(1))).cast("int")))
                .drop("_names"))
    else:
        rows = rows.withColumn("_part", F.lit(-1))
    n = tasks or int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # an explicit count: few rows enter, but each stands for many races, so AQE must not merge them by size
    rows = rows.repartition(n, contest, "_part").sortWithinPartitions(contest, "_part", name)
    return rows.withColumn("_run", F.xxhash64(contest, "_part"))


def _written_weights(df: DataFrame, contest: str, name: str, prob: str, scale: int) -> DataFrame:
    return cut_lineage(contest_weights(df, contest, name, prob, scale), "weights")


def _ranked_again(best: DataFrame, contest: str, sim: str, name: str, k: int) -> DataFrame:
    """The k best of a split contest's parts' k best, with their ``_place``."""
    w = Window.partitionBy(contest, sim).orderBy("_key", name)
    return best.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= k)


# ---- long votes ---------------------------------------------------------------------------

MASKS = [f"mask{i}" for i in range(SIM_BLOCK // 64)]


def sample_votes(df: DataFrame, contest: str, name: str, prob: str, n_sims: int, k: int = 3,
                 seed: int = 0, scale: int = 100, first_sim: int = 1, sim_col: str = "sim",
                 votes_col: str = "votes", packed: bool = False) -> DataFrame:
    """Simulated 3-2-1 votes: one row per (sim, contest, awarded name).

    ``votes = k + 1 - draw``, so a contest with fewer than k weighted names
    gives only the first places (N16). ``packed`` gives the same draws as one row per (contest, name, votes,
    block of simulations): ``sim`` is the block's first simulation, and bit b of ``MASKS[i]`` stands for
    simulation ``sim + 64 i + b``.
    """
    weights = _written_weights(df, contest, name, prob, scale)
    split = not _large(weights, contest).isEmpty()
    laid = _laid_out(weights, contest, name, "weight", seed, split)
    fields = {f.name: f.dataType for f in laid.schema.fields}
    out = [sim_col, contest, name, votes_col]
    head = [T.StructField(sim_col, T.LongType()), T.StructField(contest, fields[contest]), T.StructField(name, fields[name]),
            T.StructField(votes_col, T.LongType())]
    long = T.StructType([*head, T.StructField("_key", T.DoubleType())])
    masked = T.StructType([*head, *[T.StructField(m, T.LongType()) for m in MASKS]])

    def run(batches):
        for t in _runs(batches):
            t = t.combine_chunks()
            who, where = t.column(name).combine_chunks(), t.column(contest).combine_chunks()
            for sims, keys, places in _blocks(t, n_sims, k, first_sim)[1]:
                for j in range(k):
                    r, s = np.nonzero(places == j)
                    for i in range(0, len(r), GIVEN):
                        ri, si = r[i:i + GIVEN], s[i:i + GIVEN]
                        rows = pa.array(ri)
                        yield pa.RecordBatch.from_arrays([pa.array(sims[si]), where.take(rows), who.take(rows), pa.array(np.full(len(ri), k - j, np.int64)),
                                                          pa.array(keys[ri, si])], names=long.names)

    def run_packed(batches):
        for t in _runs(batches):
            t = t.combine_chunks()
            who, where = t.column(name).combine_chunks(), t.column(contest).combine_chunks()
            for sims, _, places in _blocks(t, n_sims, k, first_sim)[1]:
                for j in range(k):
                    bits = np.zeros((t.num_rows, SIM_BLOCK // 8), np.uint8)
                    hit = np.packbits(places == j, axis=1, bitorder="little")
                    bits[:, :hit.shape[1]] = hit
                    words = bits.view("<i8")
                    some = np.flatnonzero(words.any(axis=1))
                    rows = pa.array(some)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), sims[0], np.int64)), where.take(rows), who.take(rows),
                                                      pa.array(np.full(len(some), k - j, np.int64)),
                                                      *[pa.array(np.ascontiguousarray(words[some, i])) for i in range(len(MASKS))]], names=masked.names)
    whole = laid.filter(F.col("_part") < 0)
    whole = whole.mapInArrow(run_packed, masked) if packed else whole.mapInArrow(run, long).select(*out)
    if not split:
        return whole
    parts = _ranked_again(laid.filter(F.col("_part") >= 0).mapInArrow(run, long), contest, sim_col, name, k)
    parts = parts.withColumn(votes_col, (F.lit(k + 1) - F.col("_place")).cast("bigint")).select(*out)
    if packed:
        bit = F.col(sim_col) - F.lit(first_sim)
        parts = (parts.withColumns({"_bit": F.pmod(bit, F.lit(SIM_BLOCK)).cast("int"), sim_col: F.floor(bit / SIM_BLOCK) * SIM_BLOCK + first_sim})
                 .groupBy(*out).agg(*[F.bit_or(F.when(F.floor(F.col("_bit") / 64) == i, F.expr("shiftleft(1L, _bit % 64)")).otherwise(F.lit(0).cast("bigint"))).alias(m)
                                      for i, m in enumerate(MASKS)]))
    return whole.unionByName(parts)


def packed_sims(masks=MASKS):
    """How many simulations the masks of a packed row hold."""
    n = F.bit_count(masks[0])
    for m in masks[1:]:
        n = n + F.bit_count(m)
    return n.cast("bigint")


# ---- one pass for a season ----------------------------------------------------------------

class _Votes:
    """Votes of one task per (name, simulation) of a block, over all its contests."""

    def __init__(self, n_sims: int, first_sim: int, k: int, kind=None):
        self.n, self.first = n_sims, first_sim
        # a table of runs adds at most k votes a row; 16 bits hold several tables, then the sums are given out
        self.step = k * max(1, CELLS // SIM_BLOCK)
        self.kind = kind or (np.int16 if self.step <= 1 << 13 else np.int32)
        self._empty()

    def _empty(self):
        self.at: dict = {}
        self.most = 0
        self._votes = np.zeros((0, self.n), self.kind)

    def rows(self, names: list) -> np.ndarray:
        at = self.at
        return np.array([at.setdefault(x, len(at)) for x in names], np.int32)

    @property
    def votes(self) -> np.ndarray:
        """[names, simulations], made when it is first asked for."""
        if len(self._votes) < len(self.at):
            more = np.zeros((len(self.at), self.n), self.kind)
            more[:len(self._votes)] = self._votes
            self._votes = more
        return self._votes

    def block(self, first: int, n: int, kind) -> np.ndarray:
        """Zeros for the names so far and the ``n`` simulations from ``first`` on; the old ones are let go before."""
        self._votes = None
        self.first, self.n, self.kind = first, n, kind
        self._votes = np.zeros((len(self.at), n), kind)
        return self._votes

    def full(self) -> bool:
        return len(self.at) * self.n > HELD or self.most + self.step > np.iinfo(self.kind).max

    def given(self, names: pa.Array):
        """(names, first simulation of a block, its votes) in parts."""
        votes = self.votes
        for a in range(0, self.n, SIM_BLOCK):
            for i in range(0, len(names), GIVEN // SIM_BLOCK):
                block = votes[i:min(i + GIVEN // SIM_BLOCK, len(names)), a:a + SIM_BLOCK]
                some = np.flatnonzero(block.any(axis=1))
                if len(some):
                    flat = np.ascontiguousarray(block[some])
                    ends = np.arange(len(some) + 1, dtype=np.int32) * flat.shape[1]
                    yield (names.take(pa.array(some + i)), pa.array(np.full(len(some), self.first + a, np.int64)),
                           pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel())))

    def out(self, kind):
        """What ``given`` gives out; starts anew."""
        yield from self.given(pa.array(list(self.at), kind))
        self._empty()


def _narrow(most: int):
    """The narrowest integers that hold 0 to ``most``."""
    return next(t for t in (np.uint8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)


def _as_bytes(votes: pa.ListArray) -> tuple[pa.Array, int]:
    """Lists of one length as bytes of the narrowest integers that hold them, and the bytes of one."""
    flat = votes.flatten().to_numpy()
    flat = np.ascontiguousarray(flat.astype(_narrow(int(flat.max(initial=0))), copy=False))
    ends = np.asarray(votes.offsets, np.int32) * np.int32(flat.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(votes), [None, pa.py_buffer(ends), pa.py_buffer(flat)]), flat.itemsize


def _from_bytes(votes: pa.Array, item: np.ndarray, width: int) -> np.ndarray:
    """[rows, width] of rows of ``_as_bytes``, each of ``item`` bytes a number."""
    out = np.empty((len(votes), width), np.int32)
    for size, kind in ((1, np.uint8), (2, np.int16), (4, np.int32)):
        rows = np.flatnonzero(item == size)
        if len(rows):
            part = votes.take(pa.array(rows))
            ends = np.frombuffer(part.buffers()[1], np.int32, len(part) + 1, part.offset * 4)
            flat = np.frombuffer(part.buffers()[2], kind, len(rows) * width, int(ends[0]))
            out[rows] = flat.reshape(-1, width)
    return out


def _add_votes(sums: np.ndarray, votes: np.ndarray, order: np.ndarray, edge: np.ndarray, mine: np.ndarray) -> None:
    """Adds rows of votes to the sums ``mine`` of their names; ``order`` puts rows of a name together, from ``edge`` on."""
    size = np.diff(np.append(edge, len(order)))
    if size.max(initial=0) > ROUNDS:
        sums[mine] += np.add.reduceat(votes[order], edge, axis=0, dtype=sums.dtype)
        return
    for i in range(int(size.max(initial=0))):          # the rows of a name one after another: most stand in a table once
        has = np.flatnonzero(size > i)
        sums[mine[has]] += votes[order[edge[has] + i]]


def _podium_codes(places: np.ndarray, starts: np.ndarray, pick: np.ndarray, k: int, base: int) -> np.ndarray:
    """[contests of ``pick``, sims] positions at each place, from 1, as the digits of one number."""
    size = np.diff(np.append(starts, len(places)))
    kind = np.int16 if base ** k < 1 << 15 else np.int64
    at = (np.arange(len(places)) - np.repeat(starts, size) + 1).astype(kind)
    digit = np.array([*[base ** (k - 1 - j) for j in range(k)], 0], kind)
    return np.add.reduceat(digit[np.minimum(places, k)] * at[:, None], starts, axis=0, dtype=kind)[pick]


def _digits(code: np.ndarray, base: int, k: int) -> list[np.ndarray]:
    left, cols = code.astype(np.int64), []
    for _ in range(k):
        cols.insert(0, left % base)
        left //= base
    return cols


def _podiums(places: np.ndarray, starts: np.ndarray, pick: np.ndarray, k: int):
    """Distinct (contest, position at each place, from 1) of the contests ``pick`` in a block of simulations, and how often."""
    size = np.diff(np.append(starts, len(places)))
    base = int(size[pick].max(initial=0)) + 1
    if int(size.max()) ** k >= 1 << 60 or base ** k >= 1 << 60:
        at = (np.arange(len(places)) - np.repeat(starts, size) + 1)[:, None].astype(np.int32)
        won = [np.add.reduceat(np.where(places == j, at, np.int32(0)), starts, axis=0)[pick] for j in range(k)]
        cols = [np.repeat(pick, places.shape[1]), *[w.ravel() for w in won]]
        return _distinct(cols, np.ones(len(cols[0]), np.int64))
    code = _podium_codes(places, starts, pick, k, base)
    code.sort(axis=1)
    new = np.ones(code.shape, bool)
    new[:, 1:] = code[:, 1:] != code[:, :-1]
    first = np.flatnonzero(new)
    return [pick[first // code.shape[1]], *_digits(code.ravel()[first], base, k)], np.diff(np.append(first, code.size))


class _Podiums:
    """Podiums of the contests ``pick`` of a table of runs, over blocks of simulations."""

    def __init__(self, starts: np.ndarray, n: int, pick: np.ndarray, k: int):
        self.starts, self.pick, self.k = starts, pick, k
        self.base = int(np.diff(np.append(starts, n))[pick].max(initial=0)) + 1
        self.span = self.base ** k
        self.dense = self.span <= DENSE
        self.times = np.zeros(len(pick) * self.span, np.int64) if self.dense else np.zeros(0, np.int64)
        self.seen = [np.zeros(0, np.int64) for _ in range(k + 1)]

    def add(self, places: np.ndarray) -> None:
        if not len(self.pick):
            return
        if self.dense:
            code = _podium_codes(places, self.starts, self.pick, self.k, self.base).astype(np.int64)
            code += (np.arange(len(self.pick)) * self.span)[:, None]
            self.times += np.bincount(code.ravel(), minlength=len(self.times))
            return
        found, times = _podiums(places, self.starts, self.pick, self.k)
        self.seen, self.times = ((found, times) if not len(self.times) else
                                 _distinct([np.concatenate(x) for x in zip(self.seen, found, strict=True)], np.concatenate([self.times, times])))

    def counted(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Distinct (contest, position at each place), by contest, and how often."""
        if not self.dense:
            return self.seen, self.times
        some = np.flatnonzero(self.times)
        return [self.pick[some // self.span], *_digits(some % self.span, self.base, self.k)], self.times[some]


def _distinct(cols: list[np.ndarray], counts: np.ndarray):
    """Distinct rows of the columns (non-negative) with their summed counts."""
    widths = [int(c.max()) + 1 if len(c) else 1 for c in cols]
    span = 1
    for w in widths:
        span *= w
    code = np.zeros(len(counts), np.int64)
    for c, w in zip(cols, widths, strict=True):
        if span >= 1 << 62:               # dense numbers place by place, so that nothing overflows
            code = np.unique(code, return_inverse=True)[1]
        code = code * w + c
    _, first, back = np.unique(code, return_index=True, return_inverse=True)
    return [c[first] for c in cols], np.bincount(back, weights=counts, minlength=len(first)).astype(np.int64)


def season_draws(weights: DataFrame, contest: str, name: str, n_sims: int, k: int = 3, seed: int = 0, first_sim: int = 1,
                 totals: bool = True, podiums: bool = True, split: bool | None = None, modal: bool = False) -> DataFrame:
    """All draws of a season, summed: rows of three kinds.

    ``votes``: (name, sim, votes, n): the votes of a task in a block of simulations from ``sim`` on, integers of ``n`` bytes.
    ``podium``: (contest, places, n): how often a contest had these places (positions in name order from 1, 0 for none).
    ``part``: (contest, sim, name, key): the k best of a part of a split contest, to be ranked again.
    ``weights`` is a written table of (contest, name, weight); ``split`` tells whether any contest has more than
    ``CHUNK`` names (looked up if not given). With ``modal`` a contest's most frequent places alone are given out, all
    of them where counts tie: right where one pass draws all simulations, as a contest's are drawn in one task.
    Votes are drawn block by block over all contests, podiums contest by contest: of more than one block, both together
    draw twice.
    """
    split = not _large(weights, contest).isEmpty() if split is None else split
    laid = _laid_out(weights, contest, name, "weight", seed, split, _draw_tasks(weights))
    fields = {f.name: f.dataType for f in laid.schema.fields}
    schema = T.StructType([
        T.StructField("kind", T.StringType()), T.StructField(contest, fields[contest]), T.StructField(name, fields[name]),
        T.StructField("sim", T.LongType()), T.StructField("votes", T.BinaryType()), T.StructField("places", T.ArrayType(T.IntegerType())),
        T.StructField("n", T.LongType()), T.StructField("key", T.DoubleType())])
    together = n_sims <= SIM_BLOCK

    def run(batches):
        held, kept, types = _Votes(min(n_sims, SIM_BLOCK), first_sim, k, np.int32), [], None

        def batch(kind, size, **cols):
            cols["kind"] = pa.array([kind] * size)
            return pa.RecordBatch.from_arrays([cols.get(f) if f in cols else pa.nulls(size, types[f]) for f in schema.names], names=schema.names)

        def parts(t, sims, keys, places, unsplit):
            """The k best of the parts of split contests among the rows."""
            if unsplit.all():
                return
            r, s = np.nonzero((places < k) & ~unsplit[:, None])
            for i in range(0, len(r), GIVEN):
                ri, si = r[i:i + GIVEN], s[i:i + GIVEN]
                rows = pa.array(ri)
                yield batch("part", len(ri), **{contest: t.column(contest).combine_chunks().take(rows), "sim": pa.array(sims[si]),
                                                name: t.column(name).combine_chunks().take(rows), "key": pa.array(keys[ri, si])})

        def counted(seen, counts, first_of):
            """Rows of podiums; ``first_of`` has the contest of each run."""
            if modal and len(counts):
                first = np.flatnonzero(np.diff(seen[0], prepend=-1))
                best = np.maximum.reduceat(counts, first)
                top = counts == np.repeat(best, np.diff(np.append(first, len(counts))))
                seen, counts = [c[top] for c in seen], counts[top]
            if len(counts):
                flat = np.stack(seen[1:], axis=1).astype(np.int32).ravel()
                ends = np.arange(len(counts) + 1, dtype=np.int32) * k
                yield batch("podium", len(counts), **{contest: first_of.take(pa.array(seen[0])),
                                                      "places": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), "n": pa.array(counts)})

        def by_contest(t):
            """Podiums of a table of runs, over all simulations; its parts too, if no votes are summed."""
            starts, blocks = _blocks(t, n_sims, k, first_sim)
            unsplit = t.column("_part").to_numpy() < 0
            pick = np.flatnonzero(unsplit[starts])
            tally = _Podiums(starts, t.num_rows, pick, k)
            for sims, keys, places in blocks:
                if not totals:
                    yield from parts(t, sims, keys, places, unsplit)
                tally.add(places)
            yield from counted(*tally.counted(), t.column(contest).combine_chunks().take(pa.array(starts)))

        def keep(t):
            """What the sums need of a table of runs, a few bytes a row."""
            run = t.column("_run").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            unsplit = t.column("_part").to_numpy() < 0
            code = t.column(name).combine_chunks().dictionary_encode()
            who = code.indices.fill_null(len(code.dictionary)).to_numpy()
            mine = held.rows([*code.dictionary.to_pylist(), *([None] if code.null_count else [])])
            order = np.flatnonzero(unsplit)
            order = order[np.argsort(who[order], kind="stable")].astype(np.int32)
            edge = np.flatnonzero(np.diff(who[order], prepend=-1)).astype(np.int32)
            return (t.column("weight").to_numpy().copy(), t.column("_a").to_numpy().astype(np.uint32), t.column("_b").to_numpy().astype(np.uint32),
                    starts, unsplit, order, edge, mine[who[order[edge]]], t.column(contest).combine_chunks().take(pa.array(starts)) if podiums and together else None,
                    t if not unsplit.all() else None)

        def given_out():
            """Votes of all that is kept, block by block; podiums too, if there is but one block."""
            times = np.zeros(len(held.at), np.int64)
            for *_, order, edge, mine, _, _ in kept:
                times[mine] += np.diff(np.append(edge, len(order)))
            kind, names = _narrow(k * int(times.max(initial=0))), pa.array(list(held.at), types[name])
            for s in range(first_sim, first_sim + n_sims, SIM_BLOCK):
                sims = np.arange(s, min(s + SIM_BLOCK, first_sim + n_sims))
                sums = held.block(s, len(sims), kind)
                for w, a, b, starts, unsplit, order, edge, mine, first_of, t in kept:
                    keys = _keys(w, a, b, sims)
                    places = _places(starts, len(w), keys, k)
                    yield from parts(t, sims, keys, places, unsplit)
                    _add_votes(sums, (k - np.minimum(places, k)).astype(kind), order, edge, mine)
                    if podiums and together:
                        tally = _Podiums(starts, len(w), np.flatnonzero(unsplit[starts]), k)
                        tally.add(places)
                        yield from counted(*tally.counted(), first_of)
                sums = None
                for who, block, votes in held.given(names):
                    packed, size = _as_bytes(votes)
                    yield batch("votes", len(who), **{name: who, "sim": block, "votes": packed, "n": pa.array(np.full(len(who), size, np.int64))})
            held._empty()
            kept.clear()
        n_kept = 0
        for t in _runs(batches):
            t = t.combine_chunks()
            if types is None:
                types = {contest: t.schema.field(contest).type, name: t.schema.field(name).type, "kind": pa.string(), "sim": pa.int64(),
                         "votes": pa.binary(), "places": pa.list_(pa.int32()), "n": pa.int64(), "key": pa.float64()}
            if podiums and not (totals and together):
                yield from by_contest(t)
            if totals:
                kept.append(keep(t))
                n_kept += t.num_rows
                if n_kept >= TASK_ROWS or held.full():
                    yield from given_out()
                    n_kept = 0
        if kept:
            yield from given_out()
    return laid.mapInArrow(run, schema)


_modal_draws = partial(season_draws, totals=False, modal=True)


def resumable_draws(weights: DataFrame, contest: str, name: str, n_sims: int, path: str, k: int = 3, seed: int = 0,
                    batch: int = SIM_BATCH) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """(votes, podiums, weights, whether contests are split): ``season_draws`` written under ``path`` in batches, each complete or redone.

    Votes are summed in batches of simulations. Podiums are counted in as many batches of contests, each over all
    simulations, so that the most frequent ones alone are written. A batch is a folder that Spark marks when it is
    whole; a run with the same arguments skips whole ones and overwrites others, so it goes on after a lost driver.
    The weights are kept beside them: a second run under the same path draws from the first one's.
    """
    spark = weights.sparkSession
    base = os.path.join(path, f"k{k}-seed{seed}-batch{batch}")
    kept = os.path.join(path, "weights")
    if not _whole(spark, kept):
        weights.write.mode("overwrite").parquet(kept)
    weights = spark.read.parquet(kept)
    split = not _large(weights, contest).isEmpty()
    firsts = range(1, n_sims + 1, batch)
    votes = {s: os.path.join(base, f"sims-{s}-{min(s + batch, n_sims + 1) - 1}") for s in firsts}
    for s in firsts:
        if not _whole(spark, votes[s]):
            season_draws(weights, contest, name, min(batch, n_sims + 1 - s), k, seed, s, podiums=False, split=split).write.mode("overwrite").parquet(votes[s])
    podiums = [os.path.join(base, f"podiums-{n_sims}-{i + 1}-of-{len(firsts)}") for i in range(len(firsts))]
    for i, to in enumerate(podiums):
        if not _whole(spark, to):
            some = weights.filter(F.pmod(F.hash(contest), F.lit(len(firsts))) == i)
            _modal_draws(some, contest, name, n_sims, k, seed, split=split).write.mode("overwrite").parquet(to)
    return spark.read.parquet(*votes.values()), spark.read.parquet(*podiums), weights, split


def _whole(spark, path: str) -> bool:
    """Whether a write to ``path`` was committed."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def draw_totals(draws: DataFrame, contest: str, name: str, k: int = 3, split: bool = True) -> DataFrame:
    """(name, sim, total_votes) of ``season_draws``: arrays of one name and block are added up, then spread.

    ``split`` says whether the draws may hold split contests; they are a written table then.
    """
    fields = {f.name: f.dataType for f in draws.schema.fields}
    schema = T.StructType([T.StructField(name, fields[name]), T.StructField("sim", T.LongType()), T.StructField("total_votes", T.LongType())])
    src = (draws.filter(F.col("kind") == "votes").select(name, "sim", (F.octet_length("votes") / F.col("n")).cast("int").alias("_w"), "votes", "n")
           .repartition(name, "sim").sortWithinPartitions(name, "sim"))

    def run(batches):
        held = None                      # the name, block and sums that may go on in the next batch

        def spread(who, sim, votes):
            i, s = np.nonzero(votes)
            return pa.RecordBatch.from_arrays([who.take(pa.array(i)), pa.array(sim[i] + s), pa.array(votes[i, s])], names=schema.names)
        for b in (b.slice(i, GIVEN // SIM_BLOCK) for b in batches for i in range(0, b.num_rows, GIVEN // SIM_BLOCK)):
            t = pa.Table.from_batches([b])
            if held is not None:
                t = pa.concat_tables([held, t])
            t = t.combine_chunks()
            who = t.column(0).combine_chunks()
            code = who.dictionary_encode()
            code = (code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code).indices.fill_null(-1).to_numpy()
            sim = t.column(1).to_numpy()
            new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (sim[1:] != sim[:-1])]))
            held = t.slice(int(new[-1]))
            width, item = t.column(2).to_numpy(), t.column(4).to_numpy()
            ends = np.append(new[1:], len(sim))
            for w in np.unique(width[new[:-1]]):          # the last block of a season may be shorter
                runs = np.flatnonzero(width[new[:-1]] == w)
                rows = np.concatenate([np.arange(new[r], ends[r]) for r in runs])
                votes = _from_bytes(t.column(3).combine_chunks().take(pa.array(rows)), item[rows], int(w))
                size = ends[runs] - new[runs]
                total = np.add.reduceat(votes, np.cumsum(size) - size, axis=0, dtype=np.int64)
                yield spread(who.take(pa.array(new[runs])), sim[new[runs]], total)
        if held is not None:
            votes = _from_bytes(held.column(3).combine_chunks(), held.column(4).to_numpy(), int(held.column(2)[0].as_py()))
            yield spread(held.column(0).combine_chunks().slice(0, 1), held.column(1).to_numpy()[:1], votes.sum(axis=0, dtype=np.int64)[None, :])
    out = src.mapInArrow(run, schema)
    if not split:
        return out
    parts = draws.filter(F.col("kind") == "part").select(contest, "sim", name, F.col("key").alias("_key"))
    more = _ranked_again(parts, contest, "sim", name, k).select(name, "sim", (F.lit(k + 1) - F.col("_place")).cast("bigint").alias("total_votes"))
    return out.unionByName(more).groupBy(name, "sim").agg(F.sum("total_votes").cast("bigint").alias("total_votes"))


def draw_podiums(draws: DataFrame, weights: DataFrame, contest: str, name: str, k: int = 3, split: bool = True) -> DataFrame:
    """Most frequent ordered podium of each contest of ``season_draws`` (D11, N26), with its places.

    Columns: contest, ``v<k>`` .. ``v1`` (NULL where fewer names were drawn) and ``combo``, the places joined by
    `` > ``. Equal counts go to the first text. Only contests with a weighted name appear.
    """
    cols = [f"v{k - j}" for j in range(k)]
    counted = draws.filter(F.col("kind") == "podium").groupBy(contest, "places").agg(F.sum("n").alias("n"))
    most = F.rank().over(Window.partitionBy(contest).orderBy(F.desc("n")))
    top = counted.withColumn("_r", most).filter(F.col("_r") == 1)
    # a contest that isn't split has at most CHUNK names
    names = (weights.groupBy(contest).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") <= CHUNK).drop("_n") if split else None)
    mine = weights if names is None else weights.join(names, contest, "left_semi")
    listed = mine.groupBy(contest).agg(F.sort_array(F.collect_list(F.struct(name))).alias("_names"))      # a missing name comes first, as in the races
    place = [F.when(F.col("places")[j] > 0, F.element_at("_names", F.greatest(F.col("places")[j], F.lit(1)))[name]).alias(c) for j, c in enumerate(cols)]
    text = F.concat_ws(" > ", *cols)
    named = top.join(listed, contest).select(contest, *place).withColumn("combo", text)
    out = named.groupBy(contest).agg(F.min_by(F.struct(*cols, "combo"), "combo").alias("_p")).select(contest, "_p.*")
    if not split:
        return out
    parts = draws.filter(F.col("kind") == "part").select(contest, "sim", name, F.col("key").alias("_key"))
    ranked = _ranked_again(parts, contest, "sim", name, k)
    podium = ranked.groupBy(contest, "sim").agg(*[F.max(F.when(F.col("_place") == j + 1, F.col(name))).alias(c) for j, c in enumerate(cols)])
    times = podium.groupBy(contest, *cols).agg(F.count(F.lit(1)).alias("_n")).withColumn("combo", text)
    first = Window.partitionBy(contest).orderBy(F.desc("_n"), "combo")
    hot = times.withColumn("_r", F.row_number().over(first)).filter("_r = 1").select(contest, *cols, "combo")
    return out.unionByName(hot)


def season_totals(df: DataFrame, contest: str, name: str, prob: str, n_sims: int, k: int = 3, seed: int = 0,
                  scale: int = 100, first_sim: int = 1) -> DataFrame:
    """(name, sim, total_votes) over all contests: ``sample_votes`` summed, without its rows."""
    weights = _written_weights(df, contest, name, prob, scale)
    draws, split = _lone_draws(weights, contest, name, n_sims, k, seed, first_sim, podiums=False)
    return draw_totals(draws, contest, name, k, split)


def modal_podiums(df: DataFrame, contest: str, name: str, prob: str, n_sims: int, k: int = 3, seed: int = 0,
                  scale: int = 100, first_sim: int = 1) -> DataFrame:
    """Most frequent ordered podium of each contest over the simulations, as ``draw_podiums`` gives it."""
    weights = _written_weights(df, contest, name, prob, scale)
    draws, split = _lone_draws(weights, contest, name, n_sims, k, seed, first_sim, totals=False, modal=True)
    return draw_podiums(draws, weights, contest, name, k, split)


def _lone_draws(weights, contest, name, n_sims, k, seed, first_sim, **what):
    """Draws with one reader, and whether contests are split; written only if they are, as the parts are read apart."""
    split = not _large(weights, contest).isEmpty()
    draws = season_draws(weights, contest, name, n_sims, k, seed, first_sim, split=split, **what)
    return (cut_lineage(draws, "draws") if split else draws), split


def season_tables(df: DataFrame, contest: str, name: str, prob: str, n_sims: int, k: int = 3, seed: int = 0, scale: int = 100,
                  path: str | None = None, batch: int = SIM_BATCH) -> tuple[DataFrame, DataFrame]:
    """(totals, podiums) of a season from one pass over its races, whose sums are written.

    With a ``path`` the simulations run in batches that a later call resumes (``resumable_draws``).
    """
    if path is None:
        weights = _written_weights(df, contest, name, prob, scale)
        split = not _large(weights, contest).isEmpty()
        draws = best = cut_lineage(season_draws(weights, contest, name, n_sims, k, seed, split=split, modal=True), "draws")
    else:
        draws, best, weights, split = resumable_draws(contest_weights(df, contest, name, prob, scale), contest, name, n_sims, path, k, seed, batch)
    return draw_totals(draws, contest, name, k, split), draw_podiums(best, weights, contest, name, k, split)
