"""Quality classifier from weak labels.

Nine heuristic labellers look at a text and vote good (2), bad (0) or abstain
(1). A vote pattern has at most 3^9 forms; Spark counts them over all
documents, and expectation-maximisation on those counts estimates, for each
labeller and class, how often it casts each vote (overlapping labellers with
class-conditional error rates, after Dawid & Skene, 1979). Kinds of junk don't
occur together, so one class of bad texts would take in one kind alone and leave
the others among the good ones, with labellers that object to many of them; a
labeller therefore objects to at most ``OBJECTS`` of the good texts. Posterior
class probabilities of at most ``TRAIN_ROWS`` documents, first in hash order of
the id, then train a hashed linear scorer (logistic regression on soft targets)
that scores every whole text in the tasks. Its features are words and word
shapes, and the steps in which the labellers' measures lie.

No given label is read. Cases: null, empty and wordless texts get the score
``EMPTY_SCORE`` and are not kept. Repeated rows get equal scores; rows of one id
with different texts are documents of their own. An empty table gives an empty
one. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .sample import pick
from .textvec import U, mix

LABELLERS = ["length", "word_length", "symbols", "variety", "capitals", "sentence_ends", "shouting", "line_repeats", "tidy"]
#: steps of the measures, as features of the scorer
STEPS = {"n": [1, 10, 30, 50, 80, 150, 400, 1000], "mean": [2, 3, 4, 5, 6, 8, 10, 14], "symbols": [0.001, 0.02, 0.05, 0.1, 0.2, 0.5, 1],
         "variety": [1, 2, 3, 4, 5, 7, 10], "upper": [0.01, 0.03, 0.08, 0.15, 0.3, 0.6, 1], "word_end": [0.005, 0.03, 0.08, 0.15, 0.3, 0.5],
         "bang": [0.001, 0.02, 0.05, 0.1, 0.3], "repeats": [0.001, 0.05, 0.1, 0.2, 0.3, 0.5]}
BUCKETS = 1 << 18
TRAIN_ROWS = 4_000       # documents the scorer is trained on, at most
EM_ROUNDS = 50
OBJECTS = 0.02           # share of good texts that a labeller objects to, at most
EPOCHS = 120
RATE = 0.05
L2 = 1e-5
EMPTY_SCORE = 0.0
KEEP_AT = 0.5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>{}[]=^~_\\@")] = True
_END = np.zeros(256, bool)
_END[list(b".!?:\"')")] = True
_SHAPE = np.zeros(256, np.int64)                 # bit a byte sets in its word's shape
_SHAPE[0x61:0x7B] = 1
_SHAPE[0x41:0x5B] = 2
_SHAPE[0x30:0x3A] = 4
_SHAPE[0x80:] = 8
_SHAPE[list(b".,;:?!'\"()-")] = 16
_SHAPE[_SYMBOL] = 32


def _per_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(total[off])


def measures(buf, off, starts, ends, h, first) -> dict[str, np.ndarray]:
    """What the labellers look at, per row; word lengths in code points."""
    n_rows = len(off) - 1
    n = np.diff(first)
    row = tv.row_ids(first)
    some = np.maximum(n, 1)
    chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    mean = np.bincount(row, weights=chars[ends] - chars[starts], minlength=n_rows) / some
    symbols = _per_row(_SYMBOL[buf], off) / some
    upper = _per_row((buf >= 65) & (buf <= 90), off) / np.maximum(_per_row((buf >= 97) & (buf <= 122), off), 1)
    bang = _per_row(buf == 0x21, off) / some
    distinct = np.bincount(tv.distinct_per_row(row, h)[0], minlength=n_rows)
    variety = distinct / np.sqrt(some)
    word_end = np.bincount(row, weights=_END[buf[ends - 1]] if len(ends) else None, minlength=n_rows) / some
    # lines as runs of words between line ends: the same hash twice is a repeat
    lines = np.concatenate([[0], np.cumsum(buf == 0x0A)])
    new = np.ones(len(starts), bool)
    if len(starts):
        new[1:] = lines[starts[1:]] != lines[ends[:-1]]
        new[first[:-1][n > 0]] = True
    head = np.flatnonzero(new)
    place = np.arange(len(h)) - np.repeat(head, np.diff(np.append(head, len(h))))
    lh = mix(np.add.reduceat(mix(h + place.astype(U)), head)) if len(head) else np.zeros(0, U)
    lrow = row[head]
    n_lines = np.maximum(np.bincount(lrow, minlength=n_rows), 1)
    repeats = 1 - np.bincount(tv.distinct_per_row(lrow, lh)[0], minlength=n_rows) / n_lines
    return {"n": n, "mean": mean, "symbols": symbols, "variety": variety, "upper": upper, "word_end": word_end, "bang": bang, "repeats": repeats}


def votes(seen: dict[str, np.ndarray]) -> np.ndarray:
    """[rows, 9] of 0 (bad), 1 (abstains), 2 (good)."""
    n, mean, symbols, variety, upper, word_end, bang, repeats = (seen[k] for k in STEPS)

    def vote(bad, good=False):
        return np.where(bad, 0, np.where(good, 2, 1))
    return np.stack([
        vote(n < 30, n >= 80),
        vote((mean < 2) | (mean > 14)),
        vote(symbols > 0.2),
        vote(variety < 2, variety >= 5),
        vote(upper > 0.6),
        vote((word_end < 0.005) | (word_end > 0.5), (word_end >= 0.03) & (word_end <= 0.3)),
        vote(bang > 0.1),
        vote(repeats > 0.3),
        vote(n == 0, (symbols <= 0.02) & (bang <= 0.02) & (upper <= 0.15) & (n > 0)),
    ], axis=1)


def steps(seen: dict[str, np.ndarray]) -> np.ndarray:
    """[rows, measures] buckets of the measures: which of its steps each lies in, hashed."""
    cols = []
    for k, name in enumerate(STEPS):
        at = np.searchsorted(STEPS[name], seen[name], side="right")
        cols.append((mix((at + 64 * (k + 1)).astype(U) + U(0x777)) & U(BUCKETS - 1)).astype(np.int64))
    return np.stack(cols, axis=1)


def features(buf, off, starts, ends, h, first):
    """(row, bucket, value): hashed words and word shapes of each row, each bucket with its count over the root of their number,
    and the steps of its measures with 1."""
    seen = measures(buf, off, starts, ends, h, first)
    row, bucket = _words(buf, starts, ends, h, first)
    code, times = np.unique(row * BUCKETS + bucket, return_counts=True)
    row, bucket = code // BUCKETS, code % BUCKETS
    total = np.maximum(np.bincount(row, weights=times, minlength=len(off) - 1), 1)
    own = steps(seen)
    rows = np.repeat(np.arange(len(own)), own.shape[1])
    return (np.concatenate([row, rows]), np.concatenate([bucket, own.ravel()]),
            np.concatenate([times / np.sqrt(total[row]), np.ones(len(rows))]), seen)


def _words(buf, starts, ends, h, first):
    row = tv.row_ids(first)
    if not len(h):
        return row, np.zeros(0, np.int64)
    shape = np.bitwise_or.reduceat(_SHAPE[buf[starts[0]:]], starts - starts[0]) if len(starts) else np.zeros(0, np.int64)
    size = np.minimum(ends - starts, 24)
    shape_h = mix((shape * 32 + size).astype(U) + U(0x5A5A))
    words = (h & U(BUCKETS - 1)).astype(np.int64)
    shapes = (shape_h & U(BUCKETS - 1)).astype(np.int64)
    return np.concatenate([row, row]), np.concatenate([words, shapes])


def _sliced(batch, text_at):
    buf, off = tv.utf8(batch.column(text_at))
    for i, j in tv.slices(off):
        part, at = buf[off[i]:off[j]], off[i:j + 1] - off[i]
        yield i, j, (part, at, *tv.words(part, at, tv.SPACED_CASED))


def label(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pattern): the votes of every row as a base-3 number."""
    def run(batches):
        base = 3 ** np.arange(len(LABELLERS))
        for b in batches:
            for i, j, w in _sliced(b, 1):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(votes(measures(*w)) @ base)], names=["id", "pattern"])
    return _source(docs, id_col, text_col).mapInArrow(tv.lean(run), "id long, pattern long")


def _source(docs, id_col, text_col):
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))


class LabelModel:
    """Class share and vote rates of every labeller, by EM over pattern counts."""

    def __init__(self, counts: dict[int, int]):
        k = len(LABELLERS)
        pats = np.array(sorted(counts), np.int64).reshape(-1)
        n = np.array([counts[p] for p in sorted(counts)], float)
        self.good = 0.8
        # start: objections are rare in good texts; abstaining says nothing yet
        self.rate = np.tile(np.array([[0.4, 0.5, 0.1], [0.02, 0.5, 0.48]]), (k, 1, 1))   # [labeller, class, vote]
        if not n.sum():
            return
        v = self._votes(pats)
        for _ in range(EM_ROUNDS):
            p = self.posterior_of(v)
            self.good = float(np.clip((n * p).sum() / n.sum(), 0.05, 0.99))
            for j in range(k):
                for c, weight in ((0, n * (1 - p)), (1, n * p)):
                    seen = np.bincount(v[:, j], weights=weight, minlength=3) + [0.5, 1.0, 0.5]
                    self.rate[j, c] = self._bounded(seen / seen.sum()) if c else seen / seen.sum()

    @staticmethod
    def _bounded(rate):
        """Rates in good texts, with bad votes held at ``OBJECTS``."""
        over = rate[0] > OBJECTS
        return np.array([OBJECTS, *(rate[1:] * (1 - OBJECTS) / rate[1:].sum())]) if over else rate

    @staticmethod
    def _votes(patterns):
        return (patterns[:, None] // 3 ** np.arange(len(LABELLERS))[None, :]) % 3

    def posterior_of(self, v):
        z = np.log(self.good / (1 - self.good))
        for j in range(len(LABELLERS)):
            z = z + np.log(self.rate[j, 1][v[:, j]] / self.rate[j, 0][v[:, j]])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def posterior(self, patterns):
        return self.posterior_of(self._votes(np.asarray(patterns, np.int64)))


def _scores(weights, bias, row, bucket, value, n_rows):
    z = bias + np.bincount(row, weights=weights[bucket] * value, minlength=n_rows)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def gradient(y, bias, w, row, at, value):
    """Gradient of the mean log-likelihood of soft targets ``y`` (less the ridge) by the weights and the bias."""
    z = bias + np.bincount(row, weights=w[at] * value, minlength=len(y))
    g = (y - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) / len(y)
    return np.bincount(at, weights=g[row] * value, minlength=len(w)) - L2 * w, g.sum()


def train(y: np.ndarray, row: np.ndarray, bucket: np.ndarray, value: np.ndarray) -> tuple[float, np.ndarray]:
    """(bias, weights) of the linear scorer on soft targets, by full-batch Adam steps."""
    weights = np.zeros(BUCKETS, np.float32)
    if not len(y):
        return 0.0, weights
    known, at = np.unique(bucket, return_inverse=True)
    w, bias = np.zeros(len(known)), float(np.log((y.mean() + 0.01) / (1.01 - y.mean())))
    m, v = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    for step in range(1, EPOCHS + 1):
        grad = np.append(*gradient(y, bias, w, row, at, value))
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
        w += move[:-1]
        bias += move[-1]
    weights[known] = w
    return bias, weights


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per input row: (id, score, posterior, n_votes, kept)."""
    spark = docs.sparkSession
    counts = {r["pattern"]: r["n"] for r in
              label(docs, id_col, text_col).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}   # at most 3^9 rows
    model = LabelModel(counts)
    src = _source(docs, id_col, text_col)
    texts = src.withColumn("h", F.xxhash64("t")).filter("id is not null")
    some = F.broadcast(pick(texts.select("id", "h").distinct(), "id", train_rows, "h"))

    def emit(batches):
        base = 3 ** np.arange(len(LABELLERS))
        for b in batches:
            for i, j, w in _sliced(b, 1):
                row, bucket, value, seen = features(*w)
                order = np.argsort(row, kind="stable")
                at = np.searchsorted(row[order], np.arange(j - i + 1))
                bucket, value = bucket[order].astype(np.int32), value[order].astype(np.float32)
                packed = [[pa.array([x[at[r]:at[r + 1]].tobytes() for r in range(j - i)], pa.binary())] for x in (bucket, value)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(votes(seen) @ base), *[p[0] for p in packed]],
                                                 names=["id", "h", "pattern", "f", "v"])
    got = (texts.join(some, ["id", "h"], "left_semi").select("id", "t", "h").mapInArrow(tv.lean(emit), "id long, h long, pattern long, f binary, v binary")
           .dropDuplicates(["id", "h"]).toArrow().sort_by([("id", "ascending"), ("h", "ascending")]))
    target = model.posterior(got.column("pattern").to_numpy()) if got.num_rows else np.zeros(0)
    f, size = tv.utf8(got.column("f"))
    row = np.repeat(np.arange(got.num_rows), np.diff(size) // 4)
    fitted = train(target, row, f.view(np.int32), tv.utf8(got.column("v"))[0].view(np.float32))
    del got, f, row
    held = spark.sparkContext.broadcast((model, *fitted))

    def score(batches):
        base = 3 ** np.arange(len(LABELLERS))
        model, bias, weights = held.value
        for b in batches:
            for i, j, w in _sliced(b, 1):
                row, bucket, value, seen = features(*w)
                v = votes(seen)
                s = _scores(weights, bias, row, bucket, value, j - i)
                s[np.diff(w[-1]) == 0] = EMPTY_SCORE
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(s), pa.array(model.posterior(v @ base)),
                     pa.array((v != 1).sum(axis=1)), pa.array(s >= KEEP_AT)],
                    names=["id", "score", "posterior", "n_votes", "kept"])
    return src.mapInArrow(tv.lean(score), "id long, score double, posterior double, n_votes long, kept boolean")
