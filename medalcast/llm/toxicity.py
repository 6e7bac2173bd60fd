"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is a logistic
function of its features; the document's is their noisy-or,
``1 - prod(1 - p)``. Only documents carry labels, so the sentence weights are
fitted through the noisy-or (full-batch Adam on the driver).

Features are 64-bit hashes of words and of their first 4, 5 and 6 bytes (stems
of inflected insults). Fitting takes at most ``TRAIN_ROWS`` labelled documents,
first in hash order of the id; Spark counts in how many of them, and of the
toxic ones, each feature occurs; all that lean to toxic by ``Z`` standard errors
or more enter the fit, and an L1 penalty leaves those with a weight as the
model's vocabulary. Only these features' places reach the driver: their number
follows the bounded sample, not the corpus. Scoring runs in the tasks over every whole
text with vocabulary and weights broadcast, and gives the sentences that offend.

Inputs of a score are the text's words alone (A-Z folded runs of letters,
digits and non-ASCII characters), never labels, ids, language or source.

Cases: null, empty or wordless texts have no sentence and score 0. Labels that
are null are ignored; several labels of one id count as the highest. Without
any positive label every score is that of a model without features. Repeated
rows get equal scores; extra columns are ignored; an empty table gives an
empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .sample import pick
from .stage import Scratch
from .textvec import U, mix

TRAIN_ROWS = 10_000      # labelled documents fitted on, at most
Z = 3.0
STEMS = (4, 5, 6)
EPOCHS = 200
RATE = 0.08
L1 = 1e-5                # of the mean log-likelihood; weights whose pull stays below it are 0
L2 = 1e-4
START = -6.0             # bias of a sentence without any feature
LONGEST = 40             # words of a sentence; longer ones are cut
OFFENDS = 0.3            # sentence probability from which it is reported
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True
_FOLD = np.arange(256, dtype=U)
_FOLD[65:91] += U(32)


def sentences(buf: np.ndarray, off: np.ndarray):
    """([words, 1 + stems] features, first word of each sentence, row of each sentence, byte span of each sentence).

    A feature of 0 stands for none (a word no longer than the stem).
    """
    starts, ends, h, first = tv.words(buf, off, tv.ALNUM)
    n = len(starts)
    if not n:
        z = np.zeros(0, np.int64)
        return np.zeros((0, 1 + len(STEMS)), U), z, z, z, z
    stops = np.concatenate([[0], np.cumsum(_STOP[buf])])
    new = np.ones(n, bool)
    new[1:] = stops[starts[1:]] != stops[ends[:-1]]
    new[first[:-1][np.diff(first) > 0]] = True
    head = np.flatnonzero(new)
    place = np.arange(n) - np.repeat(head, np.diff(np.append(head, n)))
    head = np.flatnonzero(place % LONGEST == 0)
    row = tv.row_ids(first)[head]
    feats = np.zeros((n, 1 + len(STEMS)), U)
    feats[:, 0] = h
    size, packed = ends - starts, np.zeros(n, U)
    for j in range(max(STEMS)):
        packed |= _FOLD[buf[np.minimum(starts + j, len(buf) - 1)]] << U(8 * j)
        if j + 1 in STEMS:
            feats[:, 1 + STEMS.index(j + 1)] = np.where(size > j + 1, mix(packed ^ U((j + 1) << 56)), U(0))
    return feats, head, row, starts[head], ends[np.append(head[1:], n) - 1]


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit(bags: list[tuple[int, int, bytes, bytes]], n_features: int) -> tuple[float, np.ndarray]:
    """(bias, weight of each feature) from (label, sentences, feature places, their sentences) of each document."""
    w, bias = np.zeros(n_features), START
    bags = [x for x in bags if x[1]]
    if not n_features or not any(x[0] for x in bags):
        return bias, w
    y = np.array([x[0] for x in bags], float)
    count = np.array([x[1] for x in bags], float)
    at = np.concatenate([np.frombuffer(x[2], np.int32) for x in bags]).astype(np.int64)
    key = np.concatenate([np.frombuffer(x[3], np.int32).astype(np.int64) + (i << 32) for i, x in enumerate(bags)])
    held, sent = np.unique(key, return_inverse=True)         # sentences with a feature
    doc = held >> 32
    bare = count - np.bincount(doc, minlength=len(bags))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, EPOCHS + 1):
        p = _sigmoid(bias + np.bincount(sent, weights=w[at], minlength=len(held)))
        p0 = float(_sigmoid(bias))
        log_clean = bare * np.log1p(-p0) + np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(bags))
        clean = np.exp(log_clean)
        pull = np.where(y > 0, clean / np.maximum(1 - clean, 1e-9), -1.0)    # d log-likelihood / d z is pull * p
        g = np.minimum(pull[doc] * p, 1.0)
        g_bias = g.sum() + (np.minimum(pull * p0, 1.0) * bare).sum()
        grad = np.append(np.bincount(at, weights=g[sent], minlength=n_features), g_bias) / len(bags)
        grad[:-1] -= L2 * w
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w += move[:-1]
        shrink = RATE * L1 / (np.sqrt(v[:-1] / (1 - 0.99 ** step)) + 1e-8)       # proximal step in Adam's metric
        w = np.sign(w) * np.maximum(np.abs(w) - shrink, 0)
        bias = min(bias + 0.2 * move[-1], -3.0)
    return float(bias), w


def _find(feats: np.ndarray, vocabulary: np.ndarray):
    """(word, place in the sorted vocabulary) of every feature that is in it."""
    if not len(vocabulary) or not len(feats):
        z = np.zeros(0, np.int64)
        return z, z
    word, col = np.nonzero(_marks(vocabulary)[(feats & U(0xFFFFF)).astype(np.int64)])
    x = feats[word, col]
    at = np.minimum(np.searchsorted(vocabulary, x), len(vocabulary) - 1)
    ok = vocabulary[at] == x
    return word[ok], at[ok]


_MARKS: list = [None, None]


def _marks(vocabulary: np.ndarray) -> np.ndarray:
    """Which low 20 bits any feature of the vocabulary has; kept for the latest vocabulary."""
    if _MARKS[0] is not vocabulary:
        table = np.zeros(1 << 20, bool)
        table[(vocabulary & U(0xFFFFF)).astype(np.int64)] = True
        _MARKS[:] = vocabulary, table
    return _MARKS[1]


def _sample(docs, labels, id_col, text_col, label_col, limit) -> DataFrame:
    """(id, t, y) of at most ``limit`` labelled documents."""
    known = (labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
             .filter("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y")))
    some = F.broadcast(pick(known, "id", limit))                       # at most ``limit`` small rows
    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))
            .join(some, "id").select("id", "t", "y").dropDuplicates(["id"]))


def _leaning(sample: DataFrame) -> np.ndarray:
    """Sorted hashes of the features that lean to toxic documents."""
    def run(batches):
        for b in batches:
            buf, off = tv.utf8(b.column(1))
            y = b.column(2).to_numpy()
            for i, j in tv.slices(off):
                feats, head, row, _, _ = sentences(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                of = np.repeat(row, np.diff(np.append(head, len(feats))))
                r, x = tv.distinct_per_row(np.repeat(of, feats.shape[1]), feats.ravel())
                for k in range(0, len(r), 200_000):
                    z = slice(k, k + 200_000)
                    yield pa.RecordBatch.from_arrays([pa.array(tv.as_long(x[z])), pa.array(y[i:j][r[z]])], names=["x", "y"])
    n, k = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not k:
        return np.zeros(0, U)
    share = k / n
    per = (sample.mapInArrow(tv.lean(run), "x long, y int").filter("x <> 0").groupBy("x")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("k")))
    z = (F.col("k") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1)
    lean = per.filter(z >= Z).select("x").collect()                          # of a sample of bounded rows
    return np.sort(np.array([r["x"] for r in lean], np.int64).view(U))


def _bags(sample: DataFrame, vocabulary: np.ndarray) -> list:
    """(label, sentences, feature places, their sentences) of every document of the sample."""
    def run(batches):
        for b in batches:
            buf, off = tv.utf8(b.column(1))
            for i, j in tv.slices(off):
                feats, head, row, _, _ = sentences(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                word, at = _find(feats, vocabulary)
                sent = np.searchsorted(head, word, side="right") - 1
                first = np.searchsorted(row, np.arange(j - i + 1))       # first sentence of each row
                cut = np.searchsorted(sent, first)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(np.diff(first)),
                     pa.array([at[cut[r]:cut[r + 1]].astype(np.int32).tobytes() for r in range(j - i)], pa.binary()),
                     pa.array([(sent[cut[r]:cut[r + 1]] - first[r]).astype(np.int32).tobytes() for r in range(j - i)], pa.binary())],
                    names=["id", "y", "n", "at", "sent"])
    got = sample.mapInArrow(tv.lean(run), "id long, y int, n long, at binary, sent binary").collect()
    return [(r["y"], r["n"], bytes(r["at"]), bytes(r["sent"])) for r in sorted(got, key=lambda r: r["id"])]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          limit: int = TRAIN_ROWS):
    """(vocabulary, bias, weights) fitted on at most ``limit`` labelled documents."""
    sample = Scratch(docs.sparkSession, "toxicity").write(_sample(docs, labels, id_col, text_col, label_col, limit), "sample", compression="zstd")
    leaning = _leaning(sample)
    bias, weights = fit(_bags(sample, leaning), len(leaning))
    held = weights != 0
    return leaning[held], bias, weights[held]


def score_documents(docs: DataFrame, model: tuple[np.ndarray, float, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, score, n_sentences, offending): flat byte spans of sentences from ``OFFENDS`` on,
    worst first."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))

    def run(batches):
        vocabulary, bias, weights = held.value
        for b in batches:
            buf, off = tv.utf8(b.column(1))
            for i, j in tv.slices(off):
                feats, head, row, lo, hi = sentences(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                n = j - i
                word, at = _find(feats, vocabulary)
                sent = np.searchsorted(head, word, side="right") - 1
                p = _sigmoid(bias + np.bincount(sent, weights=weights[at], minlength=len(head)))
                log_clean = np.bincount(row, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)
                bad = np.flatnonzero(p >= OFFENDS)
                bad = bad[np.lexsort((bad, -p[bad], row[bad]))]
                at = np.searchsorted(row[bad], np.arange(n + 1))
                base = off[i:j] - off[i]
                spans = np.stack([lo[bad] - base[row[bad]], hi[bad] - base[row[bad]]], axis=1).ravel()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), pa.array(-np.expm1(log_clean)), pa.array(np.bincount(row, minlength=n)),
                     pa.ListArray.from_arrays(pa.array((2 * at).astype(np.int32)), pa.array(spans.astype(np.int64)))],
                    names=["id", "score", "n_sentences", "offending"])
    return src.mapInArrow(tv.lean(run), "id long, score double, n_sentences long, offending array<long>")


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2):
    """Whether an id falls in the fold kept from training: crc32 of its text modulo ``folds``."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds == fold, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Fit on the labelled rows outside the held-out fold and score every document."""
    model = train(docs, labels.filter(~held_out(id_col)), id_col, text_col, label_col, train_rows)
    return score_documents(docs, model, id_col, text_col)
