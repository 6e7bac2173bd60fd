"""Quality rules by weak supervision, in Spark expressions only.

Each rule looks at one aspect of a text and votes good (1), bad (-1) or
abstains (0); most only object, as the absence of one defect says little.
Nobody labels anything: expectation-maximisation over the counts
of vote patterns (at most 3^8, summed by Spark over all documents) estimates
every rule's accuracy and the share of good texts, and a text's posterior
probability of being good, given its votes, is the verdict. Two hard floors
stand beside it: fewer than 50 words, or more than half of the words inside
three-word windows that the text repeats.

Every measure is a scalar expression of one row (split, higher-order functions,
regular expressions), so a document is never exploded into rows and nothing is
shuffled but the pattern counts. Repeated windows are found by sorting the
window hashes of the one text that has any repeat.

Cases: a null or empty text has no words, all counts 0, and fails the floor.
Repeated rows get equal results row by row. Other columns are passed on
untouched and may have any name that doesn't collide with ``FEATURES`` (the
caller chooses a prefix). An empty table gives an empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import Scratch

MIN_WORDS = 50
KEEP_AT = 0.5            # posterior probability of being good
EM_ROUNDS = 40
ACCURACY = (0.55, 0.99)  # bounds that keep every rule's orientation
# --- fixed values: frequent function words of the languages read (en, de, fr, es) ---
FUNCTION_WORDS = ["the", "of", "and", "to", "in", "is", "that", "der", "die", "und", "das", "den", "von", "le", "la",
                  "de", "et", "les", "des", "que", "el", "los", "en", "un", "y", "se"]

BLANK = r"[\x20\x09-\x0D]+"
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_ended", "n_upper", "n_bang", "n_function"]
RULES = ["word_length", "symbols", "duplicate_lines", "repetition", "capitals", "shouting", "prose", "tidy"]


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once (a lambda's variable is never inlined)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice among ``words``."""
    n = F.size(words)

    def from_hashes(h):
        def from_sorted(s):
            hits = F.transform(s, lambda e, j: F.when(
                (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"]), e["i"]))
            at = F.filter(hits, lambda x: x.isNotNull())
            return F.size(F.array_distinct(F.flatten(F.transform(at, lambda x: F.array(x, x + 1, x + 2)))))
        tagged = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(tagged, from_sorted))

    windows = F.transform(F.sequence(F.lit(0), n - 3),
                          lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n < 4, 0).otherwise(let(windows, from_hashes))


def features(text: Column) -> Column:
    """Struct of ``FEATURES`` (all long) of one text."""
    t = F.coalesce(text.cast("string"), F.lit(""))

    def of_words(w):
        return F.struct(
            F.size(w).alias("n_words"),
            F.aggregate(w, F.lit(0), lambda a, x: a + F.char_length(x)).alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
            F.size(F.array_intersect(F.transform(w, F.lower), F.array(*map(F.lit, FUNCTION_WORDS)))).alias("n_function"))

    def of_lines(lines):
        return F.struct(
            F.size(lines).alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
            F.size(F.filter(lines, lambda x: x.rlike(r"[.!?:…»”\"')][\x20\x09\x0D]*$"))).alias("n_ended"))

    w = let(F.filter(F.split(t, BLANK), lambda x: x != ""), of_words)
    ln = let(F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), of_lines)
    return F.struct(
        *[w[c].cast("long").alias(c) for c in ("n_words", "word_chars")],
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        ln["n_dup_lines"].cast("long").alias("n_dup_lines"), w["n_repeat_words"].cast("long").alias("n_repeat_words"),
        ln["n_lines"].cast("long").alias("n_lines"), ln["n_ended"].cast("long").alias("n_ended"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(t, F.lit("!")).cast("long").alias("n_bang"),
        w["n_function"].cast("long").alias("n_function"))


def base_failed(c) -> Column:
    """The hard floors, over ``c(name)`` of each feature."""
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > 50 * c("n_words"))


def votes(c) -> dict[str, Column]:
    """Rule -> vote in {-1, 0, 1}, over ``c(name)`` of each feature; integer comparisons only."""
    n, chars, lines = c("n_words"), c("word_chars"), c("n_lines")

    def vote(bad, good=None):
        v = F.when(bad, -1)
        return (v if good is None else v.when(good, 1)).otherwise(0)
    tidy = (50 * c("n_symbols") <= n) & (50 * c("n_bang") <= n) & (10 * c("n_upper") <= chars) & (n > 0)
    return {
        "word_length": vote((chars < 2 * n) | (chars > 13 * n) | (n == 0)),
        "symbols": vote(5 * c("n_symbols") > n),
        "duplicate_lines": vote(10 * c("n_dup_lines") > 4 * lines),
        "repetition": vote(10 * c("n_repeat_words") > 3 * n),
        "capitals": vote(10 * c("n_upper") > 3 * chars),
        "shouting": vote(10 * c("n_bang") > n),
        "prose": vote(c("n_function") == 0, (c("n_function") >= 3) & (2 * c("n_ended") >= lines)),
        "tidy": vote(F.lit(False), tidy),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = EM_ROUNDS) -> tuple[float, list[float]]:
    """(share of good texts, accuracy of each rule) by EM over (votes, count) patterns.

    Votes are independent given the class; a rule's accuracy is the chance that
    its vote, when it casts one, names the class. Starts at 0.8 for every rule.
    Without any pattern the start values come back.
    """
    k = len(RULES)
    good, acc = 0.8, [0.8] * k
    total = sum(n for _, n in patterns)
    if not total:
        return good, acc
    patterns = sorted(patterns)
    for _ in range(rounds):
        mass, right, cast = 0.0, [0.0] * k, [0] * k
        for v, n in patterns:
            p = posterior(v, good, acc)
            mass += n * p
            for j in range(k):
                if v[j]:
                    cast[j] += n
                    right[j] += n * (p if v[j] > 0 else 1.0 - p)
        good = min(0.99, max(0.5, mass / total))
        # two imagined votes at the starting accuracy keep rules that hardly vote defined
        acc = [min(ACCURACY[1], max(ACCURACY[0], (right[j] + 1.6) / (cast[j] + 2.0))) for j in range(k)]
    return good, acc


def posterior(v, good: float, acc: list[float]) -> float:
    z = math.log(good / (1 - good)) + sum(x * math.log(a / (1 - a)) for x, a in zip(v, acc, strict=True) if x)
    return 1.0 / (1.0 + math.exp(-z))


def with_features(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with every feature as a column ``prefix + name``."""
    out = docs.withColumn(f"{prefix}f", features(F.col(f"`{text_col}`")))
    return out.withColumns({prefix + c: F.col(f"{prefix}f")[c] for c in FEATURES}).drop(f"{prefix}f")


def judge(measured: DataFrame, prefix: str = "") -> DataFrame:
    """Adds ``base_failed``, ``quality`` (posterior) and ``kept`` (all with the prefix) to measured rows.

    ``measured`` is read twice (pattern counts, then verdicts), so give a written table.
    """
    def c(name):
        return F.col(prefix + name)
    v = votes(c)
    counted = measured.groupBy(*[v[r].alias(r) for r in RULES]).agg(F.count(F.lit(1)).alias("n"))
    good, acc = fit([(tuple(r[x] for x in RULES), r["n"]) for r in counted.collect()])   # at most 3^8 rows
    z = F.lit(math.log(good / (1 - good)))
    for r, a in zip(RULES, acc, strict=True):
        z = z + v[r] * F.lit(math.log(a / (1 - a)))
    p = 1.0 / (1.0 + F.exp(-z))
    return (measured.withColumns({prefix + "base_failed": base_failed(c), prefix + "quality": p})
            .withColumn(prefix + "kept", ~F.col(prefix + "base_failed") & (F.col(prefix + "quality") >= KEEP_AT)))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, the features, ``base_failed``, ``quality`` and ``kept``."""
    scratch = Scratch(docs.sparkSession, "quality")
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return judge(scratch.write(with_features(src).drop("text"), "features"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns unchanged."""
    scratch = Scratch(docs.sparkSession, "quality")
    prefix = "__q_"
    rows = scratch.write(with_features(docs, text_col, prefix), "documents", compression="zstd")
    return judge(rows, prefix).filter(F.col(prefix + "kept")).select(*[F.col(f"`{x}`") for x in docs.columns])
