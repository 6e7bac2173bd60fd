"""Scalar column expressions.

Every helper returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

_TWO_32 = 4294967296.0


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """``num / den`` as double; NULL when ``den`` is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def half_even(x: ColumnLike, digits: int = 0) -> Column:
    """R's ``round`` (IEEE half-to-even)."""
    return F.bround(col(x), digits)


def key_text(*cols: ColumnLike) -> Column:
    """Stable text key of several columns, ``|``-separated."""
    return F.concat_ws("|", *[col(c).cast("string") for c in cols])


def row_uniform(*cols: ColumnLike) -> Column:
    """Uniform (0,1) number keyed on the given columns.

    Unlike ``rand(seed)``, the value depends only on the row's key, so it is
    the same under retries, re-partitioning and lost executors. Built from the
    first 32 bits of an MD5 digest so that other engines can reproduce it.
    """
    digest32 = F.conv(F.substring(F.md5(key_text(*cols)), 1, 8), 16, 10).cast("bigint")
    return (digest32.cast("double") + F.lit(0.5)) / F.lit(_TWO_32)


# --- fixed values: 32-bit mixing constants (MurmurHash3 finaliser, golden-ratio step) ---
MIX_C1 = 0x85EBCA6B
MIX_C2 = 0xC2B2AE35
MIX_STEP = 0x9E3779B9


def hash32(*cols: ColumnLike, word: int = 0) -> Column:
    """32 bits (the first word, or the next ones) of the MD5 of the key text, as a non-negative bigint."""
    return F.conv(F.substring(F.md5(key_text(*cols)), 1 + 8 * word, 8), 16, 10).cast("bigint")


def right_closed_bin(x: ColumnLike, start: float, stop: float, step: float) -> Column:
    """Ordinal of ``x`` in ``cut(x, c(-Inf, seq(start, stop, step), Inf))``.

    Intervals are right-closed ``(a, b]``; the result is the number of breaks
    strictly below ``x`` (0 = ``(-Inf, start]``, n+1 = ``(stop, Inf)``).
    Breaks are ``start + i*step`` exactly as ``seq`` computes them. A first
    guess from arithmetic is corrected against the exact neighbouring breaks,
    so no array is built per row.
    """
    x = col(x)
    n = int(round((stop - start) / step))  # index of the last break

    def brk(i: Column) -> Column:
        return F.lit(float(start)) + i.cast("double") * F.lit(float(step))

    guess = F.least(F.greatest(F.ceil((x - F.lit(float(start))) / F.lit(float(step))),
                               F.lit(0)), F.lit(n + 1)).cast("int")
    up = F.when((guess <= n) & (brk(guess) < x), guess + 1).otherwise(guess)
    down = F.when((up >= 1) & (brk(up - 1) >= x), up - 1).otherwise(up)
    return F.when(x.isNull() | F.isnan(x), F.lit(None).cast("int")).otherwise(down)


def horner(x: ColumnLike, coefs: Sequence[float]) -> Column:
    """Polynomial ``c0 + c1 x + ... + cd x^d`` evaluated by Horner's rule."""
    x = col(x)
    acc = F.lit(float(coefs[-1]))
    for c in reversed(coefs[:-1]):
        acc = acc * x + F.lit(float(c))
    return acc


def clamp_curve(x: ColumnLike, coefs: Sequence[float], hi: float, hi_val: float,
                lo: float = -0.05, lo_val: float = 0.0) -> Column:
    """Polynomial probability with tail clamps (M15): ``x > hi -> hi_val``,
    ``x < lo -> lo_val``, else the polynomial; NULL where ``x`` is NULL or NaN."""
    x = no_nan(x)
    return (F.when(x > F.lit(hi), F.lit(hi_val))
            .when(x < F.lit(lo), F.lit(lo_val))
            .otherwise(horner(x, coefs)))


def no_nan(x: ColumnLike) -> Column:
    """A score, with NaN as NULL: Spark orders NaN above every number, so it would win and clamp high."""
    x = col(x).cast("double")
    return F.when(~F.isnan(x), x)


def copies_weight(p: ColumnLike, scale: int = 100) -> Column:
    """Integer copy count ``round(scale * p)`` used for weighted draws.

    Missing or negative probabilities give 0 copies.
    """
    return half_even(F.lit(scale) * F.greatest(F.coalesce(col(p), F.lit(0.0)), F.lit(0.0)), 0) \
        .cast("bigint")


def percent_text(x: ColumnLike) -> Column:
    """``scales::percent(round(x, 4))`` style text, e.g. ``12.34%``."""
    return F.format_string("%.2f%%", half_even(col(x), 4) * F.lit(100.0))


def starts_with_digit(c: ColumnLike) -> Column:
    """``str_starts(x, "^[0-9]")``."""
    return col(c).rlike("^[0-9]")


def first_int(c: ColumnLike) -> Column:
    """``as.integer(str_extract(x, "\\d+"))``."""
    return F.regexp_extract(col(c), r"(\d+)", 1).try_cast("int")
