"""Named queries and their DuckDB oracle SQL.

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the given
tables; its oracle (when SQL can express it) sits next to it so that the two
are read and changed together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def u_sql(*exprs: str) -> str:
    """DuckDB form of ``functions.expr.row_uniform``."""
    k = ", ".join(f"cast({e} as varchar)" for e in exprs)
    return (f"((('0x' || substr(md5(concat_ws('|', {k})), 1, 8))::bigint + 0.5e0)"
            f" / 4294967296e0)")


def horner_sql(x: str, coefs) -> str:
    acc = d(coefs[-1])
    for c in reversed(coefs[:-1]):
        acc = f"({acc} * {x} + {d(c)})"
    return acc


def d(v: float) -> str:
    """A double literal for DuckDB."""
    return f"CAST({float(v)!r} AS DOUBLE)"


# DuckDB forms of functions.expr.hash32 and operators.sampling.stream_uniforms
_C1, _C2, _STEP, _M32 = 0x85EBCA6B, 0xC2B2AE35, 0x9E3779B9, 4294967295


def hash32_sql(*exprs: str, word: int = 0) -> str:
    k = ", ".join(f"cast({e} as varchar)" for e in exprs)
    return f"('0x' || substr(md5(concat_ws('|', {k})), {1 + 8 * word}, 8))::bigint"


def _mul32_sql(h: str, m: int) -> str:
    return f"(((({h} & 65535) * {m}) + (((({h} >> 16) * {m}) & 65535) << 16)) & {_M32})"


def _mixed_sql(rows: str, h: str) -> str:
    """``rows`` (a select) with its column ``h`` mixed; a step a level, so that no text is repeated."""
    for step in (f"xor({h}, ({h} >> 16))", _mul32_sql(h, _C1), f"xor({h}, ({h} >> 13))", _mul32_sql(h, _C2),
                 f"xor({h}, ({h} >> 16))"):
        rows = f"select * replace ({step} as {h}) from ({rows})"
    return rows


def races_sql(weights: str, sims: int) -> str:
    """(contest columns, weight, sim, key_) of every race over weights with state words a_, b_."""
    x = _mixed_sql(f"""select w.*, s.sim, ((w.a_ + s.sim * {_STEP}) & {_M32}) as x_ from {weights} w
        cross join (select range::bigint as sim from range(1, {sims + 1})) s""", "x_")
    y = _mixed_sql(f"select *, xor(x_, b_) as y_ from ({x})", "y_")
    z = _mixed_sql(f"select *, ((x_ + y_) & {_M32}) as z_ from ({y})", "z_")
    return f"select *, -ln((y_ * 1048576 + (z_ >> 12) + 0.5e0) / 4503599627370496e0) / weight as key_ from ({z})"
