"""Column-set helpers.

The reference addresses columns by position, name range and prefix; these
helpers turn those into explicit name lists taken from ``df.columns`` or
``df.schema`` so that the projection Catalyst sees is a plain ``select``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def unique_names(names: Iterable[str]) -> list[str]:
    """Order-preserving de-duplication."""
    return list(dict.fromkeys(names))


def select_unique(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``select(id, all_of(vars), y)`` where ``vars`` may repeat."""
    return df.select(*unique_names(names))


def positional_block(df: DataFrame, first: int, last: int) -> list[str]:
    """``names(.)[first:last]`` with R's 1-based inclusive positions."""
    return df.columns[first - 1:last]


def name_range(df: DataFrame, first: str, last: str) -> list[str]:
    """``select(first:last)``."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    return cols[i:j + 1]


def with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Columns whose name starts with ``prefix``."""
    return [c for c in df.columns if c.startswith(prefix)]


def bulk_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename several columns at once."""
    return df.withColumnsRenamed(dict(mapping))


def prefix_rename(df: DataFrame, cols: Iterable[str], prefix: str) -> DataFrame:
    """``setNames(paste0(prefix, names))`` on the given columns."""
    return df.withColumnsRenamed({c: prefix + c for c in cols})


def nominal_columns(df: DataFrame) -> list[str]:
    """``all_nominal()``: string-typed columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
