"""Bounded, repeatable samples of documents for fitting small models on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick(rows: DataFrame, key: str, limit: int, *ties: str) -> DataFrame:
    """The ``limit`` rows first in hash order of ``key`` (then by ``ties``): the same rows on any layout of the table."""
    return rows.orderBy(F.xxhash64(key), F.col(key), *ties).limit(limit)
