"""Registered queries (name -> callable) and their DuckDB oracles."""

from . import q_awards, q_calibrate, q_features, q_model, q_season  # noqa: F401  (register queries on import)
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
