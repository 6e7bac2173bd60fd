"""Reading and writing the player-per-match table at rest.

The extract is stored as Parquet partitioned by season, so a season range
read (S1) prunes directories and the remaining filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def season_range(df: DataFrame, season: str, first: int, last: int) -> DataFrame:
    """``fetch(season = first:last)`` on a table at rest: inclusive season range."""
    return df.filter(F.col(season).try_cast("int").between(first, last))


def load(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a saved table, with a declared schema when given."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def save(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write a table, replacing what was there (S3)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_seasons(df: DataFrame, path: str, season: str = "season") -> None:
    """Write the seasons that ``df`` holds, each replacing its own folder; other seasons stay.

    Spark's dynamic partition overwrite swaps the folders in when the whole write is committed, so a failed
    refresh leaves the old season.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(season).parquet(path)


def save_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``keys`` as table ``name`` at ``path``, and read it.

    Windows, aggregations and joins on ``keys`` (or more columns) over it need no exchange. ``path`` is a
    folder that all executors share; the catalogue holds only the name. One task writes a bucket.
    """
    (df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def load_seasons(spark: SparkSession, path: str, first: int, last: int,
                 season: str = "season") -> DataFrame:
    """Season-range extract from a table written ``partitionBy(season)``; prunes partitions."""
    return season_range(load(spark, path), season, first, last)
