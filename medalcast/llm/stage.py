"""Written tables between stages, in the shared folder the cluster names.

``spark.checkpoint.dir`` is read from the session (see ``medalcast.session``).
A stage that several later stages read is written once as Parquet, so a lost
executor costs a re-read, not the whole plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


class Scratch:
    """Named Parquet tables under one fresh folder; ``drop`` removes a table no later stage reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def write(self, df: DataFrame, name: str = "t", compression: str = "snappy") -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n:03d}-{name}"
        df.write.option("compression", compression).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table made by ``write`` (through Hadoop's file system, as the path may be remote)."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
