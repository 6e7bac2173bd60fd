"""Spark session settings and lineage helpers.

The operators never build a session themselves; they take DataFrames. These
helpers give tests, the bench and the entry module one consistent set of
settings (AQE on, skew-join splitting on, UTC timestamps, UI off).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale as much as locally. Shuffle partition count is
# left to the caller (cluster: thousands with AQE coalescing; local: cores).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "medalcast", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**BASE_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                 # local runs: a moderate heap with the throughput collector; fresh heap
                 # pages are slow to fault in on small VMs, so a huge heap costs time
                 "spark.driver.memory": os.environ.get("MEDALCAST_DRIVER_MEM", "8g"),
                 "spark.driver.extraJavaOptions": "-XX:+UseParallelGC",
                 **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment names it (a shared, fault-tolerant path);
    without it this raises, as a folder on one machine would be read back in
    part. Only a local master gets a scratch folder of its own, once a session.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="medalcast-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared checkpoint folder and read it back.

    Used between heavy stages (e.g. simulation batches) so that a lost
    executor re-reads a written table instead of recomputing the whole plan.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, (name or "stage") + "-" + uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
