"""Structured Streaming form of the scoring step.

The original analysis has no streams: it reads finished extracts. When
contest rows arrive as files (one or more complete contests per file), the
same batch operators can run per micro-batch: ``score_arrivals`` reads the
folder with ``readStream`` and, in ``foreachBatch``, awards 3-2-1 votes per
contest and writes them to the sink's partition of that batch. A batch that is
replayed after a failure overwrites its own partition, so each counts once.
The stream's checkpoint folder is its own and must be shared by the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.awards import award_votes


def score_arrivals(spark: SparkSession, source: str, schema: T.StructType, sink: str,
                   contest: str, score: str, tie_keys: list[str], checkpoint: str, k: int = 3, seed: int = 0,
                   keep: list[str] | None = None, trigger_once: bool = True):
    """Start a stream that writes awarded rows of each arriving batch to ``sink/batch_id=<n>``.

    Contests must not span batches (files hold whole contests): a batch doesn't know
    the rows of an earlier one. Returns the ``StreamingQuery``.
    """
    stream = spark.readStream.schema(schema).parquet(source)

    def award_batch(batch: DataFrame, batch_id: int) -> None:
        out = award_votes(batch, contest, score, tie_keys, k=k, seed=seed)
        if keep:
            out = out.select(*keep, "votes")
        out.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(award_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
