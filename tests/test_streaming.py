"""The streaming wrapper gives the same awards as the batch operator."""

import os
import tempfile

from medalcast.operators.awards import award_votes
from medalcast.sources.standin import ROW_KEY, SEED, scored
from medalcast.streaming import score_arrivals

from conftest import SF_SMALL


def test_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="medalcast-stream-")
    src, sink = os.path.join(base, "in"), os.path.join(base, "out")
    rows = scored(spark, SF_SMALL).select(*ROW_KEY, "name", "score")
    # two arrival files, each holding whole contests
    rows.filter("contest_id % 2 = 0").write.parquet(os.path.join(src, "a"))
    rows.filter("contest_id % 2 = 1").write.parquet(os.path.join(src, "b"))
    q = score_arrivals(spark, os.path.join(src, "*"), rows.schema, sink, "contest_id", "score",
                       ROW_KEY, seed=SEED, checkpoint=os.path.join(base, "ckpt"),
                       keep=[*ROW_KEY, "name"])
    q.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(sink).select(*ROW_KEY, "votes").collect()))
    want = award_votes(rows, "contest_id", "score", ROW_KEY, seed=SEED)
    assert got == sorted(map(tuple, want.select(*ROW_KEY, "votes").collect()))
