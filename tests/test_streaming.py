"""The streaming cleaner gives the same rows as the batch cleaner, and resumes."""

from paracorpus import fixtures as fx
from paracorpus.session import scratch_path
from paracorpus.streaming.clean_stream import clean_pairs, start_clean_stream


def test_stream_equals_batch_and_resumes(spark, sf001):
    pairs = fx.pairs(spark, sf001)
    src, sink, ckpt = scratch_path(spark, "src"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    first = pairs.filter("row_id % 2 = 0")
    second = pairs.filter("row_id % 2 = 1")
    first.write.parquet(src + "/part=0")
    q = start_clean_stream(spark, src + "/*", first.schema, sink, ckpt)
    q.awaitTermination(300)
    second.write.parquet(src + "/part=1")
    q = start_clean_stream(spark, src + "/*", first.schema, sink, ckpt)  # restart: only the new shard
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(sink).select("row_id", "darija_latn", "darija_tokens").collect())
    want = sorted(tuple(r) for r in clean_pairs(pairs).select("row_id", "darija_latn", "darija_tokens").collect())
    assert got == want
