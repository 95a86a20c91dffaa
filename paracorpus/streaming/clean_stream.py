"""Incremental corpus cleaning with Structured Streaming.

The reference has no streaming operator; its row-local cleaning steps
(SURVEY 2.3 and 2.9: blank/code filters, ``<unk>`` repair, transliteration,
token counts) run unchanged on a streaming DataFrame.  This module wires them
to a file-stream source and a Parquet sink with the checkpoint in the shared
folder, so new shards of a corpus are cleaned as they land and a restarted
query resumes exactly where it stopped.  Keep-first dedup needs the whole
history and stays a batch step (``operators.merge``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from paracorpus.functions import text as tx
from paracorpus.functions.translit import transliterate
from paracorpus.operators import encode, filters


def clean_pairs(df: DataFrame, english: str = "english", darija: str = "darija_ar") -> DataFrame:
    """Row-local cleaning usable on batch and streaming frames alike."""
    out = filters.filter_blank_pairs(df, english, darija)
    out = filters.filter_code(out, darija)
    out = out.withColumn(english, tx.clean_unk(F.col(english))).withColumn(darija, tx.clean_unk(F.col(darija)))
    return out.withColumn("darija_latn", transliterate(F.col(darija))).withColumn(
        "darija_tokens", encode.token_count(F.col(darija))
    )


def start_clean_stream(
    spark: SparkSession, source_dir: str, schema: StructType, sink_dir: str, checkpoint_dir: str,
    max_files_per_trigger: int = 64, available_now: bool = True,
) -> StreamingQuery:
    """Clean every Parquet shard that appears in ``source_dir`` into ``sink_dir``.

    ``checkpoint_dir`` must be on storage shared by the cluster (the sink's
    exactly-once bookkeeping lives there).
    """
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)
    writer = (
        clean_pairs(src).writeStream.format("parquet").option("path", sink_dir)
        .option("checkpointLocation", checkpoint_dir).outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
