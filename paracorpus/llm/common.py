"""Helpers shared by the operators of this subpackage.

Intermediates are written tables below the folder named in
``spark.checkpoint.dir`` (see ``paracorpus.session``): they cut lineage, every
executor can read them, and a lost executor costs only its running tasks.
"""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paracorpus.session import drop_written, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
#: What an operator's tasks keep in a Python worker for the next task.
WORKER_CACHES: dict[str, object] = {}


def spill(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return a scan of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_spill(df: DataFrame) -> None:
    """Delete the table behind a scan that :func:`spill` returned."""
    drop_written(df)


def fresh_worker() -> None:
    """Free what tasks of other operators keep in this Python worker, as Spark uses it again."""
    if WORKER_CACHES:
        WORKER_CACHES.clear()
        gc.collect()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of runs of characters other than the six ASCII blanks (null text: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_positions(df: DataFrame, order: Sequence[str], pos: str = "pos", name: str = "positions") -> DataFrame:
    """Add the dense 0-based position of every row in the total order ``order``.

    One range shuffle: rows are range-partitioned and sorted by ``order``, each
    row keeps its partition number and its index inside the partition, and the
    result is written once, so later reads see one fixed layout.  The row counts
    per partition (as many numbers as there are shuffle partitions) are the only
    thing the driver reads.  A hot leading key spreads over many partitions as
    long as later order columns tell its rows apart; fully equal rows are
    interchangeable.  ``df`` should hold narrow columns only.
    """
    parts = shuffle_partitions(df.sparkSession)
    mid, part = "__mid", "__part"
    staged = spill(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn(mid, F.monotonically_increasing_id()),
        name,
    ).withColumn(part, F.shiftright(mid, 33).cast("int"))
    counts = {r[part]: r["count"] for r in staged.groupBy(part).count().collect()}
    starts, total = [], 0
    for p in range(max(counts, default=0) + 1):
        starts.append(total)
        total += counts.get(p, 0)
    offset = F.element_at(F.lit(starts).cast("array<bigint>"), F.col(part) + 1)
    return staged.withColumn(pos, offset + F.col(mid).bitwiseAND(F.lit((1 << 33) - 1))).drop(mid, part)
