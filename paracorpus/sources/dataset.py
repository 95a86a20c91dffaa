"""Split/config datasets at rest.

A dataset is one Parquet folder partitioned by ``split`` (and optionally
``config``), next to a ``_notes`` folder of one-row JSON commit notes.
Reads name the partition so Spark prunes the others; writes use dynamic
partition overwrite so a rerun replaces only the partitions it produces.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paracorpus.operators.merge import split_dict
from paracorpus.session import path_exists


def write_dataset(
    data: DataFrame | Mapping[str, DataFrame],
    path: str,
    message: str | None = None,
    partition_cols: tuple[str, ...] = ("split",),
    tokens_col: str | None = None,
) -> dict:
    """Write splits (dict or frame with the partition columns) + a commit note.

    Only the partitions in ``data`` are replaced (a writer option; the session
    is left as it is).  The note (message, rows, token sum) is observed while
    the rows are written, so it counts this write and costs no second scan.
    """
    df = split_dict(data) if isinstance(data, Mapping) else data
    spark = df.sparkSession
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    if tokens_col:
        counts.append(F.sum(tokens_col).alias("tokens"))
    observed = df.observe(seen, *counts)
    observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path)
    note = {"message": message or "", **seen.get}
    spark.createDataFrame([(json.dumps(note, default=str),)], "note string").coalesce(1).write.mode("append").text(
        path.rstrip("/") + "_notes"
    )
    return note


def read_split(spark: SparkSession, path: str, split: str, schema: StructType | None = None) -> DataFrame:
    """``load_dataset(path, split=...)``: partition-pruned scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).filter(F.col("split") == F.lit(split)).drop("split")


def read_all_splits(spark: SparkSession, path: str) -> DataFrame:
    """Every split, with its ``split`` column."""
    return spark.read.parquet(path)


def read_config(spark: SparkSession, path: str, config: str, split: str | None = None) -> DataFrame:
    """S3: ``load_dataset(path, name=config)``."""
    df = spark.read.parquet(path).filter(F.col("config") == F.lit(config))
    if split is not None:
        df = df.filter(F.col("split") == F.lit(split))
    return df.drop("config")


def finished_keys(spark: SparkSession, path: str, keys: list[str]) -> DataFrame | None:
    """Keys already in a progressive sink; None when nothing was written yet.

    Only a missing folder counts as nothing written; any other failure is raised.
    """
    return spark.read.parquet(path).select(*keys).distinct() if path_exists(spark, path) else None
