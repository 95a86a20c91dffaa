"""Datasets whose writes are published whole.

A write puts its rows into a folder of its own and then publishes a commit: one
small file that lists the folder of every partition, put in place by one rename.
Readers take the last commit and read the folders it lists, so a write that dies
half-way leaves the former rows, and readers of an older commit keep theirs.
Commits are numbered; a rename onto a number that is taken fails, so of two
writers at once one has to begin again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS, DATA = "_commits", "data"


class CommitConflict(RuntimeError):
    """Another writer has published a commit in between."""


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    place, fs = _folder(spark, f"{path.rstrip('/')}/{COMMITS}")
    names = [x.getPath().getName() for x in fs.listStatus(place)] if fs.exists(place) else []
    return sorted(int(x.removesuffix(".json")) for x in names if x.endswith(".json"))


def last_commit(spark: SparkSession, path: str, number: int | None = None) -> dict | None:
    """The commit ``number``, by default the last one; None before the first."""
    known = _numbers(spark, path)
    if not known or (number is not None and number not in known):
        return None
    number = known[-1] if number is None else number
    text = "".join(r["value"] for r in spark.read.text(f"{path.rstrip('/')}/{COMMITS}/{number:012d}.json").collect())
    return json.loads(text) | {"number": number}


def _publish(spark: SparkSession, path: str, number: int, commit: dict) -> None:
    base = f"{path.rstrip('/')}/{COMMITS}"
    draft, fs = _folder(spark, f"{base}/.{uuid.uuid4().hex}.tmp")
    final, _ = _folder(spark, f"{base}/{number:012d}.json")
    fs.mkdirs(draft.getParent())
    out = fs.create(draft)
    try:
        out.write(bytearray(json.dumps(commit, default=str).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise CommitConflict(f"commit {number} of {path} is taken")


def write_commit(df: DataFrame, path: str, by: Sequence[str], message: str = "", tokens_col: str | None = None) -> dict:
    """Replace the partitions of ``df`` (values of the ``by`` columns), keep the others, and return the commit.

    Rows and tokens are observed while they are written.  The partitions found in
    the write are listed by one narrow scan of the new folder.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    before = last_commit(spark, path)
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *([F.sum(tokens_col).alias("tokens")] if tokens_col else [])]
    folder = f"{DATA}/{uuid.uuid4().hex}"
    df.observe(seen, *counts).write.partitionBy(*by).parquet(f"{base}/{folder}")
    found = spark.read.parquet(f"{base}/{folder}").select(*[F.col(c).cast("string").alias(c) for c in by]).distinct() if seen.get["rows"] else None
    parts = dict((before or {}).get("partitions", {}))
    for r in found.collect() if found is not None else []:  # one row for each partition written
        parts[json.dumps(list(r))] = folder
    commit = {"message": message, "by": list(by), "schema": df.schema.json(), "partitions": parts, **seen.get}
    number = before["number"] + 1 if before else 0
    _publish(spark, path, number, commit)
    return commit | {"number": number}


def read_commit(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of the last commit (or of ``number``): of every partition those of the folder it is listed with."""
    commit = last_commit(spark, path, number)
    if commit is None:
        raise FileNotFoundError(f"no commit in {path}")
    schema = StructType.fromJson(json.loads(commit["schema"]))
    by_folder: dict[str, list[list[str | None]]] = {}
    for values, folder in commit["partitions"].items():
        by_folder.setdefault(folder, []).append(json.loads(values))
    out = None
    for folder, values in sorted(by_folder.items()):
        rows = spark.read.schema(schema).option("basePath", f"{path.rstrip('/')}/{folder}").parquet(f"{path.rstrip('/')}/{folder}")
        listed = F.lit(False)
        for v in values:
            same = F.lit(True)
            for c, x in zip(commit["by"], v, strict=True):
                same = same & F.col(c).cast("string").eqNullSafe(F.lit(x))
            listed = listed | same
        rows = rows.filter(listed)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out if out is not None else spark.createDataFrame([], schema)
