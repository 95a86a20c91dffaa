"""Ordered datasets at rest: slices, single rows and gathers read only the files they need.

``write_ordered`` range-partitions and sorts the rows by a unique key, so every
file holds one range of it.  Beside the rows lies the zone map, one row a file:
its name, the position of its first row, its number of rows and its key range.
A row's position is the first position of its file plus its place in the file,
which Parquet knows, so positions are neither stored nor computed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROWS, ZONES = "rows", "zones"
#: Bytes of rows that a file should hold, and the files whose names Spark still writes in order.
FILE_BYTES, MOST_FILES = 128 << 20, 99_999


def _bytes(df: DataFrame) -> int:
    """Bytes of the rows, about: texts by their length, nested values as JSON, others as eight."""
    sizes = [
        F.octet_length(F.col(f"`{c}`")) if t in ("string", "binary") else F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))) if "<" in t else F.lit(8)
        for c, t in df.dtypes
    ]
    total = df.select(sum((F.coalesce(x, F.lit(0)).cast("long") for x in sizes), F.lit(0)).alias("n")).agg(F.sum("n")).first()[0]
    return total or 0


def write_ordered(df: DataFrame, path: str, order_col: str = "row_id", files: int | None = None) -> None:
    """Write ``df`` in ``order_col`` order, with its zone map; ``order_col`` is unique, nulls come first.

    One range shuffle, into ``files`` files, or more where these would hold more than
    ``FILE_BYTES``: no task reads more as the table grows.  The zone map is made from the
    files written (footers and the key column), and its positions are a running sum over
    one row a file.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(n, min(-(-_bytes(df) // FILE_BYTES), MOST_FILES))
    df.repartitionByRange(n, F.col(order_col).asc_nulls_first()).sortWithinPartitions(F.col(order_col).asc_nulls_first()).write.parquet(f"{base}/{ROWS}")
    rows = spark.read.schema(df.schema).parquet(f"{base}/{ROWS}").select(F.col("_metadata.file_name").alias("file"), F.col(order_col).alias("key"))
    zones = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"), F.count_if(F.col("key").isNull()).alias("nulls"))
    # Spark numbers files by their range, so names are in key order
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    zones = zones.withColumn("first", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    zones.coalesce(1).write.parquet(f"{base}/{ZONES}")


def zone_map(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, low, high, nulls, first): the files of an ordered dataset."""
    return spark.read.parquet(f"{path.rstrip('/')}/{ZONES}")


def _files(spark: SparkSession, path: str, zones: DataFrame, schema: StructType | None) -> DataFrame:
    """The rows of the files in ``zones``, with ``row_pos``."""
    base = path.rstrip("/")
    held = zones.select("file", "first").collect()  # one row for each file that is read
    if not held:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(f"{base}/{ROWS}").withColumn("row_pos", F.lit(0).cast("long")).filter("false")
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(*[f"{base}/{ROWS}/{r['file']}" for r in held])
    first = spark.createDataFrame([(r["file"], r["first"]) for r in held], "__file string, __first long")
    placed = rows.withColumns({"__name": F.col("_metadata.file_name"), "__at": F.col("_metadata.row_index")})
    joined = placed.join(F.broadcast(first), F.col("__name") == F.col("__file"))
    return joined.withColumn("row_pos", F.col("__first") + F.col("__at")).drop("__name", "__file", "__first", "__at")


def read_slice(spark: SparkSession, path: str, start: int, stop: int, schema: StructType | None = None) -> DataFrame:
    """O3: rows at positions ``start`` to ``stop - 1``, with ``row_pos``; reads the files that overlap them."""
    zones = zone_map(spark, path).filter((F.col("first") < stop) & (F.col("first") + F.col("n") > start))
    return _files(spark, path, zones, schema).filter((F.col("row_pos") >= start) & (F.col("row_pos") < stop))


def read_row(spark: SparkSession, path: str, i: int, schema: StructType | None = None) -> DataFrame:
    """The row at position ``i``, none past the end; reads one file."""
    return read_slice(spark, path, i, i + 1, schema)


def read_keys(spark: SparkSession, path: str, keys: DataFrame, order_col: str = "row_id", schema: StructType | None = None) -> DataFrame:
    """The rows whose key is in ``keys`` (columns of which stay), with ``row_pos``.

    Only files whose key range holds a wanted key are read; null keys match nothing.
    """
    wanted = keys.select(order_col).filter(F.col(order_col).isNotNull()).distinct()
    zones = zone_map(spark, path)
    hit = zones.join(wanted, (F.col(order_col) >= F.col("low")) & (F.col(order_col) <= F.col("high")), "left_semi")
    return _files(spark, path, hit, schema).join(keys, order_col)
