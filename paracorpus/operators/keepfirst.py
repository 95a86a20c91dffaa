"""Keep-first dedup one source after the other.

Beside the kept rows lies an index of their keys: 128-bit key hashes in a table
that is bucketed and sorted by the hash.  A new source is made distinct by itself,
its (narrow) keys are checked, and its new rows are appended to rows and index.

* The index is never moved: its buckets are the join's partitions, so only the new
  source's keys are shuffled.
* Most new keys don't reach the join.  A Bloom filter in blocks, a bitmap of
  ``BLOCK_BITS`` bits for about ``BLOCK_KEYS`` keys, tells of nearly all of them that
  the index lacks them; it is made of native bitmap functions and grows by one
  bitmap a block for each source.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paracorpus.operators.merge import dedup_keep_first, key_hash
from paracorpus.session import path_exists, written

#: Bits of a bitmap (as many as Spark's bitmap functions take), keys meant for one, and bits set for a key.
BLOCK_BITS, BLOCK_KEYS, PROBES = 32768, 3000, 4


@dataclass(frozen=True)
class KeepFirst:
    """A growing deduplicated dataset below ``path``; ``keys`` decide what is equal.

    ``buckets`` and ``blocks`` are fixed when the dataset is begun: buckets of the
    index (partitions of every later join; at fewer than the session's shuffle
    partitions Spark would rather move the index), and blocks of the Bloom filter,
    a three-thousandth of the keys expected.  More keys only make it pass more.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 256
    blocks: int = 64

    def rows(self) -> DataFrame:
        """All kept rows, with the source number that brought them."""
        return self.spark.read.parquet(f"{self.path}/rows")

    def _index_table(self) -> str:
        """A name in this session's catalog for the index folder and its buckets."""
        name = f"kept_{uuid.uuid4().hex[:12]}"
        self.spark.sql(
            f"CREATE TABLE {name} (k1 BIGINT, k2 BIGINT) USING parquet CLUSTERED BY (k1, k2) SORTED BY (k1, k2) INTO {self.buckets} BUCKETS LOCATION '{self.path}/index'"
        )
        return name

    def index(self) -> DataFrame:
        """The key hashes (k1, k2), read in their buckets."""
        return self.spark.table(self._index_table())

    def _block(self, k1: Column) -> Column:
        return F.pmod(k1, F.lit(self.blocks)).cast("int")

    def _bits(self, k2: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(k), k2), F.lit(BLOCK_BITS)) for k in range(PROBES)]

    def _bloom_of(self, keys: DataFrame) -> DataFrame:
        bits = keys.select(self._block(F.col("k1")).alias("block"), F.explode(F.array(*self._bits(F.col("k2")))).alias("bit"))
        return bits.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit")).alias("bits"))

    def _may_be_known(self, keys: DataFrame) -> DataFrame:
        """The keys that the Bloom filter does not rule out."""
        blooms = self.spark.read.parquet(f"{self.path}/bloom").groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
        placed = keys.withColumn("block", self._block(F.col("k1"))).join(blooms, "block")
        hit = F.lit(True)
        for bit in self._bits(F.col("k2")):
            byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            hit = hit & (F.getbit(byte, (bit % 8).cast("int")) == 1)
        return placed.filter(hit).select("k1", "k2")

    def new_rows(self, source: DataFrame, order_col: str | Sequence[str] = "row_id") -> DataFrame:
        """The rows of ``source`` that are its first ones of a key and whose key is not kept yet (with k1, k2)."""
        first = dedup_keep_first(source, self.keys, order_col)
        hashed = first.withColumns(dict(zip(("k1", "k2"), key_hash(self.keys), strict=True)))
        if not path_exists(self.spark, f"{self.path}/index"):
            return hashed
        maybe = written(self._may_be_known(hashed.select("k1", "k2")), "maybe_known")
        known = self.index().join(maybe, ["k1", "k2"], "left_semi").withColumnsRenamed({"k1": "__k1", "k2": "__k2"})
        return hashed.join(known, (F.col("k1") == F.col("__k1")) & (F.col("k2") == F.col("__k2")), "left_anti")

    def append(self, source: DataFrame, number: int, order_col: str | Sequence[str] = "row_id") -> None:
        """Keep the new rows of ``source`` as source ``number``.

        Null keys equal each other.  The rows come first; filter and index follow from
        the rows that are there.  So a source that failed half-way is appended again:
        its rows are not written twice, and keys that are twice in the index are harmless.
        """
        kept = f"{self.path}/rows/source_no={number}"
        if not path_exists(self.spark, f"{kept}/_SUCCESS"):
            self.new_rows(source, order_col).drop("k1", "k2").write.mode("overwrite").parquet(kept)
        hashes = dict(zip(("k1", "k2"), key_hash(self.keys), strict=True))
        keys = self.spark.read.schema(source.schema).parquet(kept).select(*[c.alias(k) for k, c in hashes.items()])
        self._bloom_of(keys).write.mode("append").parquet(f"{self.path}/bloom")
        name = self._index_table()
        keys.repartition(self.buckets, "k1", "k2").write.insertInto(name)  # one file a bucket
        self.spark.sql(f"DROP TABLE {name}")  # the files stay
