"""Queries over datasets at rest: ordered files, published commits, one source after the other."""

from __future__ import annotations

from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.fixtures import with_ctes
from paracorpus.operators import merge
from paracorpus.operators.keepfirst import KeepFirst
from paracorpus.plans.base import SMALL_SAMPLE_N, register
from paracorpus.plans.q_sample import POS_SQL
from paracorpus.session import scratch_path
from paracorpus.sources import commits, ordered

KEYS = ("english", "darija_ar")
N_SOURCES = 3
FILES = 12


def _ordered(spark, sf):
    path = scratch_path(spark, "ordered")
    ordered.write_ordered(fx.pairs(spark, sf), path, "row_id", FILES)
    return path


@register("slice_at_rest", with_ctes("pairs", body=f"SELECT * FROM ({POS_SQL}) t WHERE row_pos >= 100 AND row_pos < 300"))
def q_slice_at_rest(spark, sf):
    return ordered.read_slice(spark, _ordered(spark, sf), 100, 300)


@register("row_at_rest", with_ctes("pairs", body=f"SELECT * FROM ({POS_SQL}) t WHERE row_pos = 137"))
def q_row_at_rest(spark, sf):
    return ordered.read_row(spark, _ordered(spark, sf), 137)


@register(
    "gather_at_rest",
    with_ctes("pairs", body=f"SELECT t.* FROM ({POS_SQL}) t WHERE row_id IN (SELECT row_id FROM pairs ORDER BY md5(cast(row_id AS VARCHAR)), row_id LIMIT {SMALL_SAMPLE_N})"),
)
def q_gather_at_rest(spark, sf):
    drawn = fx.pairs(spark, sf).select("row_id").orderBy(F.md5(F.col("row_id").cast("string")), "row_id").limit(SMALL_SAMPLE_N)
    return ordered.read_keys(spark, _ordered(spark, sf), drawn)


@register(
    "commit_replaces_partition",
    with_ctes("pairs", body="SELECT row_id, english, dataset_source, 1 AS version FROM pairs WHERE dataset_source <> 'src3' "
              "UNION ALL SELECT row_id, concat(english, ' again'), dataset_source, 2 FROM pairs WHERE dataset_source = 'src3' AND row_id % 3 = 0"),
)
def q_commit_replaces_partition(spark, sf):
    """One partition is written again, then a write dies: readers see the second commit."""
    path = scratch_path(spark, "commits")
    rows = fx.pairs(spark, sf).filter("dataset_source IS NOT NULL").select("row_id", "english", "dataset_source")
    commits.write_commit(rows.withColumn("version", F.lit(1)), path, ["dataset_source"], "all")
    again = rows.filter("dataset_source = 'src3' AND row_id % 3 = 0").withColumns({"english": F.concat("english", F.lit(" again")), "version": F.lit(2)})
    commits.write_commit(again, path, ["dataset_source"], "again")
    dies = rows.withColumn("version", F.when(F.col("row_id") >= 0, F.raise_error(F.lit("dies"))).cast("int"))
    try:
        commits.write_commit(dies, path, ["dataset_source"], "dies")
    except Exception as error:  # noqa: BLE001 - the failure is the point
        if "dies" not in str(error):
            raise
    return commits.read_commit(spark, path)


@register(
    "dedup_one_source_after_the_other",
    with_ctes("pairs", body=f"SELECT row_id, source_no, english FROM (SELECT *, row_number() OVER (PARTITION BY english, darija_ar ORDER BY source_no, row_id) AS rn "
              f"FROM (SELECT *, CAST(row_id % {N_SOURCES} AS INTEGER) AS source_no FROM pairs) s) t WHERE rn = 1"),
)
def q_dedup_incremental(spark, sf):
    """Sources are appended one by one; the same rows as keep-first over all at once."""
    kept = KeepFirst(spark, scratch_path(spark, "kept"), KEYS, buckets=8, blocks=8)
    pairs = fx.pairs(spark, sf)
    for number in range(N_SOURCES):
        kept.append(pairs.filter(F.col("row_id") % N_SOURCES == number), number)
    return kept.rows().select("row_id", "source_no", "english")


def batch_dedup(pairs):
    numbered = pairs.withColumn("source_no", (F.col("row_id") % N_SOURCES).cast("int"))
    return merge.dedup_keep_first(numbered, KEYS, ["source_no", "row_id"])
