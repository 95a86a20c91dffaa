"""Training-data pipeline over ``documents``: quality rules, near-duplicate removal,
benchmark decontamination, mixing to source targets, token output.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's input; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paracorpus.llm import decontaminate, line_quality, mixing, near_dup, simple8b
from paracorpus.llm.common import spill, table


#: Least similarity of near copies in the near-dedup stage; op7 has its own.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without lines that are frequent in their source.

    Null and empty texts fail the rules and go; repeated rows and rows without id
    are judged by source and text; a null source is one of its own; no rows give none.
    """
    return line_quality.without_frequent_lines(docs, line_quality.line_rules(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Rows with equal id and text are one document and one of them stays.  Texts
    without words are like nothing and stay.  A row without id goes if a row with
    one is like it; rows without id that are like each other stay.  No rows give none.
    """
    found = near_dup.near_duplicates(docs, percent=NEAR_PERCENT).filter("kept")
    kept = found.groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.count(F.lit(1)).alias("__n"))
    kept = spill(kept, "dedup_kept")
    same = docs["doc_id"].cast("long").eqNullSafe(kept["__id"]) & (F.xxhash64(docs["text"]) == kept["__hash"])
    once = docs.join(kept.filter("__n = 1"), same, "left_semi")
    # only rows that are repeated are compared with each other
    again = docs.join(kept.filter("__n > 1"), same, "inner").dropDuplicates(["doc_id", "__hash"])
    return once.unionByName(again.select(*docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage.

    Each row is judged by its own text, also without an id or with one that other
    rows have; null and empty texts hold no passage and stay; no rows give none.
    """
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is one of its own; texts without words count nothing; repeated
    rows are documents each; no rows give none.
    """
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the token segments.

    Null and empty texts are an end id alone; rows without id come first; repeated
    rows are written each; no rows give none.
    """
    return simple8b.op2_query(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", token_files),
]

#: Not expressible: MinHash components, banded alignment, BPE ids; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir), f"stage_{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
