"""Small document tables with the awkward cases that every operator must take."""

import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """rows: (doc_id, text[, source]); other columns are filled in."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def awkward(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 997} token{i}" for i in range(30_000))
    rows = [
        (1, "a plain text with some words in it and a full stop.", "en", "s1", 10),
        (1, "a plain text with some words in it and a full stop.", "en", "s1", 10),
        (2, None, None, None, None),
        (3, "", "en", "s1", 0),
        (4, " \t\n ", "en", None, 4),
        (None, "row without id", "de", "s2", 14),
        (5, long, "en", "s1", len(long)),
        (6, "ünïcödé ß İ 中文 🙂 text", "de", "s2", 20),
        (7, "x", "en", "s3", 1),
    ]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    extra = ["hilbert", "shard", "slot", "size", "id", "key", "node", "kept", "line", "spans", "copies", "start", "pos", "label"]
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(extra)])


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]
