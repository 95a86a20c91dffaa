"""Registry shared by the query modules: name -> Spark callable, name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.operators import encode
from paracorpus.plans import sqltext as sq

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# Fixed parameters taken from the reference.
SEED = 1998
MAX_TOKENS = 4096
SAMPLE_N = 500  # the reference draws 10,000 of 580,000; here a size below the smallest pool
CHUNK = 1000
# Parameters of our own test queries.
PINNED_SOURCE = "src5"
SMALL_SAMPLE_N = 200
WIDE_LANGS = ["english", "ary_Arab", "french", "german", "spanish"]


def _pairs_tok(spark, sf):
    return fx.pairs(spark, sf).withColumn("darija_tokens", encode.token_count(F.col("darija_ar")))


PAIRS_TOK_SQL = f"SELECT *, {sq.token_count('darija_ar')} AS darija_tokens FROM pairs"

