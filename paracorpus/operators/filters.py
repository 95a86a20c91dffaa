"""Filters and predicates with the reference's null semantics.

pandas/Python ``!=`` and ``not in`` keep null rows, so negated predicates use
null-safe forms.  Every predicate stays a JVM expression so Parquet pushdown
and whole-stage codegen apply.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paracorpus.functions.text import contains_code, is_blank


def dropna_any(df: DataFrame) -> DataFrame:
    """drop rows with a null in any column (empty string is not null)."""
    return df.na.drop(how="any")


def dropna_subset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """rows without a null (or NaN) in ``cols``.

    Plain null tests, which Spark simplifies: a column that is known to be set isn't computed for them.
    """
    types = dict(df.dtypes)
    plain = [c for c in cols if "." not in c and types.get(c) not in (None, "float", "double")]
    rest = [c for c in cols if c not in plain]
    out = df.filter(reduce(and_, [F.col(c).isNotNull() for c in plain])) if plain else df
    return out.na.drop(how="any", subset=rest) if rest else out


def neq_keep_null(c: Column, value) -> Column:
    """``x != value`` that keeps nulls."""
    return ~c.eqNullSafe(F.lit(value))


def filter_neq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(neq_keep_null(F.col(col), value))


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """F6."""
    return df.filter(F.col(col) == F.lit(value))


def not_in_keep_null(c: Column, values: Sequence[str]) -> Column:
    """``x not in values`` keeping nulls; pushes down as Not(In(...))."""
    return ~F.coalesce(c.isin(list(values)), F.lit(False))


def filter_bad_sources(df: DataFrame, bad, col: str = "dataset_source") -> DataFrame:
    """Source blacklist.

    A Python list becomes a pushed-down ``NOT IN``.  A DataFrame blacklist is
    applied as a left-anti join, which Spark broadcasts if the list's measured
    bytes allow.  Null sources are kept.
    """
    if not isinstance(bad, DataFrame):
        return df.filter(not_in_keep_null(F.col(col), bad))
    bad = bad.select(F.col(bad.columns[0]).alias("__bad")).dropna().distinct()
    return df.join(bad, F.col(col) == F.col("__bad"), "left_anti")


def max_tokens_report(df: DataFrame, tokens_col: str, limit: int, src_col: str, excluded: str) -> DataFrame:
    """F5's counts in one pass: rows kept, too long, excluded, and dropped for a null count."""
    kept = (F.col(tokens_col) < limit) & neq_keep_null(F.col(src_col), excluded)
    return df.agg(
        F.count_if(F.coalesce(kept, F.lit(False))).alias("n_kept"),
        F.count_if(F.col(tokens_col) >= limit).alias("n_too_long"),
        F.count_if(F.col(src_col) == excluded).alias("n_excluded"),
        F.count_if(F.col(tokens_col).isNull()).alias("n_null_count"),
    )


def filter_max_tokens(df: DataFrame, tokens_col: str, limit: int, src_col: str, excluded: str) -> DataFrame:
    """``tokens < limit and src != excluded`` (null source kept; null count dropped)."""
    return df.filter((F.col(tokens_col) < limit) & neq_keep_null(F.col(src_col), excluded))


def filter_code(df: DataFrame, col: str) -> DataFrame:
    """drop rows whose text looks like code; null text is kept."""
    return df.filter(~F.coalesce(contains_code(F.col(col)), F.lit(False)))


def filter_blank_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """F8: skip a pair when either side is blank after strip (null counts as blank)."""
    return df.filter(~F.coalesce(is_blank(F.col(a)), F.lit(True)) & ~F.coalesce(is_blank(F.col(b)), F.lit(True)))
