"""Aggregations: one-pass, map-side-combined aggregates.

Global scalars (mean, min/max, n) are computed once as a single-row
aggregate and used as literals or a one-row broadcast; no ``over ()`` window
ever pulls a whole table into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paracorpus.operators.rowid import with_row_pos
from paracorpus.session import written


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1: ``isna().sum()`` -> (column, n_null), one scan."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_null")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A2: counts per non-null value, most frequent first."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col(col))
    )


def total_tokens(df: DataFrame, tokens_col: str, by: Sequence[str] = ()) -> DataFrame:
    """A3: ``sum(ds[tokens])``, optionally per group."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.sum(tokens_col).alias("total_tokens")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def token_stats(df: DataFrame, tokens_col: str, digits: int = 4) -> DataFrame:
    """A4: mean, population std, and the mean +/- std markers (lower only if > 0)."""
    t = F.col(tokens_col)
    s = df.agg(F.count(t).alias("n"), F.avg(t).alias("mean"), F.stddev_pop(t).alias("std"))
    lower = F.when(F.col("mean") - F.col("std") > 0, F.col("mean") - F.col("std"))
    return s.select(
        "n",
        F.bround("mean", digits).alias("mean"),
        F.bround("std", digits).alias("std"),
        F.bround(F.col("mean") + F.col("std"), digits).alias("upper"),
        F.bround(lower, digits).alias("lower"),
    )


def token_histogram(df: DataFrame, tokens_col: str, bins: int = 50, digits: int = 4) -> DataFrame:
    """A5: equal-width histogram like ``np.histogram(x, bins)``.

    Bin ``i`` (1-based) holds ``[lo + (i-1)w, lo + iw)``; the last bin is closed.
    An all-equal column widens the range by 0.5 on both sides, as numpy does.
    The global min/max is one aggregate collected as two numbers; every bin
    appears, empty ones with count 0.
    """
    # both passes (range, then bins) read one materialised numeric column,
    # so the text work behind it runs once
    df = written(df.select(F.col(tokens_col).cast("double").alias(tokens_col)), "histogram")
    t = F.col(tokens_col)
    lo_hi = df.agg(F.min(t).alias("lo"), F.max(t).alias("hi")).first()
    lo, hi = lo_hi["lo"], lo_hi["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, count bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = hi - lo
    b = F.least(F.floor((t - F.lit(lo)) * F.lit(float(bins)) / F.lit(width)).cast("int"), F.lit(bins - 1)) + 1
    counts = df.filter(t.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    edges = lambda k: F.bround(F.lit(lo) + (F.col("bin") + F.lit(k)).cast("double") * F.lit(width) / F.lit(float(bins)), digits)
    return (
        all_bins.join(F.broadcast(counts), "bin", "left")
        .select("bin", edges(-1).alias("bin_lo"), edges(0).alias("bin_hi"), F.coalesce("count", F.lit(0)).alias("count"))
    )


def index_spread(indices: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """Spread of sampled indices (gaps between sorted neighbours).

    Neighbours are paired by a distributed dense position and an equi-join on
    ``pos + 1`` instead of a single-partition ``lag`` window.
    """
    pos = with_row_pos(indices.select(F.col(col).alias("idx")), "idx", "pos")
    a = pos.alias("a")
    b = pos.alias("b")
    gaps = a.join(b, F.col("b.pos") == F.col("a.pos") + 1).select((F.col("b.idx") - F.col("a.idx")).alias("gap"))
    s = gaps.agg(
        F.count(F.lit(1)).alias("n_gaps"),
        F.avg("gap").alias("mean_gap"),
        F.min("gap").alias("min_gap"),
        F.max("gap").alias("max_gap"),
        F.count_if(F.col("gap") == 1).alias("consecutive"),
    )
    return s.select(
        "n_gaps",
        F.bround("mean_gap", digits).alias("mean_gap"),
        "min_gap",
        "max_gap",
        "consecutive",
        F.bround(F.lit(100.0) * F.col("consecutive") / F.col("n_gaps"), 1).alias("pct_consecutive"),
    )


def row_count(df: DataFrame) -> DataFrame:
    """A10: ``len(ds)`` as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def best_checkpoint(log: DataFrame, run: str = "run_id", step: str = "step", metric: str = "bleu") -> DataFrame:
    """Best step per run by metric; ties go to the earliest step."""
    best = F.max_by(F.struct(F.col(step), F.col(metric)), F.struct(F.col(metric), -F.col(step)))
    return log.filter(F.col(metric).isNotNull()).groupBy(run).agg(best.alias("b")).select(
        run, F.col("b")[step].alias("best_step"), F.col("b")[metric].alias("best_" + metric)
    )
