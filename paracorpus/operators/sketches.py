"""Mergeable statistics: kept with a dataset, merged when read.

A row of state holds count, sums, bounds and a KLL quantile sketch of one column
for one split (or shard, or day).  States merge by sums and by merging sketches,
so the statistics of any union of splits, and of what is appended later, come
from a few rows and no second pass.  Counts, mean, deviation and bounds are exact;
quantiles and bin counts are off by at most ``rank_error`` of the rows, with the
sketch's own confidence (99 %).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: KLL size: rank error 0.0133 of the rows at 200, falling nearly with 1 / k.
K = 400


def rank_error(k: int = K) -> float:
    """Normalised rank error of a double-sided KLL query at 99 % confidence, as its authors fit it."""
    return 2.446 / k**0.9433


def state_of(df: DataFrame, value_col: str, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One row of state a group: (by..., n, s1, s2, low, high, sketch); nulls don't count."""
    v = F.col(value_col).cast("long")
    square = v.cast("decimal(38,0)") * v.cast("decimal(38,0)")
    return df.filter(v.isNotNull()).groupBy(*by).agg(
        F.count(v).alias("n"), F.sum(v).alias("s1"), F.sum(square).cast("decimal(38,0)").alias("s2"),
        F.min(v).alias("low"), F.max(v).alias("high"), F.kll_sketch_agg_bigint(v, F.lit(k)).alias("sketch"),
    )


def merged(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The states of a coarser grouping, or of all rows."""
    return states.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").cast("decimal(38,0)").alias("s2"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )


def moments(states: DataFrame, by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """(by..., n, total, mean, std, low, high): exact."""
    n = F.col("n").cast("double")
    mean = F.col("s1").cast("double") / n
    variance = F.greatest(F.col("s2").cast("double") / n - mean * mean, F.lit(0.0))
    return states.select(*by, "n", F.col("s1").alias("total"), F.bround(mean, digits).alias("mean"), F.bround(F.sqrt(variance), digits).alias("std"), "low", "high")


def quantiles(states: DataFrame, ranks: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., rank, value): values whose rank is within ``rank_error`` of the one asked for."""
    asked = [F.struct(F.lit(float(r)).alias("rank"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(r))).alias("value")) for r in ranks]
    return states.select(*by, F.inline(F.array(*asked)))


def histogram(state: DataFrame, bins: int = 50) -> DataFrame:
    """(bin, bin_lo, bin_hi, count) of one merged state: equal-width bins; a count is off by twice
    ``rank_error`` of the rows at most.  The driver reads the state's bounds; no state gives no bins."""
    row = state.select("low", "high").first()
    if row is None or row["low"] is None:
        return state.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, count long")
    low, width = row["low"], (row["high"] - row["low"]) / bins
    edges = [low + k * width for k in range(bins + 1)]
    below = [F.lit(0.0), *[F.kll_sketch_get_rank_bigint("sketch", F.lit(math.ceil(e) - 1).cast("long")) for e in edges[1:-1]], F.lit(1.0)]
    each = [
        F.struct(F.lit(k + 1).alias("bin"), F.lit(edges[k]).alias("bin_lo"), F.lit(edges[k + 1]).alias("bin_hi"),
                 F.round(F.greatest(below[k + 1] - below[k], F.lit(0.0)) * F.col("n")).cast("long").alias("count"))
        for k in range(bins)
    ]
    return state.select(F.inline(F.array(*each)))
