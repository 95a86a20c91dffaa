"""Sorts, limits, sampling and splits.

All randomness is a hash of (row key, seed) (``functions.rand``), so a draw is
the same on any cluster layout and after task retries.  Positions where rows are
cut come from ``operators.select``; dense positions of narrow rows from
``operators.rowid``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paracorpus.functions.rand import hash52, uniform
from paracorpus.operators.rowid import with_row_pos
from paracorpus.operators.select import cut_at
from paracorpus.session import written


def head_rows(df: DataFrame, n: int = 5, order_col: str = "row_id") -> DataFrame:
    """O2: ``head()`` = first ``n`` rows by the explicit order key."""
    return df.orderBy(F.col(order_col)).limit(n)


def slice_rows(df: DataFrame, start: int, stop: int, order_col: str = "row_id") -> DataFrame:
    """O3: ``select(range(start, stop))`` by dense position (``row_pos``).

    ``order_col`` is a unique whole number.  Its keys at both ends are selected on
    the narrow scan, the wide one is filtered by them (Parquet prunes by that
    range), and only the slice's own keys are numbered.
    """
    keys, start = df.select(order_col), max(start, 0)
    first, last = (cut_at(keys, p, order_col) for p in (start, stop))
    key = F.col(order_col)
    inside = last.before(key) & ~first.before(key)
    pos = with_row_pos(keys.filter(inside), order_col, "row_pos").withColumn("row_pos", F.col("row_pos") + F.lit(start))
    pos = pos.withColumnRenamed(order_col, "__key")
    return df.filter(inside).join(pos, key.eqNullSafe(F.col("__key"))).drop("__key")


def row_at(df: DataFrame, i: int, order_col: str = "row_id") -> DataFrame:
    """``ds[i]``."""
    return slice_rows(df, i, i + 1, order_col)


def seeded_shuffle(df: DataFrame, seed: int, key: str = "row_id") -> DataFrame:
    """``shuffle(seed)``: adds ``shuffle_pos`` (0-based) in hash order.

    Only (key, hash) rows are ordered; the positions are joined to the wide rows by
    the unique ``key``."""
    narrow = df.select(F.col(key).alias("__key"), hash52(F.col(key), str(seed)).alias("__h"))
    pos = with_row_pos(narrow, ["__h", "__key"], "shuffle_pos").drop("__h")
    return df.join(pos, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")


def draw_ranks(
    df: DataFrame, n: int, seed: int, tokens_col: str, key: str = "row_id", weighting: str = "exp", rank_col: str = "draw_rank"
) -> DataFrame:
    """The draws of a weighted sample: ``key`` and ``rank_col`` (1-based), no other column.

    (key, weight) is written once, so token counts behind ``tokens_col`` run
    once.  Rows whose weight is null, zero or not finite are never drawn.  An
    approximate quantile cuts the keys a little above the n smallest; the exact
    order of the rest is a distributed position, so no task ranks them all.
    """
    t = F.col(tokens_col).cast("double")
    if weighting not in ("exp", "linear"):
        raise ValueError(weighting)
    narrow = written(df.select(F.col(key), t.alias("__t")), "draw")
    if weighting == "exp":
        mean = narrow.agg(F.avg("__t")).first()[0]
        logw = F.col("__t") / F.lit(mean) if mean else F.lit(None).cast("double")
    else:
        logw = F.ln("__t")  # null for zero and negative weights
    race = F.ln(-F.ln(uniform(F.col(key), str(seed)))) - logw
    keyed = written(narrow.select(key, race.alias("__k")).filter("__k IS NOT NULL AND NOT isnan(__k)"), "race")
    total = keyed.count()
    if total > n:
        share = min(1.0, 1.1 * n / total + 0.001)  # percentile_approx is off by at most 1 / 10,000 of the rows
        cut = keyed.agg(F.percentile_approx("__k", share, 10_000)).first()[0]
        keyed = keyed.filter(F.col("__k") <= F.lit(cut))
    ranked = with_row_pos(keyed, ["__k", key], rank_col).filter(F.col(rank_col) < n)
    return ranked.select(key, (F.col(rank_col) + 1).cast("int").alias(rank_col))


def weighted_sample(
    df: DataFrame,
    n: int,
    seed: int,
    tokens_col: str,
    key: str = "row_id",
    weighting: str = "exp",
    rank_col: str = "draw_rank",
) -> DataFrame:
    """Weighted sample without replacement of size ``min(n, weighted rows)``.

    Weights are ``exp(t / mean(t))`` (``weighting='exp'``) or ``t``
    (``'linear'``); a null or zero weight is never drawn.  Efraimidis-Spirakis:
    keep the ``n`` smallest keys ``ln(-ln u) - ln w``, computed in log space so
    large weights cannot overflow.  Same inclusion law as sequential weighted
    draws without replacement; ``draw_rank`` is the draw order.  ``key`` must be
    unique: the drawn rows are gathered by it.
    """
    return df.join(draw_ranks(df, n, seed, tokens_col, key, weighting, rank_col), key)


def sample_with_pinned_source(
    df: DataFrame, n: int, seed: int, tokens_col: str, src_col: str, pinned: str, max_tokens: int, key: str = "row_id"
) -> DataFrame:
    """Weighted sample of the rows below ``max_tokens`` outside ``pinned``,
    plus every row of the ``pinned`` source, whose ``draw_rank`` is null.

    ``df`` is read twice: narrowly for the draw, whole for the gathered rows.
    """
    from paracorpus.operators.filters import filter_max_tokens

    pool = filter_max_tokens(df.select(key, tokens_col, src_col), tokens_col, max_tokens, src_col, pinned)
    ranks = draw_ranks(pool, n, seed, tokens_col, key)
    return df.join(ranks, key, "left").filter(F.col("draw_rank").isNotNull() | (F.col(src_col) == F.lit(pinned)))


def split_positional(df: DataFrame, test_size: float, order_col: str = "row_id") -> DataFrame:
    """First ``int(n * (1 - test_size))`` rows are ``train``, the rest ``val``.

    ``n_train`` is computed on the driver with Python float arithmetic so the
    boundary matches the reference exactly (n=10, test_size=0.9 -> 0).
    ``order_col`` is a unique whole number; the split is a filter on its scan.
    """
    keys = df.select(order_col)
    cut = cut_at(keys, int(keys.count() * (1 - test_size)), order_col)
    return df.withColumn("split", F.when(cut.before(F.col(order_col)), "train").otherwise("val"))


def split_random(df: DataFrame, test_size: float, seed: int, key: str = "row_id") -> DataFrame:
    """``train_test_split``: ``ceil(n * test_size)`` rows in hash order are test.

    The split is a comparison of each row's own hash with the selected one, so no row
    is moved for it."""
    keys = df.select(F.col(key).alias("key"), hash52(F.col(key), str(seed)).alias("hash"))
    cut = cut_at(keys, math.ceil(keys.count() * test_size), "hash", "key")
    return df.withColumn("split", F.when(cut.before(hash52(F.col(key), str(seed)), F.col(key)), "test").otherwise("train"))


def gather_by_index(df: DataFrame, indices: DataFrame, key: str = "row_id", rank_col: str = "draw_rank") -> DataFrame:
    """``dataset.select(indices)``: rows of ``df`` named by ``indices``
    (key + draw rank), in draw order.  Spark broadcasts the index list if its
    measured bytes allow, else the join shuffles."""
    return df.join(indices.select(key, rank_col), key, "inner").orderBy(rank_col)
