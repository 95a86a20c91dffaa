"""Dense row positions without a single-partition window.

The reference leans on list order (``select(range)``, ``keep='first'``,
``add_column``, fixed-size chunks).  Here order is always an explicit key and a
dense 0-based position is computed in one way at every size:

1. rows are range-partitioned and sorted by (partition columns, order columns),
   numbered inside their partition and written once, so one layout is fixed;
2. the row counts per partition (one number for each shuffle partition) give
   each partition its offset;
3. with partition columns, the first position of each group is subtracted.

Null keys are ordinary values, first in the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paracorpus.session import written


def _as_list(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def with_row_pos(
    df: DataFrame,
    order_cols: str | Sequence[str],
    pos_col: str = "row_pos",
    partition_cols: str | Sequence[str] | None = None,
    ranges: int | None = None,
    only_order: Sequence[str] = (),
) -> DataFrame:
    """Add a dense 0-based position by ``order_cols`` (ascending, null first),
    restarting per ``partition_cols`` (null is a group).  Ties must be broken by
    the order columns themselves (pass a unique key last).  ``ranges`` is the
    number of range partitions, by default the session's shuffle partitions.
    Columns in ``only_order`` serve the order alone: they are neither written nor returned.
    Pass narrow rows and join the wide ones by key where texts are large."""
    spark = df.sparkSession
    parts = _as_list(partition_cols)
    order = parts + _as_list(order_cols)
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mid, rng = "__pc_mid", "__pc_range"
    placed = written(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(mid, F.monotonically_increasing_id()).drop(*only_order), "rowpos"
    ).withColumn(rng, F.shiftright(mid, 33).cast("int"))
    sizes = {r[rng]: r["count"] for r in placed.groupBy(rng).count().collect()}  # one row per range
    offsets, total = [], 0
    for i in range(max(sizes, default=0) + 1):
        offsets.append(total)
        total += sizes.get(i, 0)
    at = F.element_at(F.lit(offsets).cast("array<bigint>"), F.col(rng) + 1) + F.col(mid).bitwiseAND(F.lit((1 << 33) - 1))
    out = placed.withColumn(pos_col, at)
    if parts:
        names = [f"__pc_g{i}" for i in range(len(parts))]
        first = out.groupBy(*[F.col(p).alias(g) for p, g in zip(parts, names)]).agg(F.min(pos_col).alias("__pc_first"))
        same = [F.col(p).eqNullSafe(F.col(g)) for p, g in zip(parts, names)]
        cond = same[0]
        for c in same[1:]:
            cond = cond & c
        out = out.join(first, cond).withColumn(pos_col, F.col(pos_col) - F.col("__pc_first")).drop("__pc_first", *names)
    return out.drop(mid, rng)
