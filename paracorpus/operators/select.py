"""Distributed selection: the n-th smallest key, exactly, without sorting anything.

Keys are counted in a histogram over the range that holds the n-th one, the bin
where the running count passes n becomes the next range, and so on.  Each round is
one aggregation of at most ``BINS`` counts over the narrow key; a 52-bit hash takes
five rounds at any table size, mostly fewer, since a range of few rows ends it.
Splits, slices and draws are then filters on the wide scan: no row is moved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
#: Rows of a range that are read and ordered instead of being counted again.
FEW = 4096


@dataclass(frozen=True)
class Cut:
    """The key at one position of the order (value, tie); null values come first."""

    position: int
    total: int
    value: int | None
    tie: object = None

    def before(self, value: Column, tie: Column | None = None) -> Column:
        """Whether a row comes before the position."""
        if self.position <= 0 or self.position >= self.total:
            return F.lit(self.position > 0)
        here = F.lit(False) if tie is None else (tie < F.lit(self.tie) if self.tie is not None else F.lit(False))
        if self.value is None:
            return value.isNull() & here
        return value.isNull() | (value < F.lit(self.value)) | ((value == F.lit(self.value)) & here)


def cut_at(keys: DataFrame, position: int, value: str, tie: str | None = None) -> Cut:
    """The key at the 0-based ``position`` of (value, tie) order; ``value`` is a whole number.

    ``keys`` is read once for its bounds and once for each round.  Rows are told
    apart by ``tie``, which must be unique among equal values; without it, ``value``
    must be unique.  A position at or past the end takes every row.
    """
    v = F.col(value).cast("long")
    low, high, total, nulls = keys.agg(F.min(v), F.max(v), F.count(F.lit(1)), F.count_if(v.isNull())).first()
    if position <= 0 or position >= total:
        return Cut(position, total, None)
    if position < nulls:
        return Cut(position, total, None, _ordered(keys.filter(v.isNull()), position, value, tie)[1])
    left, held = position - nulls, total - nulls
    while held > FEW and low < high:
        width = -(-(high - low + 1) // BINS)
        counts = _histogram(keys.filter(v.between(F.lit(low), F.lit(high))), v, low, high, width)
        for bin_, n in counts:
            if left < n:
                break
            left -= n
        low, high, held = low + bin_ * width, min(high, low + (bin_ + 1) * width - 1), n
    found = _ordered(keys.filter(v.between(F.lit(low), F.lit(high))), left, value, tie)
    return Cut(position, total, *found)


def _histogram(keys: DataFrame, v: Column, low: int, high: int, width: int) -> list[tuple[int, int]]:
    """(bin, rows), bins ascending."""
    wide = high - low >= 1 << 62  # the difference might not be a long
    apart = v.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)") if wide else v - F.lit(low)
    size = f"cast({width} as decimal(20,0))" if wide else f"{width}L"
    bins = keys.select(apart.alias("__d")).groupBy(F.expr(f"cast(__d div {size} as int)").alias("bin"))
    return sorted((r["bin"], r["n"]) for r in bins.agg(F.count(F.lit(1)).alias("n")).collect())


def _ordered(keys: DataFrame, left: int, value: str, tie: str | None) -> tuple[int | None, object]:
    """The row at ``left`` among few rows, or among rows of one value."""
    order = [value] if tie is None else [value, tie]
    row = keys.select(*order).orderBy(*order).offset(left).limit(1).first()
    return row[0], row[1] if tie else None
