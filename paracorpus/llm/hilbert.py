"""Sharding by a Hilbert curve over metadata dimensions.

Every dimension is quantised into ``2**bits`` cells, the cells are mapped to
their index on an n-dimensional Hilbert curve, the rows are ordered by that
index and the order is cut into runs of equal row counts.  Rows that are close
in all dimensions land in the same shard, so the min/max statistics of a
shard's files prune scans that filter on any of the dimensions.

Only DataFrame functions are used.  Texts are read once for their size and
checksum; the range shuffle moves narrow rows.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from paracorpus.llm.common import with_positions

#: Bytes of a string, after the prefix that all values share, that order its cells.
STRING_CODE_BYTES = 6


def curve_table(dims: int) -> list[int]:
    """Transition table of the curve: entry ``state * 2**dims + cell`` packs the
    index digit and the next state as ``digit << state_bits | next``.

    A state is an entry corner and a direction; the digit of a cell is the
    inverse Gray code of the cell seen from that state.
    """
    full = (1 << dims) - 1

    def rot(x: int, k: int) -> int:
        k %= dims
        return ((x << k) | (x >> (dims - k))) & full

    def gray(x: int) -> int:
        return x ^ (x >> 1)

    inverse = {gray(x): x for x in range(full + 1)}
    trailing_ones = [(~x & (x + 1)).bit_length() - 1 for x in range(full + 1)]
    out = []
    for state in range((full + 1) * dims):
        corner, direction = divmod(state, dims)
        for cell in range(full + 1):
            digit = inverse[rot(cell ^ corner, dims - (direction + 1) % dims)]
            entry = 0 if digit == 0 else gray(2 * ((digit - 1) // 2))
            turn = 0 if digit == 0 else trailing_ones[digit - 1 if digit % 2 == 0 else digit] % dims
            corner2 = corner ^ rot(entry, direction + 1)
            direction2 = (direction + turn + 1) % dims
            out.append(digit << state_bits(dims) | (corner2 * dims + direction2))
    return out


def state_bits(dims: int) -> int:
    return ((1 << dims) * dims - 1).bit_length()


def curve_index(cells: Sequence[Column], bits: int) -> Column:
    """Hilbert index of integer cells in ``0 .. 2**bits - 1``, one column per dimension."""
    dims = len(cells)
    sb = state_bits(dims)
    lookup = F.lit(curve_table(dims)).cast("array<bigint>")
    levels = []
    for level in range(bits - 1, -1, -1):
        word = F.lit(0)
        for k, cell in enumerate(cells):
            bit = F.shiftright(cell.cast("int"), level).bitwiseAND(F.lit(1))
            word = word.bitwiseOR(F.shiftleft(bit, k))
        levels.append(word)

    def step(acc: Column, word: Column) -> Column:
        at = acc.bitwiseAND(F.lit((1 << sb) - 1)) * F.lit(1 << dims) + word + F.lit(1)
        return F.shiftleft(F.shiftright(acc, sb), sb + dims).bitwiseOR(F.element_at(lookup, at.cast("int")))

    return F.shiftright(F.aggregate(F.array(*levels), F.lit(0).cast("bigint"), step), sb)


def _codes(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Replace string dimensions by a number that keeps their order."""
    strings = [d for d in dims if isinstance(df.schema[d].dataType, StringType)]
    ends = {}
    if strings:
        row = df.agg(*[f(d).alias(f"{d}_{i}") for d in strings for i, f in enumerate((F.min, F.max))]).first()
        ends = {d: [(row[f"{d}_{i}"] or "").encode() for i in (0, 1)] for d in strings}
    out = df
    for d in dims:
        if d in ends:
            skip = len(os.path.commonprefix(ends[d]))
            head = F.substring(F.col(d).cast("binary"), skip + 1, STRING_CODE_BYTES)
            code = F.conv(F.rpad(F.hex(head), 2 * STRING_CODE_BYTES, "0"), 16, 10)
            out = out.withColumn(d, code.cast("double"))
        else:
            out = out.withColumn(d, F.col(d).cast("double"))
    return out


def _cell(bounds: Column, value: Column) -> Column:
    return F.coalesce(F.size(F.filter(bounds, lambda b: b <= value)), F.lit(0))


def hilbert_order(df: DataFrame, dims: Sequence[str], key: str, bits: int = 5) -> DataFrame:
    """``df`` (narrow) with ``hilbert``, the curve index of its quantised ``dims``,
    and ``pos``, its dense position by (hilbert, all columns).

    Cells are cut at approximate quantiles, so skewed dimensions still use the
    whole grid; a value that holds many rows is one cell.  A null or NaN
    dimension value is in the first cell.
    """
    coded = _codes(df.select(*[F.col(d).alias(f"dim{i}") for i, d in enumerate(dims)]), [f"dim{i}" for i in range(len(dims))])
    names = coded.columns
    probs = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = coded.agg(*[F.percentile_approx(c, probs, 10_000).alias(c) for c in names]).first()
    wide = df.select("*", *[F.col(d).alias(f"__dim{i}") for i, d in enumerate(dims)])
    wide = _codes(wide, [f"__dim{i}" for i in range(len(dims))])
    cells = []
    for i, c in enumerate(names):
        bounds = F.lit(sorted(set(cuts[c] or []))).cast("array<double>")
        cells.append(_cell(bounds, F.col(f"__dim{i}")))
    placed = wide.withColumn("hilbert", curve_index(cells, bits)).drop(*[f"__dim{i}" for i in range(len(dims))])
    order = ["hilbert", key, *[c for c in df.columns if c != key]]
    return with_positions(placed, order, name="hilbert")


def shard_rows(df: DataFrame, dims: Sequence[str], n_shards: int, key: str = "doc_id", bits: int = 5) -> DataFrame:
    """Cut the curve order into ``n_shards`` runs whose row counts differ by at most one.

    Adds ``hilbert``, ``shard`` (int) and ``slot`` (long, gapless from 0 inside
    the shard).  Nulls in any column are kept (first cell, first in the order);
    repeated rows get places of their own; an empty table gives an empty result;
    input columns named like the added ones are replaced.
    """
    if n_shards < 1 or len(dims) * bits > 40:
        raise ValueError("need at least one shard and at most 40 bits of curve index")
    df = df.drop(*({"hilbert", "pos", "shard", "slot"} - {key, *dims}))
    placed = hilbert_order(df, dims, key, bits)
    n = placed.count()
    placed = placed.withColumn("shard", F.expr(f"cast((pos * {n_shards}L) div {max(n, 1)}L as int)"))
    first = F.expr(f"(cast(shard as bigint) * {max(n, 1)}L + {n_shards - 1}L) div {n_shards}L")
    return placed.withColumn("slot", F.col("pos") - first).drop("pos")


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write whole rows as one folder per shard, each file sorted along the curve.

    ``assigned`` is the result of :func:`shard_rows`.  Rows of a shard are spread
    over as many tasks as their share of the shuffle partitions, so the shard
    count doesn't bound parallelism; every file covers one run of the curve.
    """
    place = assigned.select(F.col(key).alias("__key"), F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))
    clean = docs.drop("shard")
    joined = clean.join(place, clean[key].eqNullSafe(place["__key"]), "inner")
    ordered = joined.repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot")
    ordered.withColumnRenamed("__shard", "shard").drop("__key", "__slot").write.partitionBy("shard").parquet(path)


def op1_query(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """Digest columns of the sharding of ``docs``; law ``rows``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        "source",
        "lang",
    )
    return shard_rows(narrow, ["source", "lang", "size", "doc_id"], n_shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )
