"""Repeatable per-row randomness.

``rand(seed)`` depends on the physical partitioning and is re-drawn when a
task is retried, so every random choice here is a pure function of a row key
and a seed: the first 13 hex digits of md5(key ":" seed) read as a 52-bit
integer.  DuckDB computes bit-identical values, which makes the oracle exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_52 = 4503599627370496.0


def _digest(*parts: Column | str) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    pieces: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            pieces.append(F.lit(":"))
        pieces.append(c.cast("string"))
    return F.md5(F.concat(*pieces))


def hash52(*parts: Column | str) -> Column:
    """52-bit integer hash of the parts joined with ':'."""
    return F.conv(F.substring(_digest(*parts), 1, 13), 16, 10).cast("bigint")


def uniform(*parts: Column | str) -> Column:
    """Uniform double in (0, 1), exact in both engines."""
    return (hash52(*parts).cast("double") + F.lit(0.5)) / F.lit(TWO_52)


def hash52_sql(*parts: str) -> str:
    """DuckDB form of ``hash52``; parts are SQL expressions."""
    joined = " || ':' || ".join(f"cast({p} AS VARCHAR)" for p in parts)
    return f"('0x' || substr(md5({joined}), 1, 13))::BIGINT"


def uniform_sql(*parts: str) -> str:
    return f"(({hash52_sql(*parts)})::DOUBLE + 0.5) / {TWO_52}"
