"""Unions, keep-first dedup and split dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """U1 (``pd.concat``: columns by name, missing -> null) and U2 (strict)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def key_hash(keys: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the keys; each key goes with its null flag, so nulls
    equal nulls and keep their place."""
    parts = [x for k in keys for x in (F.col(k), F.col(k).isNull())]
    return [F.xxhash64(F.lit(salt), *parts) for salt in (1, 2)]


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order_col: str | Sequence[str] = "row_id") -> DataFrame:
    """``drop_duplicates(subset=keys, keep='first')``; null equals null.

    Rows are grouped by a 128-bit hash of the keys, so whole texts are never
    compared or sorted (two different keys among n rows collide with
    probability n^2 / 2^129).  ``row_number() = 1`` lets Catalyst insert a
    partial ``WindowGroupLimit`` before the shuffle, so a hot key sends at most
    one row per map task across the network instead of all of its copies.
    """
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    names = ["__k1", "__k2"]
    hashed = df.withColumns(dict(zip(names, key_hash(keys), strict=True)))
    w = Window.partitionBy(*names).orderBy(*[F.col(c).asc() for c in order])
    return hashed.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn", *names)


def split_dict(splits: Mapping[str, DataFrame], col: str = "split") -> DataFrame:
    """``DatasetDict`` at rest = one frame with a ``split`` column."""
    frames = [df.withColumn(col, F.lit(name)) for name, df in splits.items()]
    return union_by_name(frames, allow_missing=True)
