"""Projections: DataFrame -> DataFrame, chainable with ``.transform``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_reorder(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep and order columns."""
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Remove columns (missing names are an error, as in the reference)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by name."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.withColumnsRenamed(dict(mapping))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df.columns = [...]`` with an arity check first."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def constant_columns(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """P5: constant, empty-string or typed-null columns (``None`` -> null string)."""
    cols = {k: (F.lit(None).cast("string") if v is None else F.lit(v)) for k, v in values.items()}
    return df.withColumns(cols)


def coalesce_columns(df: DataFrame, target: str, fallback: str) -> DataFrame:
    """``target.fillna(fallback)`` on the same rows (no index alignment needed)."""
    return df.withColumn(target, F.coalesce(F.col(target), F.col(fallback)))


def align_columns(frames: Mapping[str, DataFrame], fill: str = "") -> dict[str, DataFrame]:
    """Give every frame the union of all column names; missing -> ``fill``.

    Metadata only on the driver (column names); the fill is an empty string,
    not null, like the reference.
    """
    all_cols: list[str] = []
    for df in frames.values():
        for c in df.columns:
            if c not in all_cols:
                all_cols.append(c)
    out = {}
    for name, df in frames.items():
        missing = {c: F.lit(fill) for c in all_cols if c not in df.columns}
        out[name] = df.withColumns(missing) if missing else df
    return out


def append_column(df: DataFrame, values: DataFrame, key: str = "row_id") -> DataFrame:
    """Positional zip re-expressed as an equi-join on an explicit row id.

    Both sides are large in general, so the join is left to Catalyst/AQE
    (sort-merge, or broadcast when ``values`` is measured small).
    """
    return df.join(values, on=key, how="inner")


def extract_struct_field(df: DataFrame, array_col: str, field: str, out: str) -> DataFrame:
    """``[t[field] for t in outputs]`` as a higher-order ``transform``."""
    return df.withColumn(out, F.transform(F.col(array_col), lambda x: x[field]))


def model_label(c) -> F.Column:
    """P10: last path segment of a model path."""
    return F.substring_index(c, "/", -1)


SCORE_LABELS = {"bleu": "BLEU", "chrf": "chrF"}


def scores_wide(long: DataFrame, metrics: Sequence[str], models: Sequence[str], key: str = "row_id") -> DataFrame:
    """P10: long (key, model, metrics...) -> one column per (metric, model label).

    ``models`` is the (small, explicit) list of model paths, so the pivot does
    not need a separate distinct job; the aggregation is keyed by ``key``.
    """
    labels = [m.split("/")[-1] for m in models]
    lab = model_label(F.col("model"))
    aggs = [
        F.max(F.when(lab == F.lit(lbl), F.col(m))).alias(f"{SCORE_LABELS.get(m, m)}_{lbl}")
        for m in metrics
        for lbl in labels
    ]
    return long.groupBy(key).agg(*aggs)
