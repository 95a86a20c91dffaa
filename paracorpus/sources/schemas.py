"""Declared schemas of the corpus stages and their check at a boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType


def _of(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_S, _I, _L = StringType(), IntegerType(), LongType()

#: Merged corpus before it is refined (result of Q2).
MERGED = _of(english=_S, darija_ar=_S, dataset_source=_S, id=_S, role=_S, row_id=_L)
#: Train and test rows after refinement (result of Q4).
TRAIN_TEST = _of(english=_S, darija_Arab=_S, darija_Latn=_S, dataset_source=_S, id=_S, role=_S, row_id=_L, darija_tokens=_I, split=_S)
#: Drawn training sample (result of Q5).
SAMPLE = _of(row_id=_L, english=_S, ary_Arab=_S, ary_Latn=_S, ary_tokens=_I, dataset_source=_S, draw_rank=_I)


def checked(df: DataFrame, schema: StructType, stage: str) -> DataFrame:
    """``df`` itself if it has all columns of ``schema`` with their types; else a ``ValueError``.

    Reads the plan's schema only; further columns are allowed.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: {have[f.name].simpleString() if f.name in have else 'missing'}" for f in schema.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"{stage}: " + ", ".join(wrong))
    return df
