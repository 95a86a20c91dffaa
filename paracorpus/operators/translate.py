"""Batch translation as a pluggable Spark operator.

Two kinds of backend fill the model slot:

* a **lexicon** backend, fully native: words are looked up with a join (rows
  are partitioned by key before their words are exploded) and re-assembled in
  position order; unknown words are kept;
* a **Python** backend: any ``fn(texts: pd.Series, target: str) -> pd.Series``
  run through ``mapInPandas`` on Arrow batches, in chunks of the model's own
  batch size.  A failing batch is halved down to the rows that fail alone;
  these are recorded (``status``/``error``) instead of aborting the job, so a
  retry only needs the rows that are not ``ok``.

No model or network exists here; tests plug in deterministic functions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paracorpus.fixtures import word_tokens
from paracorpus.session import path_exists


def lexicon_translate(df: DataFrame, key: str, text_col: str, lexicon: DataFrame, out: str = "translation") -> DataFrame:
    """Native backend: word-by-word lookup in ``lexicon`` (word, out).

    Returns ``key`` (unique) + ``out``.  ``out`` of the lexicon may be of any
    type; a map (language -> word) serves :func:`lexicon_fanout`.
    """
    g = _looked_up(df, key, text_col, lexicon)
    return g.select(key, F.array_join(F.transform("__t", lambda x: F.coalesce(x["o"], x["word"])), " ").alias(out))


def _looked_up(df: DataFrame, key: str, text_col: str, lexicon: DataFrame) -> DataFrame:
    """key + ``__t``: (pos, word, o) of every word in order."""
    lex = lexicon.select("word", F.col("out").alias("o"))
    rows = df.select(F.col(key).alias("__key"), F.col(text_col).alias("__x")).repartition("__key")
    toks = rows.select("__key", F.posexplode_outer(word_tokens(F.col("__x"))).alias("pos", "word"))
    entry = F.when(F.col("word").isNotNull(), F.struct("pos", "word", "o"))
    g = toks.join(lex, "word", "left").groupBy("__key").agg(F.collect_list(entry).alias("__t"))
    by_pos = F.array_sort("__t", lambda a, b: a["pos"] - b["pos"])
    return g.select(F.col("__key").alias(key), by_pos.alias("__t"))


def lexicon_fanout(
    df: DataFrame, key: str, text_col: str, lexicon: DataFrame, langs: Sequence[str],
    lang_col: str = "tgt_lang", out: str = "translation",
) -> DataFrame:
    """B2 on the lexicon (lang_col, word, out): (key, lang_col, out), one row per target.

    The lexicon becomes word -> (language -> out) once, each text is tokenized
    and joined once, and the languages fan out after the lookup.
    """
    by_word = lexicon.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct(lang_col, "out"))).alias("out"))
    g = fanout(_looked_up(df, key, text_col, by_word), key, langs, lang_col)
    # the row's language is a column: read it once per element, as an attribute
    words = F.transform("__t", lambda x: F.coalesce(F.element_at(x["o"], F.col(lang_col)), x["word"]))
    return g.select(key, lang_col, F.array_join(words, " ").alias(out))


def fanout(df: DataFrame, key: str, langs: Sequence[str], lang_col: str = "tgt_lang") -> DataFrame:
    """B2: one row per (row, target language); long form, one pass."""
    return df.withColumn(lang_col, F.explode(F.array(*[F.lit(x) for x in langs])))


@dataclass
class PyModel:
    """A model slot: name (path), batch size, and a batch function."""

    name: str
    batch_size: int
    fn: Callable[[pd.Series, str], pd.Series]


def _run_batch(model: PyModel, texts: pd.Series, target: str) -> list[tuple[str | None, str, str | None]]:
    """(hyp, status, error) per text; a failing batch is split until single rows fail."""
    try:
        return [(h, "ok", None) for h in model.fn(texts, target)]
    except Exception as ex:  # noqa: BLE001 - the failure is recorded with its row
        if len(texts) == 1:
            return [(None, "error", f"{type(ex).__name__}: {ex}")]
    half = len(texts) // 2
    return _run_batch(model, texts.iloc[:half], target) + _run_batch(model, texts.iloc[half:], target)


def _run_models(models: Sequence[PyModel], text_col: str, target_col: str | None, default_target: str):
    by_name = {m.name: m for m in models}

    def run(batches):
        for pdf in batches:
            done = pd.DataFrame(index=pdf.index, columns=["hyp", "status", "error"], dtype=object)
            targets = pdf[target_col] if target_col else pd.Series([default_target] * len(pdf), index=pdf.index)
            for (name, tgt), idx in pdf.groupby([pdf["model"], targets]).groups.items():
                m = by_name[name]
                for start in range(0, len(idx), m.batch_size):
                    chunk = idx[start : start + m.batch_size]
                    rows = _run_batch(m, pdf.loc[chunk, text_col].fillna(""), tgt)
                    done.loc[chunk] = pd.DataFrame(rows, index=chunk, columns=done.columns, dtype=object)
            yield pdf.drop(columns=[text_col]).assign(**{c: done[c].where(done[c].notna(), None) for c in done.columns})

    return run


def translate_models(
    df: DataFrame, key: str, text_col: str, models: Sequence[PyModel], target: str = "ary_Arab", target_col: str | None = None
) -> DataFrame:
    """Every row through every model -> (key, [target], model, hyp, status, error).

    Rows are fanned out to models by ``explode`` of the model list (no join),
    then one ``mapInPandas`` pass calls each model on Arrow batches.
    """
    cols = [key] + ([target_col] if target_col else [])
    x = df.select(*cols, F.col(text_col)).withColumn("model", F.explode(F.array(*[F.lit(m.name) for m in models])))
    schema = ", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in x.schema.fields if f.name != text_col]
        + ["hyp string", "status string", "error string"]
    )
    return x.mapInPandas(_run_models(models, text_col, target_col, target), schema)


def models_wide(long: DataFrame, key: str, models: Sequence[PyModel], prefix: str = "translation_") -> DataFrame:
    """B1: one output column per model (label = last path segment)."""
    aggs = [F.max(F.when(F.col("model") == m.name, F.col("hyp"))).alias(prefix + m.name.split("/")[-1]) for m in models]
    return long.groupBy(key).agg(*aggs)


def translate_progressive(
    df: DataFrame, key: str, text_col: str, model: PyModel, langs: Sequence[str], path: str, attempt: int
) -> None:
    """Per language, translate only rows not yet ``ok`` in the sink and
    append them as partition (tgt_lang, attempt); a rerun resumes where the
    last one stopped, so a failed language never loses finished work."""
    spark = df.sparkSession
    for lang in langs:  # bounded list of target languages; each is a distributed job
        todo = df
        if path_exists(spark, path):  # any failure to read what is there is raised, not taken for "nothing yet"
            done = spark.read.parquet(path).filter((F.col("tgt_lang") == lang) & (F.col("status") == "ok")).select(key)
            todo = df.join(done, key, "left_anti")
        out = translate_models(todo.withColumn("tgt_lang", F.lit(lang)), key, text_col, [model], target_col="tgt_lang")
        # append: each (language, attempt) is a new partition, earlier ones stay
        out.withColumn("attempt", F.lit(attempt)).write.mode("append").partitionBy("tgt_lang", "attempt").parquet(path)


def latest_status(spark, path: str, key: str) -> DataFrame:
    """Final state of a progressive sink: one row per (key, language), best status wins."""
    df = spark.read.parquet(path)
    rank = F.struct((F.col("status") == "ok").cast("int").alias("ok"), F.col("attempt"))
    return df.groupBy(key, "tgt_lang").agg(F.max_by(F.struct("hyp", "status", "attempt"), rank).alias("s")).select(
        key, "tgt_lang", "s.hyp", "s.status", "s.attempt"
    )
