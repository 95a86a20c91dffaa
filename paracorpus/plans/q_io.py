"""Queries for batch translation backends and split/config/progressive sinks.

Sink queries write below the shared checkpoint folder (a fresh directory per
call) and read the result back, so they exercise the real write path.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.fixtures import ARABIC_LETTERS, LATIN_LETTERS, with_ctes
from paracorpus.operators import encode, translate
from paracorpus.operators.langs import LANG_CODES_NLLB
from paracorpus.operators.translate import PyModel
from paracorpus.plans import sqltext as sq
from paracorpus.plans.base import PAIRS_TOK_SQL, _pairs_tok, register
from paracorpus.session import scratch_path
from paracorpus.sources import dataset as ds

NLLB_CODES = [c for _, c in LANG_CODES_NLLB]
_TABLE = str.maketrans(LATIN_LETTERS, ARABIC_LETTERS)


def char_model(texts: pd.Series, target: str) -> pd.Series:
    """Stand-in model: letter substitution into Arabic script."""
    return texts.map(lambda t: t.translate(_TABLE))


def char_model_lower(texts: pd.Series, target: str) -> pd.Series:
    return texts.map(lambda t: t.lower().translate(_TABLE))


def half_model(texts: pd.Series, target: str) -> pd.Series:
    """Fails a whole batch for any text of odd length."""
    if (texts.str.len() % 2).any():
        raise ValueError("text of odd length")
    return char_model(texts, target)


HALF_MODEL = PyModel("org/half-v1", 16, half_model)
BENCH_PY_MODELS = [PyModel("org/char-v1", 16, char_model), PyModel("org/char-v2", 64, char_model_lower)]
A, B = f"'{LATIN_LETTERS}'", f"'{ARABIC_LETTERS}'"


@register(
    "translate_models",
    f"SELECT item_id AS row_id, translate(text, {A}, {B}) AS \"translation_char-v1\", "
    f"translate(lower(text), {A}, {B}) AS \"translation_char-v2\" FROM benchmark",
)
def q_translate_models(spark, sf):
    b = fx.bench(spark, sf)
    long = translate.translate_models(b, "row_id", "english", BENCH_PY_MODELS)
    return translate.models_wide(long, "row_id", BENCH_PY_MODELS)


def lexicon_multi(spark, sf):
    """Per-language lexicon: each target code gets its own word outputs."""
    lex = fx.lexicon(spark, sf)
    return lex.withColumn("tgt_lang", F.explode(F.array(*[F.lit(c) for c in NLLB_CODES]))).withColumn(
        "out", F.concat(F.col("tgt_lang"), F.lit(":"), F.col("out"))
    )


_FANOUT_SQL = with_ctes(
    "lexicon",
    body=f""", langs AS (SELECT unnest([{", ".join(repr(c) for c in NLLB_CODES)}]) AS tgt_lang),
toks AS (SELECT item_id AS row_id, unnest(l) AS word, generate_subscripts(l, 1) AS pos
         FROM (SELECT item_id, {sq.tokens('text')} AS l FROM benchmark) b)
SELECT b.item_id AS row_id, g.tgt_lang, coalesce(x.translation, '') AS translation
FROM benchmark b CROSS JOIN langs g LEFT JOIN (
  SELECT t.row_id, g2.tgt_lang, string_agg(coalesce(g2.tgt_lang || ':' || x.out, t.word), ' ' ORDER BY t.pos) AS translation
  FROM toks t CROSS JOIN langs g2 LEFT JOIN lexicon x ON x.word = t.word GROUP BY t.row_id, g2.tgt_lang) x
ON x.row_id = b.item_id AND x.tgt_lang = g.tgt_lang""",
)


@register("translate_fanout", _FANOUT_SQL)
def q_translate_fanout(spark, sf):
    b = fx.bench(spark, sf).select("row_id", "english")
    return translate.lexicon_fanout(b, "row_id", "english", lexicon_multi(spark, sf), NLLB_CODES)


FLAKY_LANG = "deu_Latn"


def flaky_model(texts: pd.Series, target: str) -> pd.Series:
    if target == FLAKY_LANG:
        raise RuntimeError("backend unavailable")
    return char_model(texts, target)


def _progressive(spark, sf):
    path = scratch_path(spark, "fanout")
    b = fx.bench(spark, sf).select("row_id", "english")
    langs = NLLB_CODES
    translate.translate_progressive(b, "row_id", "english", PyModel("org/flaky", 32, flaky_model), langs, path, attempt=0)
    translate.translate_progressive(b, "row_id", "english", PyModel("org/char-v1", 32, char_model), langs, path, attempt=1)
    return path, langs


_ALL_LANGS = ", ".join(repr(c) for c in NLLB_CODES)


_HYP = f"translate(b.text, {A}, {B})"


@register(
    "fanout_checkpoint",
    f"""SELECT b.item_id AS row_id, g.tgt_lang, 0 AS attempt, CASE WHEN g.tgt_lang = '{FLAKY_LANG}' THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN g.tgt_lang <> '{FLAKY_LANG}' THEN {_HYP} END AS hyp
FROM benchmark b CROSS JOIN (SELECT unnest([{_ALL_LANGS}]) AS tgt_lang) g
UNION ALL SELECT b.item_id, '{FLAKY_LANG}', 1, 'ok', {_HYP} FROM benchmark b""",
)
def q_fanout_checkpoint(spark, sf):
    """Every row that the sink holds, failed ones too."""
    path, _ = _progressive(spark, sf)
    return spark.read.parquet(path).select("row_id", "tgt_lang", F.col("attempt").cast("int").alias("attempt"), "status", "hyp")


@register(
    "translate_retry_pending",
    f"""SELECT b.item_id AS row_id, g.tgt_lang, 'ok' AS status, CASE WHEN g.tgt_lang = '{FLAKY_LANG}' THEN 1 ELSE 0 END AS attempt, {_HYP} AS hyp
FROM benchmark b CROSS JOIN (SELECT unnest([{_ALL_LANGS}]) AS tgt_lang) g""",
)
def q_translate_retry_pending(spark, sf):
    """The last state of each row and language, with its translation."""
    path, _ = _progressive(spark, sf)
    st = translate.latest_status(spark, path, "row_id")
    return st.select("row_id", "tgt_lang", "status", F.col("attempt").cast("int").alias("attempt"), "hyp")


# ------------------------------------------------------------------ sinks and scans


def _test_rows(spark, sf):
    return fx.bench(spark, sf).select("row_id", "english", F.col("darija").alias("darija_ar")).withColumn(
        "darija_tokens", encode.token_count(F.col("darija_ar"))
    )


def _written(spark, sf):
    path = scratch_path(spark, "dataset")
    ds.write_dataset({"train": _pairs_tok(spark, sf), "test": _test_rows(spark, sf)}, path, "splits", tokens_col="darija_tokens")
    return path


_TEST_SQL = f"SELECT row_id, english, darija AS darija_ar, NULL::VARCHAR AS dataset_source, {sq.token_count('darija')} AS darija_tokens FROM bench"
_SPLITS_SQL = with_ctes("pairs", "bench", body=f"SELECT *, 'train' AS split FROM ({PAIRS_TOK_SQL}) t UNION ALL BY NAME SELECT *, 'test' AS split FROM ({_TEST_SQL}) u")


@register(
    "sink_roundtrip",
    with_ctes("pairs", "bench", body=f"SELECT 'splits' AS message, count(*) AS rows, sum(darija_tokens) AS tokens FROM "
              f"(SELECT darija_tokens FROM ({PAIRS_TOK_SQL}) t UNION ALL SELECT darija_tokens FROM ({_TEST_SQL}) u) v"),
)
def q_sink_roundtrip(spark, sf):
    """The commit note beside the written splits."""
    notes = spark.read.text(_written(spark, sf) + "_notes")
    return notes.select(F.from_json("value", "message string, rows long, tokens long").alias("n")).select("n.*")


@register("scan_all_splits", _SPLITS_SQL)
def q_scan_all_splits(spark, sf):
    return ds.read_all_splits(spark, _written(spark, sf))


@register("scan_split", with_ctes("pairs", body=PAIRS_TOK_SQL))
def q_scan_split(spark, sf):
    return ds.read_split(spark, _written(spark, sf), "train")


@register("scan_config", with_ctes("pairs", body=f"SELECT *, 'train' AS split FROM ({PAIRS_TOK_SQL}) t"))
def q_scan_config(spark, sf):
    return ds.read_config(spark, _two_configs(spark, sf), "train")


def _two_configs(spark, sf):
    """Two configs in one dataset; then one of them is written again."""
    path = scratch_path(spark, "configs")
    train = _pairs_tok(spark, sf).withColumn("split", F.lit("train")).withColumn("config", F.lit("train"))
    test = _test_rows(spark, sf).withColumn("split", F.lit("test")).withColumn("config", F.lit("test"))
    by = ("config", "split")
    ds.write_dataset(train.unionByName(test, allowMissingColumns=True), path, "both configs", by, "darija_tokens")
    again = test.withColumn("english", F.concat("english", F.lit(" again"))).withColumn("dataset_source", F.lit(None).cast("string"))
    ds.write_dataset(again, path, "test again", by, "darija_tokens")
    return path


@register(
    "sink_config_overwrite",
    with_ctes("pairs", "bench", body=f"SELECT *, 'train' AS config, 'train' AS split FROM ({PAIRS_TOK_SQL}) t UNION ALL BY NAME "
              f"SELECT row_id, concat(english, ' again') AS english, darija_ar, dataset_source, darija_tokens, 'test' AS config, 'test' AS split FROM ({_TEST_SQL}) u"),
)
def q_sink_config_overwrite(spark, sf):
    return ds.read_all_splits(spark, _two_configs(spark, sf))
