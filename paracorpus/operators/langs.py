"""Language dimension, usable-language filters and random pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paracorpus.functions.rand import hash52
from paracorpus.functions.text import is_blank

# Language name -> code, per profile, in the reference's order.
# "train": the 14-language any-to-any map (arabic -> ara_Arab).
LANG_CODES_TRAIN = [
    ("english", "eng_Latn"), ("ary_Arab", "ary_Arab"), ("arabic", "ara_Arab"), ("french", "fra_Latn"),
    ("german", "deu_Latn"), ("spanish", "spa_Latn"), ("russian", "rus_Cyrl"), ("chinese_traditional", "zho_Hant"),
    ("japanese", "jpn_Jpan"), ("korean", "kor_Hang"), ("greek", "ell_Grek"), ("italian", "ita_Latn"),
    ("turkish", "tur_Latn"), ("hindi", "hin_Deva"),
]
# "nllb": the 11-language fan-out map (arabic -> arb_Arab).
LANG_CODES_NLLB = [
    ("french", "fra_Latn"), ("german", "deu_Latn"), ("spanish", "spa_Latn"), ("arabic", "arb_Arab"),
    ("portuguese", "por_Latn"), ("russian", "rus_Cyrl"), ("chinese_traditional", "zho_Hant"), ("greek", "ell_Grek"),
    ("turkish", "tur_Latn"), ("hindi", "hin_Deva"), ("hebrew", "heb_Hebr"),
]
# "google": the 13 active entries of the online-service map (some are placeholders).
LANG_CODES_GOOGLE = [
    ("arabic", "arb_Arab"), ("french", "fra_Latn"), ("german", "deu_Latn"), ("spanish", "spa_Latn"),
    ("russian", "rus_Cyrl"), ("chinese_traditional", "zho_Hant"), ("japanese", "japanese"), ("korean", "korean"),
    ("greek", "ell_Grek"), ("italian", "italian"), ("turkish", "tur_Latn"), ("wolof", "wolof"), ("hindi", "hin_Deva"),
]
PROFILES = {"train": LANG_CODES_TRAIN, "nllb": LANG_CODES_NLLB, "google": LANG_CODES_GOOGLE}


def lang_dim_rows() -> list[tuple[str, str, str]]:
    return [(lang, code, prof) for prof, rows in PROFILES.items() for lang, code in rows]


def lang_dim(spark: SparkSession) -> DataFrame:
    """One (lang, code, profile) dimension for the three disagreeing maps."""
    return spark.createDataFrame(lang_dim_rows(), "lang string, code string, profile string")


def lang_code_map(profile: str = "train") -> Column:
    """J3 as an expression: a literal map, no join needed for a bounded dictionary."""
    rows = PROFILES[profile]
    return F.create_map(*[F.lit(x) for kv in rows for x in kv])


def lang_code_lookup(df: DataFrame, lang_col: str, profile: str = "train", out: str = "code") -> DataFrame:
    """``lang_to_code[lang]`` (unknown language -> null)."""
    return df.withColumn(out, F.element_at(lang_code_map(profile), F.col(lang_col)))


def _present(c: Column, rule: str) -> Column:
    if rule == "strip":  # not text.strip() == ""
        return F.coalesce(~is_blank(c), F.lit(False))
    if rule == "truthy":  # example.get(lang) is truthy: non-null and non-empty
        return F.coalesce(F.length(c) > 0, F.lit(False))
    raise ValueError(rule)


def available_langs(langs: Sequence[str], rule: str = "strip", columns: dict[str, str] | None = None) -> Column:
    """Array of usable language names, in ``langs`` order."""
    columns = columns or {}
    items = [F.when(_present(F.col(columns.get(lang, lang)), rule), F.lit(lang)) for lang in langs]
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def filter_min_langs(df: DataFrame, langs: Sequence[str], rule: str = "strip", min_langs: int = 2) -> DataFrame:
    """keep rows with at least ``min_langs`` usable languages."""
    return df.filter(F.size(available_langs(langs, rule)) >= min_langs)


def random_lang_pair(
    df: DataFrame, langs: Sequence[str], seed: int, key: str = "row_id", rule: str = "strip"
) -> DataFrame:
    """``random.sample(valid, 2)`` per row, repeatable: usable languages
    ordered by hash(key, seed, lang); the first two are (src, tgt).  Rows with
    fewer than two usable languages are dropped."""
    av = available_langs(langs, rule)
    ranked = F.transform(
        F.array_sort(F.transform(av, lambda x: F.struct(hash52(F.col(key), str(seed), x).alias("h"), x.alias("lang")))),
        lambda s: s["lang"],
    )
    out = df.withColumn("__langs", ranked).filter(F.size("__langs") >= 2)
    return out.withColumn("src_lang", F.col("__langs")[0]).withColumn("tgt_lang", F.col("__langs")[1]).drop("__langs")


def pick_text(lang_col: str, langs: Sequence[str]) -> Column:
    """Text of the language named in ``lang_col`` (a CASE over the known columns)."""
    expr = None
    for lang in langs:
        expr = (F.when if expr is None else expr.when)(F.col(lang_col) == F.lit(lang), F.col(lang))
    return expr
