"""Corpus views derived from the driver's tables (FIXTURES.md section 2).

The driver tables have no nulls, Arabic script or ``<unk>`` markers, so the
views inject them by a fixed rule on the row key.  Injection only rewrites
values: every view keeps every row and every full text.  Each view exists
twice: as a Spark DataFrame builder and as a DuckDB CTE for the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paracorpus.functions.text import WS_CLASS

# The letter substitution that turns Latin prose into Arabic
# script (y -> shadda and u -> damma, so transliteration has real work).
LATIN_LETTERS = "abcdefghijklmnopqrstuvwxyz"
ARABIC_LETTERS = "ابچديفغهيجكلمنوپقرستُڤوخّز"

# Sources treated as bad (six entries, like the reference list).
BAD_SOURCES = ["src3", "src7", "src11", "src13", "src17", "src19"]

# Benchmark model labels used by the hypothesis/reference view.
BENCH_MODELS = ["org/m-v1.0", "org/m-v1.1", "org/m-v2.0", "org/m-empty"]

NOT_WS = WS_CLASS.replace("[", "[^", 1)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def to_arabic(c):
    return F.translate(c, LATIN_LETTERS, ARABIC_LETTERS)


def word_tokens(c, limit: int | None = None):
    """Whitespace tokens (Python ``split()``) as an array; at most the first ``limit``.

    The split stops there, and one pattern cuts the text once.
    """
    trimmed = F.regexp_replace(c, f"^{WS_CLASS}+", "")
    cut = F.split(trimmed, f"{WS_CLASS}+", -1 if limit is None else limit + 1)
    kept = cut if limit is None else F.slice(cut, 1, limit)
    return F.filter(kept, lambda t: t != F.lit(""))


def word_count(c):
    """Number of whitespace tokens, from one split (the text is named once: filters don't share subexpressions)."""
    return F.array_size(F.filter(F.split(c, f"{WS_CLASS}+", -1), lambda t: t != F.lit("")))


# ---------------------------------------------------------------- Spark side

def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    text, i = F.col("text"), F.col("doc_id")
    ar = to_arabic(F.coalesce(text, F.lit("")))
    before = F.when((i % 13 == 0) & (i % 11 != 0), F.lit("<unk>")).otherwise(F.lit(""))
    after = F.when(i % 11 == 0, F.lit(" <unk>")).when((i % 29 == 0) & (i % 13 != 0), F.lit(" return x;")).otherwise(F.lit(""))
    # whether a row is null is known without its text: filters don't translate it
    darija = (
        F.when(i % 17 == 0, F.lit(None).cast("string"))
        .when(i % 23 == 0, F.lit(""))
        .when(text.isNull(), F.lit(None).cast("string"))
        .otherwise(F.concat(before, ar, after))
    )
    source = F.when(i % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("source"))
    return d.select(
        i.alias("row_id"), F.col("text").alias("english"), darija.alias("darija_ar"), source.alias("dataset_source")
    )


def prior_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second source: the benchmark sentences, with ``dataset_name``."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(
        (F.col("item_id") + F.lit(1_000_000_000)).alias("row_id"),
        F.col("text").alias("english"),
        to_arabic(F.col("text")).alias("darija_ar"),
        F.lit("bench-v1").alias("dataset_name"),
    )


def bench(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    i = F.col("item_id")
    return b.select(
        i.alias("row_id"),
        F.concat(F.lit("topic"), (i % 5).cast("string")).alias("topic"),
        F.concat(F.lit("sub"), (i % 10).cast("string")).alias("subtopic"),
        F.lit("").alias("arabizi"),
        F.col("text").alias("english"),
        to_arabic(F.col("text")).alias("darija"),
        F.lit("d0").alias("annotator_dialect"),
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per position-within-language; languages side by side."""
    from paracorpus.operators.rowid import with_row_pos

    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    pos = with_row_pos(d.select("doc_id", "lang"), "doc_id", "pos", partition_cols="lang").select("doc_id", "pos")
    d = d.join(pos, "doc_id")
    rn = F.col("pos") + 1
    t = F.col("text")
    lang = F.col("lang")
    return d.groupBy(rn.cast("bigint").alias("row_id")).agg(
        F.max(F.when(lang == "en", t)).alias("english"),
        F.max(F.when((lang == "en") & (rn % 3 > 0), to_arabic(t))).alias("ary_Arab"),
        F.max(F.when(lang == "fr", F.when(rn % 7 == 0, F.lit("   ")).otherwise(t))).alias("french"),
        F.max(F.when(lang == "de", t)).alias("german"),
        F.max(F.when(lang == "es", t)).alias("spanish"),
    )


def hyp_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    m = F.col("model")
    t = F.col("text")
    hyp = (
        F.when(m == BENCH_MODELS[0], t)
        .when(m == BENCH_MODELS[1], F.replace(t, F.lit(" the "), F.lit(" ")))
        .when(m == BENCH_MODELS[2], F.replace(t, F.lit("e"), F.lit("a")))
        .otherwise(F.lit(""))
    )
    return b.select(
        F.col("item_id").alias("row_id"), F.explode(F.array(*[F.lit(x) for x in BENCH_MODELS])).alias("model"), t
    ).select("row_id", "model", hyp.alias("hyp"), t.alias("ref"))


def seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int") % 10
    lab = F.when(F.col("l_returnflag") == "N", F.lit(-100)).otherwise(q)
    g = li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", q.alias("q"), lab.alias("lab")))).alias("a")
    )
    return g.select(
        F.col("l_orderkey").alias("row_id"),
        F.transform("a", lambda x: x["q"]).alias("ids"),
        F.transform("a", lambda x: x["lab"]).alias("labels"),
    )


def eval_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("step"), F.col("value").alias("bleu"))


def bad_sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s,) for s in BAD_SOURCES], "source string")


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    w = b.select(F.explode(word_tokens(F.col("text"))).alias("word")).distinct()
    return w.select("word", to_arabic(F.col("word")).alias("out"))


# ---------------------------------------------------------------- DuckDB side

A = f"'{LATIN_LETTERS}'"
B = f"'{ARABIC_LETTERS}'"

CTE = {
    "pairs": f"""pairs AS (
  SELECT doc_id AS row_id, text AS english,
    CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 23 = 0 THEN ''
         WHEN doc_id % 11 = 0 THEN concat(ar, ' <unk>') WHEN doc_id % 13 = 0 THEN concat('<unk>', ar)
         WHEN doc_id % 29 = 0 THEN concat(ar, ' return x;') ELSE ar END AS darija_ar,
    CASE WHEN doc_id % 19 = 0 THEN NULL ELSE source END AS dataset_source
  FROM (SELECT *, translate(text, {A}, {B}) AS ar FROM documents) d)""",
    "prior_pairs": f"""prior_pairs AS (
  SELECT item_id + 1000000000 AS row_id, text AS english, translate(text, {A}, {B}) AS darija_ar,
         'bench-v1' AS dataset_name FROM benchmark)""",
    "bench": f"""bench AS (
  SELECT item_id AS row_id, concat('topic', cast(item_id % 5 AS VARCHAR)) AS topic,
    concat('sub', cast(item_id % 10 AS VARCHAR)) AS subtopic, '' AS arabizi, text AS english,
    translate(text, {A}, {B}) AS darija, 'd0' AS annotator_dialect FROM benchmark)""",
    "wide": f"""wide AS (
  SELECT cast(rn AS BIGINT) AS row_id, max(CASE WHEN lang = 'en' THEN t END) AS english,
    max(CASE WHEN lang = 'en' AND rn % 3 > 0 THEN translate(t, {A}, {B}) END) AS ary_Arab,
    max(CASE WHEN lang = 'fr' THEN CASE WHEN rn % 7 = 0 THEN '   ' ELSE t END END) AS french,
    max(CASE WHEN lang = 'de' THEN t END) AS german, max(CASE WHEN lang = 'es' THEN t END) AS spanish
  FROM (SELECT lang, text AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents) d
  GROUP BY rn)""",
    "hyp_ref": f"""hyp_ref AS (
  SELECT item_id AS row_id, model,
    CASE model WHEN '{BENCH_MODELS[0]}' THEN text WHEN '{BENCH_MODELS[1]}' THEN replace(text, ' the ', ' ')
               WHEN '{BENCH_MODELS[2]}' THEN replace(text, 'e', 'a') ELSE '' END AS hyp, text AS ref
  FROM benchmark CROSS JOIN (VALUES {", ".join(f"('{m}')" for m in BENCH_MODELS)}) AS m(model))""",
    "seqs": """seqs AS (
  SELECT l_orderkey AS row_id, list(q ORDER BY l_linenumber, l_partkey, l_suppkey, q, lab) AS ids,
         list(lab ORDER BY l_linenumber, l_partkey, l_suppkey, q, lab) AS labels
  FROM (SELECT *, cast(l_quantity AS INT) % 10 AS q,
          CASE WHEN l_returnflag = 'N' THEN -100 ELSE cast(l_quantity AS INT) % 10 END AS lab FROM lineitem) t
  GROUP BY l_orderkey)""",
    "eval_log": """eval_log AS (SELECT user_id AS run_id, event_id AS step, value AS bleu FROM events)""",
    "bad_sources": "bad_sources AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{s}')" for s in BAD_SOURCES)
    + ") AS b(source))",
    "lexicon": f"""lexicon AS (
  SELECT word, translate(word, {A}, {B}) AS out
  FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '{NOT_WS}+')) AS word FROM benchmark) w)""",
}


def with_ctes(*names: str, body: str) -> str:
    """``WITH`` clause holding the named views (in dependency order)."""
    return "WITH " + ",\n".join(CTE[n] for n in names) + "\n" + body
