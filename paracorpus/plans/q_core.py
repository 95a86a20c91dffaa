"""Queries for projections, filters, aggregations, set operations and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.fixtures import with_ctes
from paracorpus.functions import text as tx
from paracorpus.functions.translit import transliterate, transliterate_sql
from paracorpus.operators import chat, columns, encode, filters, langs, merge, stats
from paracorpus.plans import sqltext as sq
from paracorpus.plans.base import (
    MAX_TOKENS, PAIRS_TOK_SQL, PINNED_SOURCE, WIDE_LANGS, _pairs_tok, register,
)

# ------------------------------------------------------------------ 2.2 projections


@register("select_reorder", with_ctes("pairs", body="SELECT dataset_source, darija_ar, english, row_id FROM pairs"))
def q_select_reorder(spark, sf):
    return columns.select_reorder(fx.pairs(spark, sf), ["dataset_source", "darija_ar", "english", "row_id"])


@register("drop_columns", with_ctes("pairs", body="SELECT row_id, darija_ar, dataset_source FROM pairs"))
def q_drop_columns(spark, sf):
    return columns.drop_columns(fx.pairs(spark, sf), ["english"])


@register(
    "rename_columns",
    with_ctes("pairs", body="SELECT row_id, english, darija_ar AS ary_Arab, dataset_source AS source FROM pairs"),
)
def q_rename_columns(spark, sf):
    return columns.rename_columns(fx.pairs(spark, sf), {"darija_ar": "ary_Arab", "dataset_source": "source"})


@register(
    "rename_positional",
    with_ctes("pairs", body="SELECT row_id AS id, english AS en, darija_ar AS ar, dataset_source AS src FROM pairs"),
)
def q_rename_positional(spark, sf):
    return columns.rename_positional(fx.pairs(spark, sf), ["id", "en", "ar", "src"])


@register(
    "constant_columns",
    with_ctes(
        "pairs",
        body="SELECT row_id, darija_ar, '' AS darija_Latn, CAST(NULL AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS role, "
        "'{}' AS metadata, 'corpus' AS dataset_source FROM pairs",
    ),
)
def q_constant_columns(spark, sf):
    df = fx.pairs(spark, sf).select("row_id", "darija_ar")
    return columns.constant_columns(
        df, {"darija_Latn": "", "id": None, "role": None, "metadata": str({}), "dataset_source": "corpus"}
    )


@register(
    "coalesce_source",
    with_ctes(
        "pairs", "prior_pairs",
        body="SELECT row_id, coalesce(dataset_source, dataset_name) AS dataset_source FROM "
        "(SELECT row_id, dataset_source, NULL AS dataset_name FROM pairs UNION ALL "
        "SELECT row_id, NULL, dataset_name FROM prior_pairs) u",
    ),
)
def q_coalesce_source(spark, sf):
    u = merge.union_by_name([fx.pairs(spark, sf), fx.prior_pairs(spark, sf)])
    return columns.coalesce_columns(u, "dataset_source", "dataset_name").select("row_id", "dataset_source")


_ALIGN_SQL = with_ctes(
    "pairs", "bench",
    body="SELECT 'train' AS split, row_id, english, darija_ar, dataset_source, '' AS topic, '' AS subtopic, '' AS arabizi, "
    "'' AS darija, '' AS annotator_dialect FROM pairs UNION ALL "
    "SELECT 'test', row_id, english, '', '', topic, subtopic, arabizi, darija, annotator_dialect FROM bench",
)


@register("align_columns", _ALIGN_SQL)
def q_align_columns(spark, sf):
    aligned = columns.align_columns({"train": fx.pairs(spark, sf), "test": fx.bench(spark, sf)})
    return merge.split_dict(aligned)


@register(
    "append_column",
    with_ctes("pairs", body=f"SELECT row_id, dataset_source, {sq.token_count('darija_ar')} AS darija_tokens FROM pairs"),
)
def q_append_column(spark, sf):
    p = fx.pairs(spark, sf)
    values = p.select("row_id", encode.token_count(F.col("darija_ar")).alias("darija_tokens"))
    return columns.append_column(p.select("row_id", "dataset_source"), values, "row_id")


@register(
    "extract_struct_field",
    "SELECT conv_id, list(text ORDER BY turn) AS texts FROM conversations GROUP BY conv_id",
)
def q_extract_struct_field(spark, sf):
    c = fx.table(spark, sf, "conversations")
    outs = c.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", F.col("text").alias("translation_text")))).alias("outputs")
    )
    return columns.extract_struct_field(outs, "outputs", "translation_text", "texts").select("conv_id", "texts")


# ------------------------------------------------------------------ 2.3 filters


@register("dropna_any", with_ctes("pairs", body="SELECT * FROM pairs WHERE english IS NOT NULL AND darija_ar IS NOT NULL "
                                  "AND dataset_source IS NOT NULL AND row_id IS NOT NULL"))
def q_dropna_any(spark, sf):
    return filters.dropna_any(fx.pairs(spark, sf))


@register("dropna_subset", with_ctes("pairs", body="SELECT * FROM pairs WHERE english IS NOT NULL AND darija_ar IS NOT NULL"))
def q_dropna_subset(spark, sf):
    return filters.dropna_subset(fx.pairs(spark, sf), ["english", "darija_ar"])


@register("filter_neq_nullsafe", with_ctes("pairs", body="SELECT * FROM pairs WHERE dataset_source IS DISTINCT FROM 'src0'"))
def q_filter_neq(spark, sf):
    return filters.filter_neq(fx.pairs(spark, sf), "dataset_source", "src0")


@register(
    "filter_bad_sources",
    with_ctes("pairs", "bad_sources", body="SELECT * FROM pairs p WHERE NOT EXISTS "
              "(SELECT 1 FROM bad_sources b WHERE b.source = p.dataset_source)"),
)
def q_filter_bad_sources(spark, sf):
    return filters.filter_bad_sources(fx.pairs(spark, sf), fx.bad_sources(spark))


@register(
    "filter_max_tokens",
    with_ctes("pairs", body=f"SELECT * FROM ({PAIRS_TOK_SQL}) t WHERE darija_tokens < {MAX_TOKENS} "
              f"AND dataset_source IS DISTINCT FROM '{PINNED_SOURCE}'"),
)
def q_filter_max_tokens(spark, sf):
    return filters.filter_max_tokens(_pairs_tok(spark, sf), "darija_tokens", MAX_TOKENS, "dataset_source", PINNED_SOURCE)


@register("filter_eq", with_ctes("pairs", body=f"SELECT * FROM pairs WHERE dataset_source = '{PINNED_SOURCE}'"))
def q_filter_eq(spark, sf):
    return filters.filter_eq(fx.pairs(spark, sf), "dataset_source", PINNED_SOURCE)


@register(
    "filter_code",
    with_ctes("pairs", body=f"SELECT * FROM pairs WHERE NOT coalesce({sq.contains_code('darija_ar')}, false)"),
)
def q_filter_code(spark, sf):
    return filters.filter_code(fx.pairs(spark, sf), "darija_ar")


@register(
    "filter_blank_pairs",
    with_ctes("pairs", body=f"SELECT * FROM pairs WHERE NOT coalesce({sq.is_blank('english')}, true) "
              f"AND NOT coalesce({sq.is_blank('darija_ar')}, true)"),
)
def q_filter_blank_pairs(spark, sf):
    return filters.filter_blank_pairs(fx.pairs(spark, sf), "english", "darija_ar")


def _n_present_sql(rule: str) -> str:
    parts = []
    for lang in WIDE_LANGS:
        if rule == "strip":
            parts.append(f"CASE WHEN coalesce(NOT {sq.is_blank(lang)}, false) THEN 1 ELSE 0 END")
        else:
            parts.append(f"CASE WHEN coalesce(length({lang}) > 0, false) THEN 1 ELSE 0 END")
    return " + ".join(parts)


@register("filter_min_langs", with_ctes("wide", body=f"SELECT row_id FROM wide WHERE {_n_present_sql('strip')} >= 2"))
def q_filter_min_langs(spark, sf):
    return langs.filter_min_langs(fx.wide(spark, sf), WIDE_LANGS, "strip").select("row_id")


# ------------------------------------------------------------------ 2.5 aggregations


@register(
    "null_counts",
    with_ctes("pairs", body="SELECT * FROM (SELECT 'row_id' AS \"column\", count(*) FILTER (WHERE row_id IS NULL) AS n_null FROM pairs "
              "UNION ALL SELECT 'english', count(*) FILTER (WHERE english IS NULL) FROM pairs "
              "UNION ALL SELECT 'darija_ar', count(*) FILTER (WHERE darija_ar IS NULL) FROM pairs "
              "UNION ALL SELECT 'dataset_source', count(*) FILTER (WHERE dataset_source IS NULL) FROM pairs) x"),
)
def q_null_counts(spark, sf):
    return stats.null_counts(fx.pairs(spark, sf))


@register(
    "value_counts",
    with_ctes("pairs", body="SELECT dataset_source, count(*) AS count FROM pairs WHERE dataset_source IS NOT NULL "
              "GROUP BY dataset_source"),
)
def q_value_counts(spark, sf):
    return stats.value_counts(fx.pairs(spark, sf), "dataset_source")


@register(
    "total_tokens",
    with_ctes("pairs", body=f"SELECT dataset_source, count(*) AS n_rows, sum(darija_tokens) AS total_tokens "
              f"FROM ({PAIRS_TOK_SQL}) t GROUP BY dataset_source"),
)
def q_total_tokens(spark, sf):
    return stats.total_tokens(_pairs_tok(spark, sf), "darija_tokens", ["dataset_source"])


@register(
    "token_stats",
    with_ctes("pairs", body=f"SELECT n, round_even(mean, 4) AS mean, round_even(std, 4) AS std, "
              f"round_even(mean + std, 4) AS upper, CASE WHEN mean - std > 0 THEN round_even(mean - std, 4) END AS lower "
              f"FROM (SELECT count(darija_tokens) AS n, avg(darija_tokens) AS mean, stddev_pop(darija_tokens) AS std "
              f"FROM ({PAIRS_TOK_SQL}) t) s"),
)
def q_token_stats(spark, sf):
    return stats.token_stats(_pairs_tok(spark, sf), "darija_tokens")


_HIST_SQL = with_ctes(
    "pairs",
    body=f"""SELECT b.bin,
      round_even(lo + (b.bin - 1) * (hi - lo) / 50.0, 4) AS bin_lo, round_even(lo + b.bin * (hi - lo) / 50.0, 4) AS bin_hi,
      coalesce(c.cnt, 0) AS count
    FROM (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi
          FROM (SELECT min(darija_tokens)::DOUBLE AS mn, max(darija_tokens)::DOUBLE AS mx FROM ({PAIRS_TOK_SQL}) t) m) r
    CROSS JOIN (SELECT range::INT AS bin FROM range(1, 51)) b
    LEFT JOIN (SELECT least(CAST(floor((darija_tokens::DOUBLE - lo) * 50.0 / (hi - lo)) AS INT), 49) + 1 AS bin, count(*) AS cnt
               FROM ({PAIRS_TOK_SQL}) t,
                    (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi
                     FROM (SELECT min(darija_tokens)::DOUBLE AS mn, max(darija_tokens)::DOUBLE AS mx FROM ({PAIRS_TOK_SQL}) t2) m2) r2
               WHERE darija_tokens IS NOT NULL GROUP BY 1) c ON c.bin = b.bin""",
)


@register("token_histogram", _HIST_SQL)
def q_token_histogram(spark, sf):
    return stats.token_histogram(_pairs_tok(spark, sf), "darija_tokens")


@register("row_count", with_ctes("pairs", body="SELECT count(*) AS n_rows FROM pairs"))
def q_row_count(spark, sf):
    return stats.row_count(fx.pairs(spark, sf))


@register(
    "best_checkpoint",
    with_ctes("eval_log", body="SELECT run_id, step AS best_step, bleu AS best_bleu FROM (SELECT *, row_number() OVER "
              "(PARTITION BY run_id ORDER BY bleu DESC, step ASC) AS rn FROM eval_log WHERE bleu IS NOT NULL) t WHERE rn = 1"),
)
def q_best_checkpoint(spark, sf):
    return stats.best_checkpoint(fx.eval_log(spark, sf))


# ------------------------------------------------------------------ 2.8 set operations and dedup


@register(
    "union_by_name",
    with_ctes("pairs", "prior_pairs", body="SELECT row_id, english, darija_ar, dataset_source, NULL::VARCHAR AS dataset_name FROM pairs "
              "UNION ALL SELECT row_id, english, darija_ar, NULL, dataset_name FROM prior_pairs"),
)
def q_union_by_name(spark, sf):
    return merge.union_by_name([fx.pairs(spark, sf), fx.prior_pairs(spark, sf)])


@register(
    "union_strict",
    with_ctes("pairs", "prior_pairs", body="SELECT row_id, english, darija_ar, dataset_source FROM pairs UNION ALL "
              "SELECT row_id, english, darija_ar, dataset_name FROM prior_pairs"),
)
def q_union_strict(spark, sf):
    prior = fx.prior_pairs(spark, sf).withColumnRenamed("dataset_name", "dataset_source")
    return merge.union_by_name([fx.pairs(spark, sf), prior], allow_missing=False)


@register(
    "pretrain_text_union",
    "SELECT text, 'documents' AS dataset_source, '{}' AS metadata FROM documents UNION ALL "
    "SELECT text, 'conversations', '{}' FROM conversations UNION ALL SELECT text, 'benchmark', '{}' FROM benchmark",
)
def q_pretrain_text_union(spark, sf):
    parts = [
        fx.table(spark, sf, t).select("text").withColumn("dataset_source", F.lit(t))
        for t in ("documents", "conversations", "benchmark")
    ]
    return merge.union_by_name(parts, allow_missing=False).withColumn("metadata", F.lit(str({})))


_DEDUP_SQL = with_ctes(
    "pairs",
    body="SELECT row_id, dataset_source FROM (SELECT *, row_number() OVER (PARTITION BY english, darija_ar ORDER BY row_id) AS rn "
    "FROM pairs) t WHERE rn = 1",
)


@register("dedup_keep_first", _DEDUP_SQL)
def q_dedup_keep_first(spark, sf):
    return merge.dedup_keep_first(fx.pairs(spark, sf), ["english", "darija_ar"]).select("row_id", "dataset_source")


@register(
    "split_dict",
    with_ctes("pairs", "bench", body="SELECT 'train' AS split, row_id, english FROM pairs UNION ALL "
              "SELECT 'test', row_id, english FROM bench"),
)
def q_split_dict(spark, sf):
    return merge.split_dict(
        {"train": fx.pairs(spark, sf).select("row_id", "english"), "test": fx.bench(spark, sf).select("row_id", "english")}
    )


# ------------------------------------------------------------------ 2.9 scalar text functions


@register("clean_unk", with_ctes("pairs", body=f"SELECT row_id, {sq.clean_unk('darija_ar')} AS darija_ar FROM pairs"))
def q_clean_unk(spark, sf):
    return fx.pairs(spark, sf).select("row_id", tx.clean_unk(F.col("darija_ar")).alias("darija_ar"))


@register("transliterate", with_ctes("pairs", body=f"SELECT row_id, {transliterate_sql('darija_ar')} AS darija_latn FROM pairs"))
def q_transliterate(spark, sf):
    return fx.pairs(spark, sf).select("row_id", transliterate(F.col("darija_ar")).alias("darija_latn"))


@register("strip_punct", with_ctes("pairs", body=f"SELECT row_id, {sq.strip_punct('english')} AS english FROM pairs"))
def q_strip_punct(spark, sf):
    return fx.pairs(spark, sf).select("row_id", tx.strip_punct(F.col("english")).alias("english"))


@register("trim_wrap", with_ctes("bench", body=f"SELECT row_id, {sq.ustrip('english')} AS pred, [{sq.ustrip('darija')}] AS refs FROM bench"))
def q_trim_wrap(spark, sf):
    b = fx.bench(spark, sf)
    return b.select("row_id", tx.ustrip(F.col("english")).alias("pred"), F.array(tx.ustrip(F.col("darija"))).alias("refs"))


_RENDERED_SQL = (
    "SELECT conv_id, count(*) AS n_turns, string_agg("
    + sq.render_message("role", "text")
    + ", '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id"
)


@register("chat_render_turns", _RENDERED_SQL)
def q_chat_render_turns(spark, sf):
    return chat.render_turns(fx.table(spark, sf, "conversations"))


@register(
    "extract_assistant",
    f"SELECT conv_id, {sq.extract_assistant('text')} AS translation FROM ({_RENDERED_SQL}) r",
)
def q_extract_assistant(spark, sf):
    r = chat.render_turns(fx.table(spark, sf, "conversations"))
    return r.select("conv_id", tx.extract_assistant(F.col("text")).alias("translation"))


@register("clean_markers", f"SELECT conv_id, {sq.clean_markers('text')} AS text FROM ({_RENDERED_SQL}) r")
def q_clean_markers(spark, sf):
    r = chat.render_turns(fx.table(spark, sf, "conversations"))
    return r.select("conv_id", tx.clean_markers(F.col("text")).alias("text"))


@register("stringify_nulls", with_ctes("pairs", body="SELECT row_id, coalesce(CAST(dataset_source AS VARCHAR), 'None') AS source_str FROM pairs"))
def q_stringify(spark, sf):
    return fx.pairs(spark, sf).select("row_id", tx.stringify(F.col("dataset_source")).alias("source_str"))


@register(
    "join_sources",
    with_ctes("pairs", "bad_sources", body="SELECT array_to_string(list_sort(list(DISTINCT dataset_source)), ' , ') AS removed_sources "
              "FROM pairs WHERE dataset_source IN (SELECT source FROM bad_sources)"),
)
def q_join_sources(spark, sf):
    p = fx.pairs(spark, sf)
    removed = p.join(F.broadcast(fx.bad_sources(spark)), p.dataset_source == F.col("source"), "left_semi")
    return removed.agg(F.array_join(F.sort_array(F.collect_set("dataset_source")), " , ").alias("removed_sources"))
