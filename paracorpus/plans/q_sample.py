"""Queries for sorts, positions, sampling, splits, languages and chat rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.fixtures import with_ctes
from paracorpus.functions.rand import hash52_sql, uniform_sql
from paracorpus.operators import chat, encode, filters, langs, sample, stats
from paracorpus.operators.chat import SYSTEM_PROMPT
from paracorpus.operators.langs import LANG_CODES_TRAIN
from paracorpus.plans import sqltext as sq
from paracorpus.plans.base import (
    CHUNK, MAX_TOKENS, PAIRS_TOK_SQL, PINNED_SOURCE, SEED, SMALL_SAMPLE_N, WIDE_LANGS, _pairs_tok, register,
)

POS_SQL = "SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS row_pos FROM pairs"

# ------------------------------------------------------------------ 2.7 positions


@register("head_rows", with_ctes("pairs", body="SELECT * FROM pairs ORDER BY row_id LIMIT 5"))
def q_head_rows(spark, sf):
    return sample.head_rows(fx.pairs(spark, sf), 5)


@register("slice_rows", with_ctes("pairs", body=f"SELECT * FROM ({POS_SQL}) t WHERE row_pos >= 100 AND row_pos < 200"))
def q_slice_rows(spark, sf):
    return sample.slice_rows(fx.pairs(spark, sf), 100, 200)


@register("row_at", with_ctes("pairs", body=f"SELECT * FROM ({POS_SQL}) t WHERE row_pos = 100"))
def q_row_at(spark, sf):
    return sample.row_at(fx.pairs(spark, sf), 100)


@register(
    "seeded_shuffle",
    with_ctes("pairs", body=f"SELECT row_id, row_number() OVER (ORDER BY {hash52_sql('row_id', repr(str(SEED)))}, row_id) - 1 "
              "AS shuffle_pos FROM pairs"),
)
def q_seeded_shuffle(spark, sf):
    return sample.seeded_shuffle(fx.pairs(spark, sf), SEED).select("row_id", "shuffle_pos")


@register(
    "chunk_ids",
    with_ctes("pairs", body=f"SELECT row_id, CAST(floor(row_pos / {CHUNK}) AS BIGINT) AS chunk_id FROM ({POS_SQL}) t"),
)
def q_chunk_ids(spark, sf):
    return encode.chunk_ids(fx.pairs(spark, sf).select("row_id"), "row_id", CHUNK)


@register(
    "split_positional",
    with_ctes("pairs", body=f"SELECT row_id, CASE WHEN row_pos < CAST(trunc((SELECT count(*) FROM pairs)::DOUBLE * (1.0::DOUBLE - 0.1::DOUBLE)) AS BIGINT) "
              f"THEN 'train' ELSE 'val' END AS split FROM ({POS_SQL}) t"),
)
def q_split_positional(spark, sf):
    return sample.split_positional(fx.pairs(spark, sf), 0.1).select("row_id", "split")


@register(
    "split_random",
    with_ctes("pairs", body=f"SELECT row_id, CASE WHEN row_number() OVER (ORDER BY {hash52_sql('row_id', repr(str(SEED)))}, row_id) - 1 "
              f"< CAST(ceil((SELECT count(*) FROM pairs)::DOUBLE * 0.01::DOUBLE) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM pairs"),
)
def q_split_random(spark, sf):
    return sample.split_random(fx.pairs(spark, sf), 0.01, SEED).select("row_id", "split")


# ------------------------------------------------------------------ 2.7 weighted sampling

_POOL_SQL = f"SELECT * FROM ({PAIRS_TOK_SQL}) t WHERE darija_tokens < {MAX_TOKENS} AND dataset_source IS DISTINCT FROM '{PINNED_SOURCE}'"


def _sample_sql(weighting: str, n: int) -> str:
    u = uniform_sql("row_id", repr(str(SEED)))
    logw = "darija_tokens / (SELECT avg(darija_tokens) FROM pool)" if weighting == "exp" else "ln(darija_tokens)"
    return (
        f"SELECT row_id, draw_rank FROM (SELECT row_id, row_number() OVER (ORDER BY k, row_id) AS draw_rank FROM "
        f"(SELECT row_id, ln(-ln({u})) - {logw} AS k FROM pool) a) b WHERE draw_rank <= {n}"
    )


def _pool(spark, sf):
    return filters.filter_max_tokens(_pairs_tok(spark, sf), "darija_tokens", MAX_TOKENS, "dataset_source", PINNED_SOURCE)


@register("weighted_sample", with_ctes("pairs", body=f", pool AS ({_POOL_SQL}) {_sample_sql('exp', SMALL_SAMPLE_N)}"))
def q_weighted_sample(spark, sf):
    return sample.weighted_sample(_pool(spark, sf), SMALL_SAMPLE_N, SEED, "darija_tokens").select("row_id", "draw_rank")


@register("weighted_sample_linear", with_ctes("pairs", body=f", pool AS ({_POOL_SQL}) {_sample_sql('linear', SMALL_SAMPLE_N)}"))
def q_weighted_sample_linear(spark, sf):
    return sample.weighted_sample(_pool(spark, sf), SMALL_SAMPLE_N, SEED, "darija_tokens", weighting="linear").select(
        "row_id", "draw_rank"
    )


@register(
    "sample_with_pinned_source",
    with_ctes("pairs", body=f", pool AS ({_POOL_SQL}) {_sample_sql('exp', SMALL_SAMPLE_N)} UNION ALL "
              f"SELECT row_id, NULL FROM pairs WHERE dataset_source = '{PINNED_SOURCE}'"),
)
def q_sample_with_pinned(spark, sf):
    df = _pairs_tok(spark, sf)
    return sample.sample_with_pinned_source(
        df, SMALL_SAMPLE_N, SEED, "darija_tokens", "dataset_source", PINNED_SOURCE, MAX_TOKENS
    ).select("row_id", "draw_rank")


@register(
    "gather_by_index",
    with_ctes("pairs", body=f", pool AS ({_POOL_SQL}), s AS ({_sample_sql('exp', SMALL_SAMPLE_N)}) "
              "SELECT p.row_id, s.draw_rank, p.english, p.dataset_source FROM pairs p JOIN s ON s.row_id = p.row_id"),
)
def q_gather_by_index(spark, sf):
    drawn = sample.weighted_sample(_pool(spark, sf), SMALL_SAMPLE_N, SEED, "darija_tokens").select("row_id", "draw_rank")
    src = fx.pairs(spark, sf).select("row_id", "english", "dataset_source")
    return sample.gather_by_index(src, drawn).select("row_id", "draw_rank", "english", "dataset_source")


@register(
    "index_spread",
    with_ctes("pairs", body=f", pool AS ({_POOL_SQL}), s AS ({_sample_sql('exp', SMALL_SAMPLE_N)}), "
              "g AS (SELECT row_id - lag(row_id) OVER (ORDER BY row_id) AS gap FROM s) "
              "SELECT count(gap) AS n_gaps, round_even(avg(gap), 4) AS mean_gap, min(gap) AS min_gap, max(gap) AS max_gap, "
              "count(*) FILTER (WHERE gap = 1) AS consecutive, "
              "round_even(100.0::DOUBLE * count(*) FILTER (WHERE gap = 1) / count(gap), 1) AS pct_consecutive FROM g"),
)
def q_index_spread(spark, sf):
    s = sample.weighted_sample(_pool(spark, sf), SMALL_SAMPLE_N, SEED, "darija_tokens")
    return stats.index_spread(s, "row_id")


# ------------------------------------------------------------------ 2.10 languages


def _present_sql(col: str, rule: str) -> str:
    if rule == "strip":
        return f"coalesce(NOT {sq.is_blank(col)}, false)"
    return f"coalesce(length({col}) > 0, false)"


def _langs_list_sql(rule: str, hashed: bool) -> str:
    items = []
    for lang in WIDE_LANGS:
        val = f"{{'h': {hash52_sql('row_id', repr(str(SEED)), repr(lang))}, 'lang': '{lang}'}}" if hashed else f"'{lang}'"
        items.append(f"CASE WHEN {_present_sql(lang, rule)} THEN {val} END")
    lst = f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"
    return f"list_sort({lst})" if hashed else lst


def _pair_sql(rule: str) -> str:
    return f"SELECT *, l[1].lang AS src_lang, l[2].lang AS tgt_lang FROM (SELECT *, {_langs_list_sql(rule, True)} AS l FROM wide) a WHERE len(l) >= 2"


def _code_case(col: str) -> str:
    whens = " ".join(f"WHEN '{lang}' THEN '{code}'" for lang, code in LANG_CODES_TRAIN)
    return f"CASE {col} {whens} END"


def _text_case(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{lang}' THEN {lang}" for lang in WIDE_LANGS) + " END"


@register(
    "available_langs",
    with_ctes("wide", body=f"SELECT row_id, {_langs_list_sql('strip', False)} AS langs, "
              f"len({_langs_list_sql('truthy', False)}) AS n_truthy FROM wide"),
)
def q_available_langs(spark, sf):
    w = fx.wide(spark, sf)
    return w.select(
        "row_id",
        langs.available_langs(WIDE_LANGS, "strip").alias("langs"),
        F.size(langs.available_langs(WIDE_LANGS, "truthy")).alias("n_truthy"),
    )


@register("random_lang_pair", with_ctes("wide", body=f"SELECT row_id, src_lang, tgt_lang FROM ({_pair_sql('strip')}) p"))
def q_random_lang_pair(spark, sf):
    return langs.random_lang_pair(fx.wide(spark, sf), WIDE_LANGS, SEED).select("row_id", "src_lang", "tgt_lang")


@register(
    "lang_code_lookup",
    with_ctes("wide", body=f"SELECT row_id, src_lang, tgt_lang, {_code_case('src_lang')} AS src_code, "
              f"{_code_case('tgt_lang')} AS tgt_code FROM ({_pair_sql('strip')}) p"),
)
def q_lang_code_lookup(spark, sf):
    p = langs.random_lang_pair(fx.wide(spark, sf), WIDE_LANGS, SEED)
    p = langs.lang_code_lookup(p, "src_lang", out="src_code")
    return langs.lang_code_lookup(p, "tgt_lang", out="tgt_code").select("row_id", "src_lang", "tgt_lang", "src_code", "tgt_code")


@register(
    "lang_dim",
    with_ctes("wide", body=f""", dim AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in langs.lang_dim_rows())})
    AS t(lang, code, profile)),
usable AS (SELECT unnest({_langs_list_sql('strip', False)}) AS lang FROM wide)
SELECT d.lang, d.code, d.profile, count(*) AS n_rows FROM usable u JOIN dim d ON d.lang = u.lang GROUP BY ALL"""),
)
def q_lang_dim(spark, sf):
    """The three-profile code dimension, with how many corpus rows carry each language."""
    usable = fx.wide(spark, sf).select(F.explode(langs.available_langs(WIDE_LANGS, "strip")).alias("lang"))
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))
    # the dimension is a fixed, tiny table (38 rows): broadcast it
    return counts.join(F.broadcast(langs.lang_dim(spark)), "lang").select("lang", "code", "profile", "n_rows")


# ------------------------------------------------------------------ chat rows

_PROMPT_SQL = "printf('" + SYSTEM_PROMPT.replace("'", "''") + "', {0}, {1}, {2}, {3})"


def _conv_sql() -> str:
    prompt = _PROMPT_SQL.format("src_lang", "tgt_lang", _code_case("src_lang"), _code_case("tgt_lang"))
    return (
        f"SELECT row_id, src_lang, tgt_lang, {prompt} AS system, {_text_case('src_lang')} AS user, "
        f"{_text_case('tgt_lang')} AS assistant FROM ({_pair_sql('truthy')}) p"
    )


def _conv(spark, sf):
    c = chat.build_conversation(fx.wide(spark, sf), WIDE_LANGS, SEED)
    m = F.col("messages")
    return c.select(
        "row_id", "src_lang", "tgt_lang",
        m[0]["content"].alias("system"), m[1]["content"].alias("user"), m[2]["content"].alias("assistant"), "messages",
    )


@register("build_conversation", with_ctes("wide", body=_conv_sql()))
def q_build_conversation(spark, sf):
    return _conv(spark, sf).drop("messages")


@register(
    "build_conversation_test",
    with_ctes("bench", body=f"SELECT row_id, {_PROMPT_SQL.format(repr('english'), repr('ary_Arab'), repr('eng_Latn'), repr('ary_Arab'))} "
              "AS system, english AS user, darija AS assistant FROM bench"),
)
def q_build_conversation_test(spark, sf):
    c = chat.build_conversation_test(fx.bench(spark, sf))
    m = F.col("messages")
    return c.select("row_id", m[0]["content"].alias("system"), m[1]["content"].alias("user"), m[2]["content"].alias("assistant"))


@register(
    "chat_render",
    with_ctes("wide", body="SELECT row_id, " + " || ".join(
        sq.render_message(f"'{r}'", c) for r, c in (("system", "system"), ("user", "user"), ("assistant", "assistant"))
    ) + f" AS text FROM ({_conv_sql()}) c"),
)
def q_chat_render(spark, sf):
    return chat.chat_render(_conv(spark, sf), "messages").select("row_id", "text")
