"""Registered composite pipelines Q1-Q9 and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.fixtures import BAD_SOURCES, with_ctes
from paracorpus.functions.rand import hash52_sql, uniform_sql
from paracorpus.functions.translit import transliterate_sql
from paracorpus.operators import encode, filters
from paracorpus.operators.encode import EOS_ID, FIRST_WORD_ID, LANG_TAG_BASE, PAD_ID, UNK_ID
from paracorpus.operators.langs import LANG_CODES_TRAIN
from paracorpus.plans import pipelines as pl
from paracorpus.plans import sqltext as sq
from paracorpus.plans.base import MAX_TOKENS, SAMPLE_N, SEED, WIDE_LANGS, register
from paracorpus.plans.q_io import BENCH_PY_MODELS, HALF_MODEL, NLLB_CODES, lexicon_multi
from paracorpus.plans.q_metrics import _r, _tok13a_sql, bleu_sql, scores_sql, stats_sql
from paracorpus.plans.q_sample import _conv_sql, _pair_sql

A, B = fx.A, fx.B
ANY_MAX_LEN = 512
V1_TEST_SIZE = 0.01
V1_MAX_LEN = 512

# ------------------------------------------------------------------ Spark inputs


def _q1(spark, sf):
    return pl.clean_role_split(pl.role_split_view(fx.table(spark, sf, "conversations")))


def _q2(spark, sf):
    return pl.merge_sources(_q1(spark, sf), fx.pairs(spark, sf), fx.prior_pairs(spark, sf))


def _q4(spark, sf):
    return pl.train_test(_q2(spark, sf), pl.audio_view(fx.bench(spark, sf)), fx.bench(spark, sf), fx.bad_sources(spark))


# ------------------------------------------------------------------ SQL building blocks

def _keep_first(rel: str, keys: str, order: str) -> str:
    return f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {rel}) t WHERE rn = 1)"


Q1_CTES = f""", role AS (SELECT 3000000000000 + conv_id * 1000000 + turn AS row_id, text AS english, translate(text, {A}, {B}) AS darija,
    cast(conv_id AS VARCHAR) || '_' || cast(turn AS VARCHAR) AS id, role, 'conversations' AS dataset FROM conversations),
q1 AS (SELECT english, darija, id, role, dataset, row_id FROM {_keep_first('role', 'english, darija', 'row_id')} k
    WHERE NOT coalesce({sq.contains_code('darija')}, false))"""

Q2_CTES = Q1_CTES + f""",
s AS (SELECT english, darija_ar, dataset_source, row_id FROM pairs
    WHERE english IS NOT NULL AND darija_ar IS NOT NULL AND dataset_source IS NOT NULL AND row_id IS NOT NULL),
s1 AS {_keep_first('s', 'english, darija_ar', 'row_id')},
p AS (SELECT english, darija_ar, dataset_name, row_id FROM prior_pairs
    WHERE english IS NOT NULL AND darija_ar IS NOT NULL AND dataset_name IS NOT NULL AND row_id IS NOT NULL),
both_ AS (SELECT english, darija_ar, NULL::VARCHAR AS dataset_source, dataset_name, row_id, 0 AS p1 FROM p
    UNION ALL SELECT english, darija_ar, dataset_source, NULL, row_id, 1 FROM s1),
b1 AS (SELECT english, darija_ar, coalesce(dataset_source, dataset_name) AS dataset_source, NULL::VARCHAR AS id,
    NULL::VARCHAR AS role, row_id, p1 FROM {_keep_first('both_', 'english, darija_ar', 'p1, row_id')} k),
fin AS (SELECT english, darija_ar, dataset_source, id, role, row_id, p1, 0 AS p2 FROM b1
    UNION ALL SELECT english, darija, dataset, id, role, row_id, 0, 1 FROM q1),
q2 AS (SELECT {sq.clean_unk('english')} AS english, {sq.clean_unk('darija_ar')} AS darija_ar, dataset_source, id, role, row_id, p1, p2
    FROM {_keep_first('fin', 'english, darija_ar', 'p2, p1, row_id')} k)"""

_BAD = ", ".join(f"'{s}'" for s in BAD_SOURCES)
Q4_CTES = Q2_CTES + f""",
b4 AS (SELECT english, darija_ar AS darija_Arab, '' AS darija_Latn, dataset_source, id, role, row_id, 0 AS part FROM q2
    WHERE dataset_source IS DISTINCT FROM '{pl.BASE_EXCLUDED_SOURCE}'),
d4 AS (SELECT english, darija AS darija_Arab, {transliterate_sql('darija')} AS darija_Latn, '{pl.AUDIO_SOURCE}' AS dataset_source,
    '' AS id, '' AS role, row_id + 2000000000 AS row_id, 1 AS part FROM bench),
u4 AS (SELECT * FROM b4 UNION ALL SELECT * FROM d4),
tr AS (SELECT * EXCLUDE (part) FROM {_keep_first('(SELECT * FROM u4 WHERE english IS NOT NULL AND darija_Arab IS NOT NULL)', 'english, darija_Arab', 'part, row_id')} k),
train4 AS (SELECT *, {sq.token_count('darija_Arab')} AS darija_tokens FROM tr
    WHERE dataset_source IS NULL OR dataset_source NOT IN ({_BAD})),
test4 AS (SELECT english, darija AS darija_Arab, arabizi AS darija_Latn, '' AS dataset_source, '' AS id, '' AS role, row_id,
    {sq.token_count('darija')} AS darija_tokens, topic, subtopic, annotator_dialect FROM bench)"""


@register("pipeline_clean_source", with_ctes("pairs", body=Q1_CTES + " SELECT * FROM q1"))
def q_pipeline_clean_source(spark, sf):
    return _q1(spark, sf)


@register("pipeline_merge", with_ctes("pairs", "prior_pairs", body=Q2_CTES + " SELECT * FROM q2"))
def q_pipeline_merge(spark, sf):
    return _q2(spark, sf)


@register(
    "pipeline_pretrain_text",
    with_ctes("pairs", "prior_pairs", body=Q2_CTES + f"""
SELECT text, source AS dataset_source, '{{}}' AS metadata FROM documents
UNION ALL SELECT darija_ar, '{pl.PRETRAIN_SOURCE}', '{{}}' FROM q2
UNION ALL SELECT text, '{pl.PRETRAIN_SOURCE}', '{{}}' FROM conversations
UNION ALL SELECT text, '{pl.PRETRAIN_SOURCE}', '{{}}' FROM benchmark"""),
)
def q_pipeline_pretrain_text(spark, sf):
    docs = fx.table(spark, sf, "documents").select("text", F.col("source").alias("dataset_source"), F.lit(str({})).alias("metadata"))
    transcripts = [fx.table(spark, sf, "conversations").select("text"), fx.table(spark, sf, "benchmark").select("text")]
    return pl.pretrain_text(_q2(spark, sf), transcripts, docs)


@register(
    "pipeline_train_test",
    with_ctes("pairs", "prior_pairs", "bench", body=Q4_CTES + """
SELECT 'train' AS split, english, darija_Arab, darija_Latn, dataset_source, id, role, row_id, darija_tokens,
  '' AS topic, '' AS subtopic, '' AS annotator_dialect FROM train4
UNION ALL SELECT 'test', english, darija_Arab, darija_Latn, dataset_source, id, role, row_id, darija_tokens, topic, subtopic,
  annotator_dialect FROM test4"""),
)
def q_pipeline_train_test(spark, sf):
    return _q4(spark, sf)


def _q5_sql() -> str:
    u = uniform_sql("row_id", repr(str(SEED)))
    return Q4_CTES + f""",
pool AS (SELECT * FROM train4 WHERE darija_tokens < {MAX_TOKENS} AND dataset_source IS DISTINCT FROM '{pl.AUDIO_SOURCE}'),
drawn AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY ln(-ln({u})) - darija_tokens / (SELECT avg(darija_tokens) FROM pool), row_id) AS draw_rank
    FROM pool) t WHERE draw_rank <= {SAMPLE_N})
SELECT row_id, english, darija_Arab AS ary_Arab, darija_Latn AS ary_Latn, darija_tokens AS ary_tokens, dataset_source, draw_rank FROM drawn
UNION ALL SELECT row_id, english, darija_Arab, darija_Latn, darija_tokens, dataset_source, NULL FROM train4 WHERE dataset_source = '{pl.AUDIO_SOURCE}'"""


def _q5(spark, sf):
    train = _q4(spark, sf).filter(F.col("split") == "train")
    return pl.weighted_training_sample(train, SAMPLE_N, SEED, MAX_TOKENS)


@register("pipeline_sample", with_ctes("pairs", "prior_pairs", "bench", body=_q5_sql()))
def q_pipeline_sample(spark, sf):
    return _q5(spark, sf)


def _q5_stats_sql() -> str:
    ctes, _, body = _q5_sql().rpartition("\nSELECT row_id, english, darija_Arab AS ary_Arab")
    t = "ary_tokens"
    r = lambda e, d=4: f"round_even({e}, {d})"
    return f"""{ctes},
smp AS (SELECT row_id, english, darija_Arab AS ary_Arab{body}),
tot AS (SELECT count(*)::DOUBLE AS n, sum({t})::DOUBLE AS s, avg({t}) AS m, stddev_pop({t}) AS sd, min({t})::DOUBLE AS lo0, max({t})::DOUBLE AS hi0 FROM smp),
rng AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM tot),
gaps AS (SELECT row_id - lag(row_id) OVER (ORDER BY row_id) AS gap FROM smp WHERE draw_rank IS NOT NULL),
gs AS (SELECT count(gap)::DOUBLE AS n_gaps, avg(gap) AS mean_gap, min(gap)::DOUBLE AS min_gap, max(gap)::DOUBLE AS max_gap,
  (count(*) FILTER (WHERE gap = 1))::DOUBLE AS consecutive FROM gaps),
hist AS (SELECT least(floor(({t}::DOUBLE - lo) * 50.0::DOUBLE / (hi - lo))::INT, 49) + 1 AS bin, count(*)::DOUBLE AS c FROM smp, rng GROUP BY 1)
SELECT 'n_rows' AS metric, n AS value FROM tot UNION ALL SELECT 'total_tokens', s FROM tot
UNION ALL SELECT 'tokens_n', n FROM tot UNION ALL SELECT 'tokens_mean', {r('m')} FROM tot UNION ALL SELECT 'tokens_std', {r('sd')} FROM tot
UNION ALL SELECT 'tokens_upper', {r('m + sd')} FROM tot UNION ALL SELECT 'tokens_lower', CASE WHEN m - sd > 0 THEN {r('m - sd')} END FROM tot
UNION ALL SELECT 'index_n_gaps', n_gaps FROM gs UNION ALL SELECT 'index_mean_gap', {r('mean_gap')} FROM gs
UNION ALL SELECT 'index_min_gap', min_gap FROM gs UNION ALL SELECT 'index_max_gap', max_gap FROM gs
UNION ALL SELECT 'index_consecutive', consecutive FROM gs
UNION ALL SELECT 'index_pct_consecutive', {r('100.0::DOUBLE * consecutive / n_gaps', 1)} FROM gs
UNION ALL SELECT 'bin_' || lpad(b::VARCHAR, 2, '0'), coalesce(c, 0.0) FROM range(1, 51) t(b) LEFT JOIN hist ON hist.bin = t.b"""


@register("pipeline_sample_stats", with_ctes("pairs", "prior_pairs", "bench", body=_q5_stats_sql()))
def q_pipeline_sample_stats(spark, sf):
    return pl.sample_report(_q5(spark, sf))


# ------------------------------------------------------------------ Q6 any-to-any


def _wide_vocab(spark, sf):
    w = fx.wide(spark, sf)
    texts = w.select(F.explode(F.array(*[F.col(c) for c in WIDE_LANGS])).alias("t"))
    return encode.build_vocab(texts, "t")


def _code_case(col: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{lang}' THEN '{code}'" for lang, code in LANG_CODES_TRAIN) + " END"


def _tag_case(col: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{code}' THEN {LANG_TAG_BASE + i}" for i, (_, code) in enumerate(LANG_CODES_TRAIN)) + f" ELSE {UNK_ID} END"


def _text_case(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{lang}' THEN {lang}" for lang in WIDE_LANGS) + " END"


def _q6_sql() -> str:
    keep = ANY_MAX_LEN - 2
    texts = " UNION ALL ".join(f"SELECT unnest({sq.tokens(c)}) AS token FROM wide" for c in WIDE_LANGS)
    pad = lambda e: f"list_concat({e}, list_transform(range({ANY_MAX_LEN} - len({e})), lambda x: {PAD_ID}))"
    return f""", pr AS (SELECT row_id, {_text_case('src_lang')} AS src_text, {_code_case('src_lang')} AS src_code,
    {_text_case('tgt_lang')} AS tgt_text, {_code_case('tgt_lang')} AS tgt_code FROM ({_pair_sql('strip')}) p),
vocab AS (SELECT token, row_number() OVER (ORDER BY freq DESC, h, token) - 1 + {FIRST_WORD_ID} AS id
  FROM (SELECT token, count(*) AS freq, {hash52_sql('token')} AS h FROM ({texts}) x WHERE token IS NOT NULL GROUP BY token) f),
toks AS (SELECT row_id, side, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS pos FROM
  (SELECT row_id, 'src' AS side, {sq.tokens('src_text')} AS l FROM pr UNION ALL SELECT row_id, 'tgt', {sq.tokens('tgt_text')} FROM pr) s),
ids AS (SELECT t.row_id, t.side, list(coalesce(v.id, {UNK_ID}) ORDER BY t.pos) AS l
  FROM toks t LEFT JOIN vocab v ON v.token = t.token WHERE t.pos < {keep} GROUP BY t.row_id, t.side),
enc AS (SELECT pr.row_id, list_concat([{_tag_case('pr.src_code')}], coalesce(s.l, []), [{EOS_ID}]) AS src_ids,
  list_concat([{_tag_case('pr.tgt_code')}], coalesce(t.l, []), [{EOS_ID}]) AS tgt_ids
  FROM pr LEFT JOIN ids s ON s.row_id = pr.row_id AND s.side = 'src' LEFT JOIN ids t ON t.row_id = pr.row_id AND t.side = 'tgt')
SELECT row_id, {pad('src_ids')} AS input_ids,
  list_concat(list_transform(range(len(src_ids)), lambda x: 1), list_transform(range({ANY_MAX_LEN} - len(src_ids)), lambda x: 0)) AS attention_mask,
  {pad('tgt_ids')} AS labels FROM enc"""


@register("pipeline_any_to_any", with_ctes("wide", body=_q6_sql()))
def q_pipeline_any_to_any(spark, sf):
    return pl.any_to_any(fx.wide(spark, sf), WIDE_LANGS, _wide_vocab(spark, sf), SEED, ANY_MAX_LEN)


def _test_vocab(spark, sf):
    """Words of the bench and of every lexicon output."""
    words = lexicon_multi(spark, sf).select(F.col("out").alias("t"))
    return encode.build_vocab(fx.bench(spark, sf).select(F.col("english").alias("t")).unionByName(words), "t")


def _q6_test_sql() -> str:
    keep = ANY_MAX_LEN - 2
    codes = ", ".join(repr(c) for c in NLLB_CODES)
    return f""", langs AS (SELECT unnest([{codes}]) AS tgt_lang),
vocab AS (SELECT token, row_number() OVER (ORDER BY freq DESC, h, token) - 1 + {FIRST_WORD_ID} AS id
  FROM (SELECT token, count(*) AS freq, {hash52_sql('token')} AS h FROM (SELECT unnest({sq.tokens('english')}) AS token FROM bench
    UNION ALL SELECT unnest({sq.tokens("tgt_lang || ':' || out")}) FROM lexicon CROSS JOIN langs) x GROUP BY token) f),
w AS (SELECT row_id, unnest(l) AS word, generate_subscripts(l, 1) AS pos FROM (SELECT row_id, {sq.tokens('english')} AS l FROM bench) b),
src AS (SELECT w.row_id, list(coalesce(v.id, {UNK_ID}) ORDER BY w.pos) AS l FROM w LEFT JOIN vocab v ON v.token = w.word WHERE w.pos <= {keep} GROUP BY w.row_id),
tr AS (SELECT w.row_id, g.tgt_lang, w.pos, coalesce(g.tgt_lang || ':' || x.out, w.word) AS word
  FROM w CROSS JOIN langs g LEFT JOIN lexicon x ON x.word = w.word WHERE w.pos <= {keep}),
tgt AS (SELECT tr.row_id, tr.tgt_lang, list(coalesce(v.id, {UNK_ID}) ORDER BY tr.pos) AS l FROM tr LEFT JOIN vocab v ON v.token = tr.word GROUP BY ALL),
enc AS (SELECT b.row_id, g.tgt_lang, list_concat([{_tag_case("'eng_Latn'")}], coalesce(s.l, []), [{EOS_ID}]) AS input_ids,
  list_concat([{_tag_case('g.tgt_lang')}], coalesce(t.l, []), [{EOS_ID}]) AS labels
  FROM bench b CROSS JOIN langs g LEFT JOIN src s ON s.row_id = b.row_id LEFT JOIN tgt t ON t.row_id = b.row_id AND t.tgt_lang = g.tgt_lang)
SELECT row_id, tgt_lang, input_ids, list_transform(input_ids, lambda x: 1) AS attention_mask, labels FROM enc"""


@register("pipeline_any_to_any_test", with_ctes("bench", "lexicon", body=_q6_test_sql()))
def q_pipeline_any_to_any_test(spark, sf):
    return pl.any_to_any_test(fx.bench(spark, sf), lexicon_multi(spark, sf), NLLB_CODES, _test_vocab(spark, sf), ANY_MAX_LEN)


# ------------------------------------------------------------------ Q7 .. Q9

_CHAT_SQL = "SELECT row_id, " + " || ".join(
    sq.render_message(f"'{r}'", r) for r in ("system", "user", "assistant")
) + f" AS text FROM ({_conv_sql()}) c"


@register("pipeline_sft", with_ctes("wide", body=_CHAT_SQL))
def q_pipeline_sft(spark, sf):
    return pl.sft_rows(fx.wide(spark, sf), WIDE_LANGS, SEED)


_BENCH_SQL = with_ctes(
    "bench",
    body=f""", tr AS (SELECT row_id, 'org/char-v1' AS model, translate(english, {A}, {B}) AS hyp, darija AS ref FROM bench
  UNION ALL SELECT row_id, 'org/char-v2', translate(lower(english), {A}, {B}), darija FROM bench
  UNION ALL SELECT row_id, '{HALF_MODEL.name}', CASE WHEN length(english) % 2 = 0 THEN translate(english, {A}, {B}) END, darija FROM bench),
stripped AS (SELECT row_id, model, {sq.strip_punct("coalesce(hyp, '')")} AS hyp, {sq.strip_punct('ref')} AS ref, hyp IS NULL AS failed FROM tr)
SELECT string_split(s.model, '/')[-1] AS label, count(*) AS n_sentences, count(*) FILTER (WHERE f.failed) AS n_errors, {_r('avg(bleu)')} AS BLEU,
  {_r('avg(chrf)')} AS chrF, {_r('avg(word_edit_rate)')} AS word_edit_rate
FROM {scores_sql()} s JOIN stripped f ON f.row_id = s.row_id AND f.model = s.model GROUP BY 1""",
)


@register("pipeline_bench", _BENCH_SQL)
def q_pipeline_bench(spark, sf):
    lb = pl.bench_leaderboard(fx.bench(spark, sf), [*BENCH_PY_MODELS, HALF_MODEL])
    return lb.select("label", "n_sentences", "n_errors", *[F.bround(c, 4).alias(c) for c in ("BLEU", "chrF", "word_edit_rate")])


def _v1_vocab(spark, sf):
    p = filters.dropna_subset(fx.pairs(spark, sf), ["english", "darija_ar"])
    return encode.build_vocab(p.select(F.col("english").alias("t")).unionByName(p.select(F.col("darija_ar").alias("t"))), "t")


def _v1_sql() -> str:
    keep = V1_MAX_LEN - 2
    first = lambda e: f"array_to_string(list_slice({sq.tokens(e)}, 1, {keep}), ' ')"
    return f""", nn AS (SELECT * FROM pairs WHERE english IS NOT NULL AND darija_ar IS NOT NULL),
sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {hash52_sql('row_id', repr(str(SEED)))}, row_id) - 1
  < CAST(ceil((SELECT count(*) FROM nn)::DOUBLE * {V1_TEST_SIZE}::DOUBLE) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM nn),
te AS (SELECT row_id, 'copy' AS model, {_tok13a_sql(first('english'))} AS hyp, {_tok13a_sql(first('darija_ar'))} AS ref,
  least(len({sq.tokens('english')}), {keep}) + 2 AS gl FROM sp WHERE split = 'test'),
st AS {stats_sql('te', ['row_id', 'model'], 'hyp', 'ref', 4, 'word')}
SELECT 'n_' || split AS metric, count(*)::DOUBLE AS value FROM sp GROUP BY split
UNION ALL SELECT 'input_ids_' || split, sum(least(len({sq.tokens('english')}), {keep}) + 2)::DOUBLE FROM sp GROUP BY split
UNION ALL SELECT 'labels_' || split, sum(least(len({sq.tokens('darija_ar')}), {keep}) + 2)::DOUBLE FROM sp GROUP BY split
UNION ALL SELECT 'total_tokens', sum({sq.token_count('darija_ar')})::DOUBLE FROM sp
UNION ALL SELECT 'bleu', {_r(bleu_sql(False))} FROM (SELECT {", ".join(f"sum({s}{k}) AS {s}{k}" for k in range(1, 5) for s in "mhr")} FROM st) t
UNION ALL SELECT 'gen_len', {_r('avg(gl)')} FROM te"""


@register("pipeline_v1", with_ctes("pairs", body=_v1_sql()))
def q_pipeline_v1(spark, sf):
    out = pl.v1_prepare_and_score(fx.pairs(spark, sf), _v1_vocab(spark, sf), SEED, V1_TEST_SIZE, V1_MAX_LEN)
    return out.select("metric", F.bround("value", 4).alias("value"))
