"""Queries for translation metrics, the benchmark leaderboard and evaluation bundles."""

from __future__ import annotations

from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.fixtures import BENCH_MODELS, with_ctes
from paracorpus.functions import text as tx
from paracorpus.functions.text import WS_CLASS
from paracorpus.operators import chat, columns, encode, metrics
from paracorpus.plans import sqltext as sq
from paracorpus.plans.base import register

EVAL_MAX_LEN = 256
KEYS = ["row_id", "model"]

# ------------------------------------------------------------------ SQL side


def _grams_sql(e: str, n: int, kind: str) -> str:
    if kind == "word":
        return f"list_transform(range(1, len({e}) - {n} + 2), lambda i: array_to_string({e}[i:i + {n} - 1], ' '))"
    return f"list_transform(range(1, length({e}) - {n} + 2), lambda i: substr({e}, i, {n}))"


def stats_sql(src: str, keys: list[str], hyp: str, ref: str, n_max: int, kind: str) -> str:
    """keys + m1..,h1..,r1.. for relation ``src`` (word or char n-grams)."""
    k = ", ".join(keys)
    if kind == "word":
        prep = f"{sq.tokens(hyp)} AS hx, {sq.tokens(ref)} AS rx"
    else:
        prep = f"regexp_replace({hyp}, '{WS_CLASS}', '', 'g') AS hx, regexp_replace({ref}, '{WS_CLASS}', '', 'g') AS rx"
    lists = ", ".join(
        f"list_transform({_grams_sql('hx', n, kind)}, lambda g: {{'n': {n}, 'side': 'h', 'g': g}}), "
        f"list_transform({_grams_sql('rx', n, kind)}, lambda g: {{'n': {n}, 'side': 'r', 'g': g}})"
        for n in range(1, n_max + 1)
    )
    cols = ", ".join(
        f"coalesce(sum({s}) FILTER (WHERE n = {i}), 0) AS {s}{i}" for i in range(1, n_max + 1) for s in ("m", "h", "r")
    )
    on = " AND ".join(f"p.{c} = s.{c}" for c in keys)
    return f"""(WITH prep AS (SELECT {k}, {prep} FROM {src}),
  ex AS (SELECT {k}, unnest(flatten([{lists}])) AS x FROM prep),
  pg AS (SELECT {k}, x.n AS n, x.g AS g, count(*) FILTER (WHERE x.side = 'h') AS hc,
                count(*) FILTER (WHERE x.side = 'r') AS rc FROM ex GROUP BY ALL),
  pn AS (SELECT {k}, n, sum(least(hc, rc)) AS m, sum(hc) AS h, sum(rc) AS r FROM pg GROUP BY ALL)
  SELECT {", ".join("s." + c + " AS " + c for c in keys)}, {cols} FROM (SELECT DISTINCT {k} FROM {src}) s
  LEFT JOIN pn p ON {on} GROUP BY {", ".join("s." + c for c in keys)})"""


def bleu_sql(effective: bool = True) -> str:
    logs = []
    for k in range(1, 5):
        z = " + ".join(f"CASE WHEN m{j} = 0 THEN 1 ELSE 0 END" for j in range(1, k + 1))
        p = f"CASE WHEN m{k} = 0 THEN 100.0::DOUBLE / (pow(2.0, {z}) * h{k}) ELSE 100.0::DOUBLE * m{k} / h{k} END"
        miss = "0.0" if effective else "-9999999999.0"
        logs.append(f"(CASE WHEN h{k} > 0 THEN ln({p}) ELSE {miss} END)")
    eff = "least(4, h1)::DOUBLE" if effective else "4.0"
    bp = "CASE WHEN h1 < r1 THEN CASE WHEN h1 > 0 THEN exp(1.0 - r1::DOUBLE / h1) ELSE 0.0 END ELSE 1.0 END"
    return f"CASE WHEN m1 = 0 THEN 0.0 ELSE ({bp}) * exp(({' + '.join(logs)}) / {eff}) END"


def chrf_sql() -> str:
    both = [f"(h{k} > 0 AND r{k} > 0)" for k in range(1, 7)]
    ps = " + ".join(f"CASE WHEN {b} THEN m{k}::DOUBLE / h{k} ELSE 0.0 END" for k, b in zip(range(1, 7), both))
    rs = " + ".join(f"CASE WHEN {b} THEN m{k}::DOUBLE / r{k} ELSE 0.0 END" for k, b in zip(range(1, 7), both))
    eff = " + ".join(f"CASE WHEN {b} THEN 1 ELSE 0 END" for b in both)
    p = f"(CASE WHEN ({eff}) > 0 THEN ({ps}) / ({eff}) ELSE 0.0 END)"
    r = f"(CASE WHEN ({eff}) > 0 THEN ({rs}) / ({eff}) ELSE 0.0 END)"
    return f"CASE WHEN {p} + {r} > 0 THEN 100.0::DOUBLE * 5.0 * {p} * {r} / (4.0 * {p} + {r}) ELSE 0.0 END"


def word_edit_rate_sql(hyp: str, ref: str) -> str:
    """The distance matrix row by row: a fold over hyp words; a row is a list over
    the reference words, and steps along it are a running minimum of d[j] - j."""
    h, r = sq.tokens(f"lower({hyp})"), sq.tokens(f"lower({ref})")
    n = f"len({r})"
    step = (
        f"list_transform(range(0, {n} + 1), lambda j: CASE WHEN j = 0 THEN d[1] + 1 "
        f"ELSE least(d[j] + CASE WHEN ({r})[j] = w.t THEN 0 ELSE 1 END, d[j + 1] + 1) END)"
    )
    along = f"list_transform(range(0, {n} + 1), lambda j: j + list_min(list_transform(range(0, j + 1), lambda i: c[i + 1] - i)))"
    row = f"(list_transform([{step}], lambda c: {along}))[1]"
    words = f"list_transform({h}, lambda x: {{'t': x, 'd': NULL::BIGINT[]}})"
    first = f"{{'t': NULL::VARCHAR, 'd': range(0, {n} + 1)}}"
    fold = f"list_reduce({words}, lambda a, w: {{'t': NULL::VARCHAR, 'd': (list_transform([a.d], lambda d: {row}))[1]}}, {first})"
    edits = f"(({fold}).d)[-1]::DOUBLE"
    return f"(SELECT CASE WHEN {n} > 0 THEN 100.0::DOUBLE * e / {n} WHEN e > 0 THEN 100.0 ELSE 0.0 END FROM (SELECT {edits} AS e))"


STRIPPED = f"stripped AS (SELECT row_id, model, {sq.strip_punct('hyp')} AS hyp, {sq.strip_punct('ref')} AS ref FROM hyp_ref)"


def scores_sql(src: str = "stripped") -> str:
    b = stats_sql(src, KEYS, "hyp", "ref", 4, "word")
    c = stats_sql(src, KEYS, "hyp", "ref", 6, "char")
    return f"""(SELECT b.row_id, b.model, b.bleu, c.chrf, t.word_edit_rate FROM
  (SELECT row_id, model, {bleu_sql()} AS bleu FROM {b} bs) b
  JOIN (SELECT row_id, model, {chrf_sql()} AS chrf FROM {c} cs) c USING (row_id, model)
  JOIN (SELECT row_id, model, {word_edit_rate_sql('hyp', 'ref')} AS word_edit_rate FROM {src}) t USING (row_id, model))"""


def _r(e: str) -> str:
    return f"round_even({e}, 4)"


# ------------------------------------------------------------------ Spark side


def _stripped(spark, sf):
    h = fx.hyp_ref(spark, sf)
    return h.select("row_id", "model", tx.strip_punct(F.col("hyp")).alias("hyp"), tx.strip_punct(F.col("ref")).alias("ref"))


def _b4(c):
    return F.bround(c, 4)


@register(
    "pair_hyp_ref",
    with_ctes("hyp_ref", body="SELECT h.row_id, h.model, h.hyp, b.text AS ref FROM hyp_ref h JOIN benchmark b ON b.item_id = h.row_id"),
)
def q_pair_hyp_ref(spark, sf):
    hyps = fx.hyp_ref(spark, sf).select("row_id", "model", "hyp")
    refs = fx.table(spark, sf, "benchmark").select(F.col("item_id").alias("row_id"), F.col("text").alias("ref"))
    return hyps.join(refs, "row_id")


@register(
    "sentence_bleu",
    with_ctes("hyp_ref", body=f", {STRIPPED} SELECT row_id, model, {_r(bleu_sql())} AS bleu FROM {stats_sql('stripped', KEYS, 'hyp', 'ref', 4, 'word')} s"),
)
def q_sentence_bleu(spark, sf):
    s = metrics.sentence_bleu(_stripped(spark, sf), KEYS)
    return s.select(*KEYS, _b4("bleu").alias("bleu"))


@register(
    "sentence_chrf",
    with_ctes("hyp_ref", body=f", {STRIPPED} SELECT row_id, model, {_r(chrf_sql())} AS chrf FROM {stats_sql('stripped', KEYS, 'hyp', 'ref', 6, 'char')} s"),
)
def q_sentence_chrf(spark, sf):
    s = metrics.sentence_chrf(_stripped(spark, sf), KEYS)
    return s.select(*KEYS, _b4("chrf").alias("chrf"))


@register("shift_edit_rate")
def q_shift_edit_rate(spark, sf):
    """M3 with block shifts, which SQL can't search: held against a brute force in the tests."""
    s = metrics.shift_edit_rate(_stripped(spark, sf), KEYS)
    return s.select(*KEYS, _b4("word_edit_rate").alias("word_edit_rate"), _b4("shift_edit_rate").alias("shift_edit_rate"))


@register("word_edit_rate", with_ctes("hyp_ref", body=f", {STRIPPED} SELECT row_id, model, {_r(word_edit_rate_sql('hyp', 'ref'))} AS word_edit_rate FROM stripped"))
def q_word_edit_rate(spark, sf):
    s = metrics.word_edit_rate(_stripped(spark, sf), KEYS)
    return s.select(*KEYS, _b4("word_edit_rate").alias("word_edit_rate"))


def _tok13a_sql(e: str) -> str:
    s = f"replace(replace(replace({e}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for a, b in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        s = f"replace({s}, '{a}', '{b}')"
    s = f"(' ' || {s} || ' ')"
    s = f"regexp_replace({s}, '([\\{{-\\~\\[-\\` -\\&\\(-\\+\\:-\\@\\/])', ' \\1 ', 'g')"
    s = f"regexp_replace({s}, '([^0-9])([\\.,])', '\\1 \\2 ', 'g')"
    s = f"regexp_replace({s}, '([\\.,])([^0-9])', ' \\1 \\2', 'g')"
    s = f"regexp_replace({s}, '([0-9])(-)', '\\1 \\2 ', 'g')"
    return f"array_to_string({sq.tokens(s)}, ' ')"


@register(
    "corpus_bleu",
    with_ctes("hyp_ref", body=f""", tok AS (SELECT row_id, model, {_tok13a_sql(sq.ustrip('hyp'))} AS hyp, {_tok13a_sql(sq.ustrip('ref'))} AS ref FROM hyp_ref),
st AS {stats_sql('tok', KEYS, 'hyp', 'ref', 4, 'word')}
SELECT model, {_r(bleu_sql(False))} AS bleu FROM (SELECT model, {", ".join(f"sum({s}{k}) AS {s}{k}" for k in range(1, 5) for s in "mhr")} FROM st GROUP BY model) t"""),
)
def q_corpus_bleu(spark, sf):
    h = fx.hyp_ref(spark, sf)
    h = h.select("row_id", "model", tx.ustrip(F.col("hyp")).alias("hyp"), tx.ustrip(F.col("ref")).alias("ref"))
    return metrics.corpus_bleu(h, ["model"]).select("model", _b4("bleu").alias("bleu"))


@register(
    "macro_scores",
    with_ctes("hyp_ref", body=f", {STRIPPED} SELECT model, {_r('avg(bleu)')} AS bleu, {_r('avg(chrf)')} AS chrf, {_r('avg(word_edit_rate)')} AS word_edit_rate "
              f"FROM {scores_sql()} s GROUP BY model"),
)
def q_macro_scores(spark, sf):
    sc = metrics.score_sentences(_stripped(spark, sf), KEYS)
    return metrics.macro_scores(sc, ["model"])


@register(
    "bench_leaderboard",
    with_ctes("hyp_ref", body=f", {STRIPPED} SELECT string_split(model, '/')[-1] AS label, count(*) AS n_sentences, "
              f"{_r('avg(bleu)')} AS BLEU, {_r('avg(chrf)')} AS chrF, {_r('avg(word_edit_rate)')} AS word_edit_rate FROM {scores_sql()} s GROUP BY 1"),
)
def q_bench_leaderboard(spark, sf):
    sc = metrics.score_sentences(_stripped(spark, sf), KEYS)
    return sc.groupBy(columns.model_label(F.col("model")).alias("label")).agg(
        F.count(F.lit(1)).alias("n_sentences"),
        _b4(F.avg("bleu")).alias("BLEU"), _b4(F.avg("chrf")).alias("chrF"), _b4(F.avg("word_edit_rate")).alias("word_edit_rate"),
    )


def _wide_cols_sql() -> str:
    out = []
    for m, name in (("bleu", "BLEU"), ("chrf", "chrF"), ("word_edit_rate", "word_edit_rate")):
        for model in BENCH_MODELS:
            lbl = model.split("/")[-1]
            out.append(f'{_r(f"max({m}) FILTER (WHERE model = {chr(39)}{model}{chr(39)})")} AS "{name}_{lbl}"')
    return ", ".join(out)


@register(
    "scores_wide",
    with_ctes("hyp_ref", body=f", {STRIPPED} SELECT row_id, {_wide_cols_sql()} FROM {scores_sql()} s GROUP BY row_id"),
)
def q_scores_wide(spark, sf):
    sc = metrics.score_sentences(_stripped(spark, sf), KEYS)
    sc = sc.select(*KEYS, *[_b4(c).alias(c) for c in ("bleu", "chrf", "word_edit_rate")])
    return columns.scores_wide(sc, ["bleu", "chrf", "word_edit_rate"], BENCH_MODELS)


# ------------------------------------------------------------------ evaluation bundles (M6)


def _eval_inputs(spark, sf):
    """Predictions and labels as id arrays: hypotheses/references encoded with
    a vocabulary of both; labels padded with -100 like training labels."""
    h = fx.hyp_ref(spark, sf).withColumn("k", F.concat_ws("|", F.col("row_id").cast("string"), F.col("model")))
    texts = h.select(F.col("hyp").alias("t")).unionByName(h.select(F.col("ref").alias("t")))
    vocab = encode.build_vocab(texts, "t")
    enc = encode.encode_sides(
        h, "k", {"pred": (F.col("hyp"), F.lit("ary_Arab")), "lab": (F.col("ref"), F.lit("ary_Arab"))}, vocab, EVAL_MAX_LEN
    )
    enc = enc.withColumn("labels", encode.pad_to(F.col("lab_ids"), EVAL_MAX_LEN, encode.IGNORE_LABEL))
    keys = h.select("k", "row_id", "model")
    return enc.join(keys, "k"), vocab


def eval_bundle(spark, sf):
    """M6: unmask -> decode -> strip punctuation -> BLEU/chrF/edit rate -> means; gen_len from ids."""
    ids, vocab = _eval_inputs(spark, sf)
    ids = ids.withColumn("labels", encode.unmask_labels(F.col("labels")))
    preds = encode.decode_ids(ids, "k", "pred_ids", vocab, "hyp")
    labs = encode.decode_ids(ids, "k", "labels", vocab, "ref")
    text = ids.select("k", "row_id", "model", encode.non_pad_len(F.col("pred_ids")).alias("gl")).join(preds, "k").join(labs, "k")
    text = text.select(
        "row_id", "model", "gl", tx.strip_punct(F.col("hyp")).alias("hyp"), tx.strip_punct(F.col("ref")).alias("ref")
    )
    sc = metrics.score_sentences(text, KEYS).join(text.select(*KEYS, "gl"), KEYS)
    return metrics.macro_scores(sc, ["model"], extra={"gen_len": F.col("gl")})


def _first_words_sql(e: str, n: int) -> str:
    return f"array_to_string(list_slice({sq.tokens(e)}, 1, {n}), ' ')"


@register(
    "eval_bundle",
    with_ctes("hyp_ref", body=f""", dec AS (SELECT row_id, model, {_first_words_sql('hyp', EVAL_MAX_LEN - 2)} AS hyp,
      {_first_words_sql('ref', EVAL_MAX_LEN - 2)} AS ref, least(len({sq.tokens('hyp')}), {EVAL_MAX_LEN - 2}) + 2 AS gl FROM hyp_ref),
stripped AS (SELECT row_id, model, gl, {sq.strip_punct('hyp')} AS hyp, {sq.strip_punct('ref')} AS ref FROM dec)
SELECT model, {_r('avg(bleu)')} AS bleu, {_r('avg(chrf)')} AS chrf, {_r('avg(word_edit_rate)')} AS word_edit_rate, {_r('avg(gl)')} AS gen_len
FROM {scores_sql()} s JOIN stripped USING (row_id, model) GROUP BY model"""),
)
def q_eval_bundle(spark, sf):
    return eval_bundle(spark, sf)


def eval_bundle_causal(spark, sf, vocab_slack: int = 0):
    """M6 (causal): clip ids -> decode -> text after the last assistant marker
    -> drop chat markers -> strip punctuation -> scores.  Predictions are the
    rendered conversations with edited assistant turns; references the
    rendered originals."""
    conv = fx.table(spark, sf, "conversations")
    edited = conv.withColumn("text", F.when(F.col("role") == "assistant", F.replace("text", F.lit(" the "), F.lit(" "))).otherwise(F.col("text")))
    pred = chat.render_turns(edited).select("conv_id", F.col("text").alias("pred"))
    ref = chat.render_turns(conv).select("conv_id", F.col("text").alias("ref"))
    both = pred.join(ref, "conv_id")
    texts = both.select(F.col("pred").alias("t")).unionByName(both.select(F.col("ref").alias("t")))
    vocab = encode.build_vocab(texts, "t")
    # no truncation: whole conversations
    enc = encode.encode_sides(both, "conv_id", {"p": (F.col("pred"), F.lit("ary_Arab")), "r": (F.col("ref"), F.lit("ary_Arab"))}, vocab, None)
    v_size = encode.FIRST_WORD_ID + vocab.count() + vocab_slack
    enc = enc.select("conv_id", encode.clip_ids(F.col("p_ids"), v_size).alias("p"), encode.clip_ids(F.col("r_ids"), v_size).alias("r"))
    dp = encode.decode_ids(enc, "conv_id", "p", vocab, "hyp")
    dr = encode.decode_ids(enc, "conv_id", "r", vocab, "ref")
    post = lambda c: tx.strip_punct(tx.clean_markers(tx.ustrip(tx.extract_assistant(c))))
    text = dp.join(dr, "conv_id").select("conv_id", F.lit("causal").alias("model"), post(F.col("hyp")).alias("hyp"), post(F.col("ref")).alias("ref"))
    sc = metrics.score_sentences(text.withColumnRenamed("conv_id", "row_id"), KEYS)
    return metrics.macro_scores(sc, ["model"])


def _causal_sql() -> str:
    edited = "CASE WHEN role = 'assistant' THEN replace(text, ' the ', ' ') ELSE text END"
    rend = lambda t: f"string_agg({sq.render_message('role', t)}, '' ORDER BY turn)"
    post = lambda e: sq.strip_punct(sq.clean_markers(sq.ustrip(sq.extract_assistant(e))))
    return f"""WITH r AS (SELECT conv_id AS row_id, 'causal' AS model, array_to_string({sq.tokens(rend(edited))}, ' ') AS hyp,
      array_to_string({sq.tokens(rend('text'))}, ' ') AS ref FROM conversations GROUP BY conv_id),
stripped AS (SELECT row_id, model, {post('hyp')} AS hyp, {post('ref')} AS ref FROM r)
SELECT model, {_r('avg(bleu)')} AS bleu, {_r('avg(chrf)')} AS chrf, {_r('avg(word_edit_rate)')} AS word_edit_rate FROM {scores_sql()} s GROUP BY model"""


@register("eval_bundle_causal", _causal_sql())
def q_eval_bundle_causal(spark, sf):
    return eval_bundle_causal(spark, sf)
