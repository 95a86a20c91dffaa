"""Queries of the service slot, the phrase table and the mergeable statistics."""

from __future__ import annotations

import asyncio

from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.fixtures import with_ctes
from paracorpus.operators import chat, phrases, service, sketches
from paracorpus.operators.template import compile_template
from paracorpus.plans import sqltext as sq
from paracorpus.plans.base import PAIRS_TOK_SQL, _pairs_tok, register
from paracorpus.plans.q_io import _TABLE, A, B
from paracorpus.session import written

_tried: dict[str, int] = {}


async def unsteady(text: str, target: str) -> str:
    """Stand-in service: odd texts fail at their first call, texts of seven times so many characters always."""
    await asyncio.sleep(0.001)
    if len(text) % 7 == 0:
        raise ValueError("refused")
    if len(text) % 2 and _tried.setdefault(f"{target}:{text}", 0) == 0:
        _tried[f"{target}:{text}"] = 1
        raise TimeoutError("busy")
    _tried.pop(f"{target}:{text}", None)
    return text.translate(_TABLE)


UNSTEADY = service.Service("org/unsteady", unsteady, in_flight=32, tries=3, pause=0.001)


@register(
    "translate_service",
    f"""SELECT item_id AS row_id, 'org/unsteady' AS model, CASE WHEN length(text) % 7 <> 0 THEN translate(text, {A}, {B}) END AS hyp,
  CASE WHEN length(text) % 7 <> 0 THEN 'ok' ELSE 'error' END AS status, CASE WHEN length(text) % 7 = 0 THEN 'ValueError: refused' END AS error,
  CAST(CASE WHEN length(text) % 7 = 0 THEN 3 WHEN length(text) % 2 = 1 THEN 2 ELSE 1 END AS INTEGER) AS n_calls
FROM benchmark""",
)
def q_translate_service(spark, sf):
    """Bounded concurrency, retries with pauses, failures recorded."""
    return service.call_service(fx.bench(spark, sf).select("row_id", "english"), "row_id", "english", UNSTEADY)


def phrase_table(spark, sf):
    """Phrases of the benchmark: the first two, three and five words of every third item, and its fourth word."""
    b = fx.table(spark, sf, "benchmark").filter("item_id % 3 = 0")
    w = fx.word_tokens(F.col("text"))
    cut = F.explode(F.array(*[F.slice(w, 1, n) for n in (2, 3, 5)], F.slice(w, 4, 1)))
    rows = b.select(cut.alias("p")).filter(F.size("p") > 0).select(F.array_join("p", " ").alias("phrase"))
    return rows.distinct().withColumn("out", F.concat(F.lit("<"), F.replace("phrase", F.lit(" "), F.lit("_")), F.lit(">")))


_W = sq.tokens("text")
_PHRASES = f"""SELECT DISTINCT array_to_string(p, ' ') AS phrase, len(p) AS n FROM (
  SELECT unnest([list_slice(w, 1, 2), list_slice(w, 1, 3), list_slice(w, 1, 5), list_slice(w, 4, 4)]) AS p
  FROM (SELECT {_W} AS w FROM benchmark WHERE item_id % 3 = 0) b) c WHERE len(p) > 0"""


@register(
    "translate_phrases",
    f"""WITH RECURSIVE phrases AS MATERIALIZED ({_PHRASES}),
rows AS MATERIALIZED (SELECT item_id AS row_id, {_W} AS w FROM benchmark),
places AS MATERIALIZED (SELECT row_id, pos, max(n) AS n FROM (
  SELECT r.row_id, r.pos, p.n FROM (SELECT row_id, w, unnest(range(1, len(w) + 1)) AS pos FROM rows) r
  JOIN phrases p ON p.phrase = array_to_string(list_slice(r.w, r.pos, r.pos + p.n - 1), ' ') AND r.pos + p.n - 1 <= len(r.w)) m GROUP BY ALL),
walk AS (
  SELECT row_id, CAST(1 AS BIGINT) AS pos, '' AS said FROM rows
  UNION ALL
  SELECT k.row_id, k.pos + coalesce(m.n, 1), k.said || CASE WHEN k.pos > 1 THEN ' ' ELSE '' END ||
    CASE WHEN m.n IS NULL THEN r.w[k.pos] ELSE '<' || array_to_string(list_slice(r.w, k.pos, k.pos + m.n - 1), '_') || '>' END
  FROM walk k JOIN rows r ON r.row_id = k.row_id LEFT JOIN places m ON m.row_id = k.row_id AND m.pos = k.pos WHERE k.pos <= len(r.w))
SELECT k.row_id, k.said AS translation FROM walk k JOIN rows r ON r.row_id = k.row_id WHERE k.pos = len(r.w) + 1""",
)
def q_translate_phrases(spark, sf):
    return phrases.phrase_translate(fx.bench(spark, sf), "row_id", "english", phrase_table(spark, sf))


RANKS = (0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99)
_MOMENTS = "count(*) AS n, sum(darija_tokens) AS total, round_even(avg(darija_tokens), 4) AS mean, round_even(stddev_pop(darija_tokens), 4) AS std, min(darija_tokens) AS low, max(darija_tokens) AS high"


def _states(spark, sf):
    tokens = _pairs_tok(spark, sf).select("dataset_source", "darija_tokens")
    return written(sketches.state_of(tokens, "darija_tokens", ["dataset_source"]), "states")


@register(
    "merged_statistics",
    with_ctes("pairs", body=f"SELECT coalesce(dataset_source, '(none)') AS part, {_MOMENTS} FROM ({PAIRS_TOK_SQL}) t WHERE darija_tokens IS NOT NULL GROUP BY ALL "
              f"UNION ALL SELECT '(all)', {_MOMENTS} FROM ({PAIRS_TOK_SQL}) t WHERE darija_tokens IS NOT NULL"),
)
def q_merged_statistics(spark, sf):
    """A3, A4 from the kept states of every source, and merged over all of them."""
    states = _states(spark, sf)
    each = sketches.moments(states, ["dataset_source"]).select(F.coalesce("dataset_source", F.lit("(none)")).alias("part"), "n", "total", "mean", "std", "low", "high")
    return each.unionByName(sketches.moments(sketches.merged(states)).withColumn("part", F.lit("(all)")))


@register(
    "merged_quantiles",
    with_ctes("pairs", body=f"SELECT CAST(unnest({list(RANKS)}) AS DOUBLE) AS rank, true AS within_bound, count(darija_tokens) AS n FROM ({PAIRS_TOK_SQL}) t"),
)
def q_merged_quantiles(spark, sf):
    """Quantiles from merged sketches, each held against its exact rank."""
    whole = sketches.merged(_states(spark, sf))
    found = sketches.quantiles(whole, RANKS)
    tokens = _pairs_tok(spark, sf).select("darija_tokens").filter("darija_tokens IS NOT NULL")
    counts = tokens.groupBy("darija_tokens").agg(F.count(F.lit(1)).alias("m"))  # one row a value
    placed = found.join(counts, F.col("darija_tokens") <= F.col("value")).groupBy("rank", "value").agg(
        F.sum("m").cast("double").alias("upto"), F.sum(F.when(F.col("darija_tokens") < F.col("value"), F.col("m")).otherwise(0)).cast("double").alias("below")
    )
    n = F.col("n").cast("double")
    bound = F.lit(sketches.rank_error())
    ok = (F.col("below") / n - bound <= F.col("rank")) & (F.col("rank") <= F.col("upto") / n + bound)
    return placed.join(whole.select("n")).select("rank", ok.alias("within_bound"), "n")


CHATML = (
    "{% for message in messages %}{{ '<|im_start|>' + message.role + '\\n' + message.content | trim + '<|im_end|>\\n' }}{% endfor %}"
    "{% if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}"
)
INSTRUCT = (
    "{{ bos_token }}\n{%- for m in messages -%}\n  {%- if loop.first and m['role'] == 'system' -%} <<SYS>>{{ m['content'] }}<</SYS>>\n"
    "  {%- elif m['role'] in ['user', 'system'] -%} [INST] {{ m['content'] }} [/INST]\n  {%- else -%} {{ ' ' ~ m['content'] ~ eos_token }}{%- endif -%}\n{%- endfor -%}"
)


def _messages(spark, sf):
    turns = fx.table(spark, sf, "conversations").filter("text IS NOT NULL")
    each = F.struct("turn", F.struct("role", F.col("text").alias("content")).alias("m"))
    held = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(each)).alias("t"))  # the turns of one conversation
    return held.select("conv_id", F.transform("t", lambda x: x["m"]).alias("messages"))


def _turns_sql(piece: str, before: str = "''", after: str = "''") -> str:
    numbered = "SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM conversations WHERE text IS NOT NULL"
    return f"SELECT conv_id, {before} || string_agg({piece}, '' ORDER BY k) || {after} AS text FROM ({numbered}) t GROUP BY conv_id"


@register("template_default", _turns_sql(sq.render_message("role", "text")))
def q_template_default(spark, sf):
    """The given template text."""
    render = compile_template(chat.DEFAULT_CHAT_TEMPLATE, eos_token=chat.DEFAULT_EOS)
    return _messages(spark, sf).select("conv_id", render(F.col("messages")).alias("text"))


@register(
    "template_chatml",
    _turns_sql("'<|im_start|>' || role || chr(10) || regexp_replace(text, '^\\s+|\\s+$', '', 'g') || '<|im_end|>' || chr(10)", after="'<|im_start|>assistant' || chr(10)"),
)
def q_template_chatml(spark, sf):
    render = compile_template(CHATML, add_generation_prompt=True)
    return _messages(spark, sf).select("conv_id", render(F.col("messages")).alias("text"))


@register(
    "template_instruct",
    _turns_sql("CASE WHEN k = 1 AND role = 'system' THEN '<<SYS>>' || text || '<</SYS>>' WHEN role IN ('user', 'system') THEN '[INST] ' || text || ' [/INST]' "
               "ELSE ' ' || text || '</s>' END", before="'<s>'"),
)
def q_template_instruct(spark, sf):
    render = compile_template(INSTRUCT, bos_token="<s>", eos_token="</s>")
    return _messages(spark, sf).select("conv_id", render(F.col("messages")).alias("text"))
