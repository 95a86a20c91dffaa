"""Queries for token counts, vocabulary encode/decode and id-array operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.fixtures import with_ctes
from paracorpus.functions.rand import hash52_sql
from paracorpus.operators import encode, filters
from paracorpus.operators.encode import EOS_ID, FIRST_WORD_ID, LANG_TAG_BASE, PAD_ID, UNK_ID
from paracorpus.operators.langs import LANG_CODES_TRAIN
from paracorpus.plans import sqltext as sq
from paracorpus.plans.base import register

MAX_LEN_PADDED = 512
MAX_LEN_RAGGED = 512
CLIP_VOCAB = 5
BATCH = 16

_CODES = [c for _, c in LANG_CODES_TRAIN]
SRC_CODE, TGT_CODE = "eng_Latn", "ary_Arab"
SRC_TAG, TGT_TAG = LANG_TAG_BASE + _CODES.index(SRC_CODE), LANG_TAG_BASE + _CODES.index(TGT_CODE)


@register("token_count", with_ctes("pairs", body=f"SELECT row_id, {sq.token_count('darija_ar')} AS darija_tokens FROM pairs"))
def q_token_count(spark, sf):
    return fx.pairs(spark, sf).select("row_id", encode.token_count(F.col("darija_ar")).alias("darija_tokens"))


def _nn_pairs(spark, sf):
    return filters.dropna_subset(fx.pairs(spark, sf), ["english", "darija_ar"])


def _vocab(spark, sf):
    p = _nn_pairs(spark, sf)
    texts = p.select(F.col("english").alias("t")).unionByName(p.select(F.col("darija_ar").alias("t")))
    return encode.build_vocab(texts, "t")


def _encoded(spark, sf, max_len, pad):
    p = _nn_pairs(spark, sf) if pad else fx.pairs(spark, sf)  # ragged: a missing text is encoded as a word
    return encode.encode_pairs(
        p, "row_id", (F.col("english"), F.lit(SRC_CODE)), (F.col("darija_ar"), F.lit(TGT_CODE)), _vocab(spark, sf), max_len, pad
    )


def _encode_sql(max_len: int, pad: bool) -> str:
    keep = max_len - 2
    some = "english IS NOT NULL AND darija_ar IS NOT NULL"
    null = encode.NULL_TEXT
    rows = f"SELECT * FROM nn0 WHERE {some}" if pad else f"SELECT row_id, coalesce(english, '{null}') AS english, coalesce(darija_ar, '{null}') AS darija_ar FROM pairs"
    ctes = f""", nn0 AS (SELECT * FROM pairs WHERE {some}), nn AS ({rows}),
vocab AS (SELECT token, row_number() OVER (ORDER BY freq DESC, h, token) - 1 + {FIRST_WORD_ID} AS id
  FROM (SELECT token, count(*) AS freq, {hash52_sql('token')} AS h FROM
        (SELECT unnest({sq.tokens('english')}) AS token FROM nn0 UNION ALL SELECT unnest({sq.tokens('darija_ar')}) FROM nn0) x
        GROUP BY token) f),
toks AS (SELECT row_id, side, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS pos FROM
  (SELECT row_id, 'src' AS side, {sq.tokens('english')} AS l FROM nn UNION ALL
   SELECT row_id, 'tgt', {sq.tokens('darija_ar')} FROM nn) s),
ids AS (SELECT t.row_id, t.side, list(coalesce(v.id, {UNK_ID}) ORDER BY t.pos) AS l
  FROM toks t LEFT JOIN vocab v ON v.token = t.token WHERE t.pos < {keep} GROUP BY t.row_id, t.side),
enc AS (SELECT nn.row_id,
  list_concat([{SRC_TAG}], coalesce(s.l, []), [{EOS_ID}]) AS src_ids,
  list_concat([{TGT_TAG}], coalesce(t.l, []), [{EOS_ID}]) AS tgt_ids
  FROM nn LEFT JOIN ids s ON s.row_id = nn.row_id AND s.side = 'src' LEFT JOIN ids t ON t.row_id = nn.row_id AND t.side = 'tgt')
"""
    if pad:
        body = (
            f"SELECT row_id, list_concat(src_ids, list_transform(range({max_len} - len(src_ids)), lambda x: {PAD_ID})) AS input_ids, "
            f"list_concat(list_transform(range(len(src_ids)), lambda x: 1), list_transform(range({max_len} - len(src_ids)), lambda x: 0)) AS attention_mask, "
            f"list_concat(tgt_ids, list_transform(range({max_len} - len(tgt_ids)), lambda x: {PAD_ID})) AS labels FROM enc"
        )
    else:
        body = "SELECT row_id, src_ids AS input_ids, list_transform(src_ids, lambda x: 1) AS attention_mask, tgt_ids AS labels FROM enc"
    return with_ctes("pairs", body=ctes + body)


@register("encode_pairs", _encode_sql(MAX_LEN_PADDED, True))
def q_encode_pairs(spark, sf):
    return _encoded(spark, sf, MAX_LEN_PADDED, True)


@register("encode_pairs_ragged", _encode_sql(MAX_LEN_RAGGED, False))
def q_encode_pairs_ragged(spark, sf):
    return _encoded(spark, sf, MAX_LEN_RAGGED, False)


@register(
    "decode_ids",
    with_ctes("pairs", body=f"SELECT row_id, array_to_string(list_slice({sq.tokens('english')}, 1, {MAX_LEN_RAGGED - 2}), ' ') AS text "
              "FROM pairs WHERE english IS NOT NULL AND darija_ar IS NOT NULL"),
)
def q_decode_ids(spark, sf):
    p, vocab = _nn_pairs(spark, sf), _vocab(spark, sf)
    enc = encode.encode_sides(p, "row_id", {"input": (F.col("english"), F.lit(SRC_CODE))}, vocab, MAX_LEN_RAGGED)
    return encode.decode_ids(enc, "row_id", "input_ids", vocab)


@register(
    "unmask_labels",
    with_ctes("seqs", body=f"SELECT row_id, list_transform(labels, lambda x: CASE WHEN x = -100 THEN {PAD_ID} ELSE x END) AS labels FROM seqs"),
)
def q_unmask_labels(spark, sf):
    return fx.seqs(spark, sf).select("row_id", encode.unmask_labels(F.col("labels")).alias("labels"))


@register(
    "clip_ids",
    with_ctes("seqs", body=f"SELECT row_id, list_transform(labels, lambda x: least(greatest(x, 0), {CLIP_VOCAB - 1})) AS labels FROM seqs"),
)
def q_clip_ids(spark, sf):
    return fx.seqs(spark, sf).select("row_id", encode.clip_ids(F.col("labels"), CLIP_VOCAB).alias("labels"))


@register("argmax_vector", "SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS argmax FROM embeddings")
def q_argmax_vector(spark, sf):
    e = fx.table(spark, sf, "embeddings")
    return e.select("vec_id", encode.argmax(F.col("embedding")).alias("argmax"))


@register(
    "gen_len",
    with_ctes("seqs", body=f"SELECT round_even(avg(len(list_filter(ids, lambda x: x <> {PAD_ID}))), 4) AS gen_len FROM seqs"),
)
def q_gen_len(spark, sf):
    s = fx.seqs(spark, sf)
    return s.agg(F.bround(F.avg(encode.non_pad_len(F.col("ids"))), 4).alias("gen_len"))


@register(
    "batch_pad",
    with_ctes("seqs", body=f""", b AS (SELECT *, (row_number() OVER (ORDER BY row_id) - 1) // {BATCH} AS batch_id FROM seqs),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS li, max(len(labels)) OVER (PARTITION BY batch_id) AS ll FROM b)
SELECT row_id, batch_id,
  list_concat(ids, list_transform(range(li - len(ids)), lambda x: {PAD_ID})) AS input_ids,
  list_concat(list_transform(range(len(ids)), lambda x: 1), list_transform(range(li - len(ids)), lambda x: 0)) AS attention_mask,
  list_concat(labels, list_transform(range(ll - len(labels)), lambda x: -100)) AS labels FROM m"""),
)
def q_batch_pad(spark, sf):
    return encode.batch_pad(fx.seqs(spark, sf), "row_id", BATCH)
