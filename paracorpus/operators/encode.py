"""Vocabulary, encode/decode and id-array operators.

The subword tokenizer of the reference is re-aimed as a word vocabulary
table: whitespace tokens ranked by frequency, written once so Spark knows its
size.  Encoding partitions rows by key first and explodes tokens after that, so
a lookup that Spark may broadcast needs no exchange of tokens.  Against a larger
vocabulary, rows are packed into blocks (``operators.blocks``): only the distinct
tokens of each block are joined with it, so hot tokens and long texts are not moved.
Every array operation after that is a higher-order function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paracorpus.fixtures import word_count, word_tokens
from paracorpus.functions.rand import hash52
from paracorpus.operators import blocks
from paracorpus.operators.langs import LANG_CODES_TRAIN
from paracorpus.operators.rowid import with_row_pos

# Special ids of our vocabulary.
PAD_ID, EOS_ID, UNK_ID = 0, 1, 2
LANG_TAG_BASE = 3  # language tags follow, in LANG_CODES_TRAIN order
FIRST_WORD_ID = 100
IGNORE_LABEL = -100
NULL_TEXT = "None"  # fixed value: what a missing text is encoded as
N_SPECIAL = 2  # language tag + end of sequence, added to every encoded text


def lang_tag_ids() -> Column:
    codes = [code for _, code in LANG_CODES_TRAIN]
    return F.create_map(*[x for i, c in enumerate(codes) for x in (F.lit(c), F.lit(LANG_TAG_BASE + i))])


def token_count(c: Column, n_special: int = N_SPECIAL) -> Column:
    """Tokens of a text (whitespace words + the specials every encoding adds)."""
    return word_count(c) + F.lit(n_special)


def build_vocab(texts: DataFrame, text_col: str) -> DataFrame:
    """Vocabulary (token, id, freq): ids by frequency desc, then a token hash.

    Ranking uses the distributed dense position; the corpus is tokenized once.
    """
    freq = blocks.word_counts(texts, text_col).groupBy("token").agg(F.sum("n").alias("freq"))
    keyed = freq.withColumn("__f", -F.col("freq")).withColumn("__h", hash52(F.col("token")))
    # positions are written once: the vocabulary is looked up several times (encode, decode), of known size
    ranked = with_row_pos(keyed, ["__f", "__h", "token"], "__pos", only_order=["__f", "__h"])
    return ranked.select("token", (F.col("__pos") + F.lit(FIRST_WORD_ID)).alias("id"), "freq")


def encode_sides(
    df: DataFrame,
    key: str,
    sides: dict[str, tuple[Column, Column]],
    vocab: DataFrame,
    max_len: int | None,
) -> DataFrame:
    """Encode several texts per row: ``sides`` maps a name to (text, lang code).

    Returns ``key`` plus one ``<name>_ids`` array per side:
    ``[lang tag] + first (max_len - 2) word ids + [eos]`` (unknown word -> unk;
    ``max_len`` None: all words).  ``key`` must be unique.  The rows are read
    once; tags and eos are added to the regrouped arrays.
    """
    vocab = vocab.select("token", "id")
    if blocks.broadcasts(vocab):
        return _encode_exploded(df, key, sides, vocab, max_len)
    tags, names = lang_tag_ids(), list(sides)
    keep = None if max_len is None else max(max_len - N_SPECIAL, 0)
    tag = [f"__g{i}" for i in range(len(names))]
    rows = df.select(
        F.col(key).alias("__key"),
        *[_tag(tags, code).alias(g) for g, (_, code) in zip(tag, sides.values(), strict=True)],
        *[txt.alias(f"__x{i}") for i, (txt, _) in enumerate(sides.values())],
    )
    packed = blocks.pack_texts(rows, [f"__x{i}" for i in range(len(names))], keep)
    ids = blocks.look_up_ids(packed, vocab, UNK_ID)
    with_specials = [F.concat(F.array(F.col(g)), F.col(f"__x{i}"), F.array(F.lit(EOS_ID))).alias(f"{n}_ids") for i, (g, n) in enumerate(zip(tag, names, strict=True))]
    out = ids.select(F.col("__key").alias(key), *with_specials)
    return blocks.except_repeated(packed, out, key, df, lambda rest: _encode_exploded(rest, key, sides, vocab, max_len))


def _tag(tags: Column, code: Column) -> Column:
    return F.coalesce(F.element_at(tags, code), F.lit(UNK_ID)).cast("int")


def _encode_exploded(df: DataFrame, key: str, sides: dict[str, tuple[Column, Column]], vocab: DataFrame, max_len: int | None) -> DataFrame:
    """``encode_sides`` by one row for each token, for a vocabulary that is broadcast.

    The rows are partitioned by key before their tokens are exploded."""
    tags = lang_tag_ids()
    names = list(sides)
    keep = None if max_len is None else max(max_len - N_SPECIAL, 0)
    rows = df.select(
        F.col(key).alias("__key"),
        *[txt.alias(f"__x{i}") for i, (txt, _) in enumerate(sides.values())],
        *[_tag(tags, code).alias(f"__g{i}") for i, (_, code) in enumerate(sides.values())],
    ).repartition("__key")
    rows = rows.select("*", *[word_tokens(F.col(f"__x{i}"), keep).alias(f"__t{i}") for i in range(len(names))])

    def of_side(i: int):
        return lambda t, at: F.struct(F.lit(i).alias("side"), at.alias("pos"), t.alias("token"))

    empty = F.array().cast("array<struct<side:int,pos:int,token:string>>")
    stream = F.concat(*[F.coalesce(F.transform(f"__t{i}", of_side(i)), empty) for i in range(len(names))])
    tagged = [f"__g{i}" for i in range(len(names))]
    words = rows.select("__key", *tagged, F.explode_outer(stream).alias("w")).select("__key", *tagged, "w.side", "w.pos", "w.token")
    found = words.join(vocab, "token", "left")
    entry = F.when(F.col("side").isNotNull(), F.struct("side", "pos", F.coalesce("id", F.lit(UNK_ID)).cast("int").alias("id")))
    g = found.groupBy("__key").agg(F.sort_array(F.collect_list(entry)).alias("__all"), *[F.first(t).alias(t) for t in tagged])

    def ids_of(i: int) -> Column:
        return F.transform(F.filter("__all", lambda x: x["side"] == i), lambda x: x["id"])

    cols = [F.concat(F.array(F.col(f"__g{i}")), ids_of(i), F.array(F.lit(EOS_ID))).alias(f"{n}_ids") for i, n in enumerate(names)]
    return g.select(F.col("__key").alias(key), *cols)


def pad_to(ids: Column, length: int, pad: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(F.lit(length) - F.size(ids), F.lit(0))))


def mask_for(ids: Column, length: int) -> Column:
    n = F.size(ids)
    return F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.greatest(F.lit(length) - n, F.lit(0))))


def encode_pairs(
    df: DataFrame, key: str, src: tuple[Column, Column], tgt: tuple[Column, Column], vocab: DataFrame,
    max_len: int, pad: bool = True,
) -> DataFrame:
    """R2 (``pad=True``, padded to ``max_len`` with mask) and R3 (ragged; a null
    text is stringified to ``'None'`` before it is encoded)."""
    if not pad:
        src, tgt = [(F.coalesce(text, F.lit(NULL_TEXT)), code) for text, code in (src, tgt)]
    enc = encode_sides(df, key, {"src": src, "tgt": tgt}, vocab, max_len)
    if pad:
        return enc.select(
            key,
            pad_to(F.col("src_ids"), max_len, PAD_ID).alias("input_ids"),
            mask_for(F.col("src_ids"), max_len).alias("attention_mask"),
            pad_to(F.col("tgt_ids"), max_len, PAD_ID).alias("labels"),
        )
    return enc.select(
        key,
        F.col("src_ids").alias("input_ids"),
        F.array_repeat(F.lit(1), F.size("src_ids")).alias("attention_mask"),
        F.col("tgt_ids").alias("labels"),
    )


def unmask_labels(c: Column, pad: int = PAD_ID) -> Column:
    """``np.where(labels != -100, labels, pad)``."""
    return F.transform(c, lambda x: F.when(x == IGNORE_LABEL, F.lit(pad)).otherwise(x))


def clip_ids(c: Column, vocab_size: int) -> Column:
    """``min(max(id, 0), V - 1)``."""
    return F.transform(c, lambda x: F.least(F.greatest(x, F.lit(0)), F.lit(vocab_size - 1)))


def non_pad_len(c: Column, pad: int = PAD_ID) -> Column:
    """Number of non-pad ids."""
    return F.size(F.filter(c, lambda x: x != F.lit(pad)))


def argmax(c: Column) -> Column:
    """0-based index of the first maximum."""
    return F.array_position(c, F.array_max(c)) - 1


def decode_ids(df: DataFrame, key: str, ids_col: str, vocab: DataFrame, out: str = "text") -> DataFrame:
    """``batch_decode(skip_special_tokens=True)``: ids -> words joined by ' '.

    Special and unknown ids are dropped; a row without words decodes to ''.
    ``key`` must be unique.
    """
    vocab = vocab.select(F.col("id").cast("int").alias("id"), "token")
    if blocks.broadcasts(vocab):
        return _decode_exploded(df, key, ids_col, vocab, out)
    packed = blocks.pack_ids(df.select(F.col(key).alias("__key"), F.col(ids_col).cast("array<int>").alias("__i")), "__i", FIRST_WORD_ID)
    texts = blocks.look_up_tokens(packed, vocab, "__i").select(F.col("__key").alias(key), F.col("__i").alias(out))
    return blocks.except_repeated(packed, texts, key, df, lambda rest: _decode_exploded(rest, key, ids_col, vocab, out))


def _decode_exploded(df: DataFrame, key: str, ids_col: str, vocab: DataFrame, out: str) -> DataFrame:
    """``decode_ids`` by one row for each id, for a vocabulary that is broadcast."""
    voc = vocab.select(F.col("id").alias("col"), "token")
    rows = df.select(F.col(key).alias("__key"), F.col(ids_col).alias("__i")).repartition("__key")
    kept = rows.select("__key", F.posexplode_outer(F.filter("__i", lambda x: x >= FIRST_WORD_ID)))
    toks = kept.join(voc, "col", "left")
    word = F.when(F.col("token").isNotNull(), F.struct("pos", "token"))
    g = toks.groupBy("__key").agg(F.sort_array(F.collect_list(word)).alias("__t"))
    return g.select(F.col("__key").alias(key), F.array_join(F.transform("__t", lambda x: x["token"]), " ").alias(out))


def batch_pad(df: DataFrame, key: str, batch_size: int, ids: str = "ids", labels: str = "labels") -> DataFrame:
    """Pad every batch of ``batch_size`` consecutive rows (by ``key``) to
    its longest member: ids with pad, labels with -100, mask with 0."""
    from pyspark.sql import Window

    pos = with_row_pos(df, key, "__pos").withColumn("batch_id", F.floor(F.col("__pos") / batch_size))
    w = Window.partitionBy("batch_id")  # at most batch_size rows per window group
    out = pos.withColumn("__Li", F.max(F.size(ids)).over(w)).withColumn("__Ll", F.max(F.size(labels)).over(w))
    return out.select(
        key,
        "batch_id",
        F.expr(f"concat({ids}, array_repeat({PAD_ID}, __Li - size({ids})))").alias("input_ids"),
        F.expr(f"concat(array_repeat(1, size({ids})), array_repeat(0, __Li - size({ids})))").alias("attention_mask"),
        F.expr(f"concat({labels}, array_repeat({IGNORE_LABEL}, __Ll - size({labels})))").alias("labels"),
    )


def chunk_ids(df: DataFrame, key: str, chunk_size: int = 1000) -> DataFrame:
    """Fixed-size chunk number by position."""
    pos = with_row_pos(df, key, "__pos")
    return pos.withColumn("chunk_id", F.floor(F.col("__pos") / chunk_size)).drop("__pos")
