"""Composite pipelines, each one lazy plan.

Every function takes DataFrames and returns a DataFrame; nothing is collected
except bounded scalars (row counts for positional splits, a mean).  Source
order, which the reference takes from list position, is an explicit
``(part, row_id)`` ordering wherever keep-first semantics depend on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paracorpus.functions import text as tx
from paracorpus.functions.translit import transliterate
from paracorpus.operators import chat, columns, encode, filters, langs, merge, metrics, sample, stats, translate
from paracorpus.session import written
from paracorpus.sources import schemas

AUDIO_SOURCE = "audio-pairs"
BASE_EXCLUDED_SOURCE = "audio"
PRETRAIN_SOURCE = "translation-corpus"


def clean_role_split(src: DataFrame) -> DataFrame:
    """Q1: dedup (english, darija) keep-first -> drop code-like Darija -> column order."""
    d = merge.dedup_keep_first(src, ["english", "darija"], "row_id")
    d = filters.filter_code(d, "darija")
    return d.select("english", "darija", "id", "role", "dataset", "row_id")


def merge_sources(role_clean: DataFrame, scraped: DataFrame, prior: DataFrame) -> DataFrame:
    """Q2: scraped (dropna, dedup) and prior (dropna) concatenated prior-first,
    dedup keep-first, source filled from ``dataset_name``; then the cleaned
    role-split rows are appended, duplicates across the two parts removed
    (keep-first), and ``<unk>`` markers cleaned on both text columns."""
    s = filters.dropna_any(scraped.select("english", "darija_ar", "dataset_source", "row_id"))
    s = merge.dedup_keep_first(s, ["english", "darija_ar"], "row_id")
    p = filters.dropna_any(prior.select("english", "darija_ar", "dataset_name", "row_id"))
    both = merge.union_by_name([p.withColumn("p1", F.lit(0)), s.withColumn("p1", F.lit(1))])
    both = merge.dedup_keep_first(both, ["english", "darija_ar"], ["p1", "row_id"])
    both = columns.coalesce_columns(both, "dataset_source", "dataset_name")
    both = columns.constant_columns(both.select("english", "darija_ar", "dataset_source", "row_id", "p1"), {"id": None, "role": None})
    tulu = columns.rename_positional(
        role_clean.select("english", "darija", "id", "role", "dataset", "row_id"),
        ["english", "darija_ar", "id", "role", "dataset_source", "row_id"],
    )
    final = merge.union_by_name([both.withColumn("p2", F.lit(0)), tulu.withColumn("p1", F.lit(0)).withColumn("p2", F.lit(1))])
    final = merge.dedup_keep_first(final, ["english", "darija_ar"], ["p2", "p1", "row_id"])
    final = final.withColumn("darija_ar", tx.clean_unk(F.col("darija_ar"))).withColumn("english", tx.clean_unk(F.col("english")))
    return final.select("english", "darija_ar", "dataset_source", "id", "role", "row_id", "p1", "p2")


def pretrain_text(merged: DataFrame, transcripts: Sequence[DataFrame], existing: DataFrame) -> DataFrame:
    """Q3: translation Darija + transcripts as ``text`` with a source tag and
    an empty metadata dict, appended to an existing pretraining table."""
    parts = [merged.select(F.col("darija_ar").alias("text"))] + [t.select(F.col(t.columns[0]).alias("text")) for t in transcripts]
    new = merge.union_by_name(parts, allow_missing=False)
    new = columns.constant_columns(new, {"dataset_source": PRETRAIN_SOURCE, "metadata": str({})})
    return merge.union_by_name([existing.select("text", "dataset_source", "metadata"), new], allow_missing=False)


def train_test(base: DataFrame, audio: DataFrame, bench: DataFrame, bad_sources, n_special: int = encode.N_SPECIAL) -> DataFrame:
    """Q4: refine the merged corpus into aligned train/test splits with token
    counts, blacklist filtered; returns one frame with a ``split`` column."""
    schemas.checked(base, schemas.MERGED, "merged corpus")
    b = filters.filter_neq(base, "dataset_source", BASE_EXCLUDED_SOURCE)
    b = b.select("english", "darija_ar", "dataset_source", "id", "role", "row_id").withColumn("darija_Latn", F.lit(""))
    b = columns.rename_positional(b, ["english", "darija_Arab", "dataset_source", "id", "role", "row_id", "darija_Latn"])
    b = b.select("english", "darija_Arab", "darija_Latn", "dataset_source", "id", "role", "row_id")
    d = columns.constant_columns(
        audio.select("english", "darija_Arab", "darija_Latn", "row_id"), {"dataset_source": AUDIO_SOURCE, "id": "", "role": ""}
    )
    train = merge.union_by_name([b.withColumn("part", F.lit(0)), d.withColumn("part", F.lit(1))], allow_missing=False)
    train = filters.dropna_subset(train, ["english", "darija_Arab"])
    train = merge.dedup_keep_first(train, ["english", "darija_Arab"], ["part", "row_id"]).drop("part")
    test = columns.rename_positional(
        bench.select("topic", "subtopic", "arabizi", "english", "darija", "annotator_dialect", "row_id"),
        ["topic", "subtopic", "darija_Latn", "english", "darija_Arab", "annotator_dialect", "row_id"],
    )
    train = train.withColumn("darija_tokens", encode.token_count(F.col("darija_Arab"), n_special))
    test = test.withColumn("darija_tokens", encode.token_count(F.col("darija_Arab"), n_special))
    aligned = columns.align_columns({"train": train, "test": test})
    aligned["train"] = filters.filter_bad_sources(aligned["train"], bad_sources)
    return schemas.checked(merge.split_dict(aligned), schemas.TRAIN_TEST, "train/test")


def weighted_training_sample(train: DataFrame, n: int, seed: int, max_tokens: int = 4096) -> DataFrame:
    """Q5: token-weighted sample of the pairs below ``max_tokens`` (audio
    pairs excluded), plus every audio pair, renamed to the sample schema."""
    train = written(train, "train")  # the merge runs once: the draw and the gathered rows read this
    drawn = sample.sample_with_pinned_source(train, n, seed, "darija_tokens", "dataset_source", AUDIO_SOURCE, max_tokens)
    drawn = drawn.select("row_id", "english", "darija_Arab", "darija_Latn", "dataset_source", "darija_tokens", "draw_rank")
    drawn = columns.rename_columns(drawn, {"darija_Arab": "ary_Arab", "darija_Latn": "ary_Latn", "darija_tokens": "ary_tokens"})
    drawn = drawn.select("row_id", "english", "ary_Arab", "ary_Latn", "ary_tokens", "dataset_source", "draw_rank")
    return schemas.checked(drawn, schemas.SAMPLE, "training sample")


def sample_report(sampled: DataFrame) -> DataFrame:
    """Q5 statistics as (metric, value): total tokens, mean/std markers, histogram, index spread."""
    sampled = written(sampled.select("row_id", "ary_tokens", "draw_rank"), "sampled")
    total = stats.total_tokens(sampled, "ary_tokens")
    markers = stats.token_stats(sampled, "ary_tokens")
    spread = stats.index_spread(sampled.filter(F.col("draw_rank").isNotNull()), "row_id")
    histogram = stats.token_histogram(sampled, "ary_tokens")

    def long(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*[F.col(c).cast("double").alias(c) for c in df.columns]).unpivot([], df.columns, "metric", "value").withColumn(
            "metric", F.concat(F.lit(prefix), "metric")
        )

    bins = histogram.select(F.format_string("bin_%02d", "bin").alias("metric"), F.col("count").cast("double").alias("value"))
    return merge.union_by_name([long(total, ""), long(markers, "tokens_"), long(spread, "index_"), bins], allow_missing=False)


def any_to_any(wide: DataFrame, lang_names: Sequence[str], vocab: DataFrame, seed: int, max_len: int) -> DataFrame:
    """Q6: rows with two usable languages -> random ordered pair -> encoded, padded."""
    codes = langs.lang_code_map("train")
    pairs = langs.random_lang_pair(wide, lang_names, seed)
    pairs = pairs.select(
        "row_id",
        langs.pick_text("src_lang", lang_names).alias("src_text"), F.element_at(codes, F.col("src_lang")).alias("src_code"),
        langs.pick_text("tgt_lang", lang_names).alias("tgt_text"), F.element_at(codes, F.col("tgt_lang")).alias("tgt_code"),
    )
    return encode.encode_pairs(
        pairs, "row_id", (F.col("src_text"), F.col("src_code")), (F.col("tgt_text"), F.col("tgt_code")), vocab, max_len, pad=True
    )


def any_to_any_test(bench: DataFrame, lexicon: DataFrame, targets: Sequence[str], vocab: DataFrame, max_len: int) -> DataFrame:
    """Q6 test split: the bench fanned out to every target language (B2), then
    each (English, translation) pair encoded without padding (R3)."""
    long = translate.lexicon_fanout(bench, "row_id", "english", lexicon, targets)
    pairs = long.join(bench.select("row_id", "english"), "row_id").withColumn("key", F.concat_ws("|", F.col("row_id").cast("string"), "tgt_lang"))
    enc = encode.encode_pairs(
        pairs, "key", (F.col("english"), F.lit("eng_Latn")), (F.col("translation"), F.col("tgt_lang")), vocab, max_len, pad=False
    )
    parts = F.split("key", r"\|")
    return enc.select(parts[0].cast("long").alias("row_id"), parts[1].alias("tgt_lang"), "input_ids", "attention_mask", "labels")


def sft_rows(wide: DataFrame, lang_names: Sequence[str], seed: int, eos: str = chat.DEFAULT_EOS) -> DataFrame:
    """Q7: conversations on random pairs, rendered with the chat template."""
    conv = chat.build_conversation(wide, lang_names, seed)
    return columns.drop_columns(chat.chat_render(conv, "messages", "text", eos), ["messages"]).select("row_id", "text")


def bench_leaderboard(bench: DataFrame, models: Sequence[translate.PyModel]) -> DataFrame:
    """Q8: every model translates the bench; punctuation stripped; BLEU, chrF
    and word edit rate per sentence; unrounded means per model label.

    A failed row counts as an empty hypothesis in every score and in ``n_errors``.
    """
    long = translate.translate_models(bench, "row_id", "english", models)
    refs = bench.select("row_id", F.col("darija").alias("ref"))
    hyp = tx.strip_punct(F.coalesce(F.col("hyp"), F.lit("")))
    pairs = written(
        long.join(refs, "row_id").select("row_id", "model", "status", hyp.alias("hyp"), tx.strip_punct(F.col("ref")).alias("ref")), "bench"
    )
    sc = metrics.score_sentences(pairs, ["row_id", "model"]).join(pairs.select("row_id", "model", "status"), ["row_id", "model"])
    return sc.groupBy(columns.model_label(F.col("model")).alias("label")).agg(
        F.count(F.lit(1)).alias("n_sentences"), F.count_if(F.col("status") != "ok").alias("n_errors"),
        F.avg("bleu").alias("BLEU"), F.avg("chrf").alias("chrF"), F.avg("word_edit_rate").alias("word_edit_rate"),
    )


def v1_prepare_and_score(pairs: DataFrame, vocab: DataFrame, seed: int, test_size: float, max_len: int = 256) -> DataFrame:
    """Q9: select -> dropna -> token total -> random split -> encode (ragged)
    both splits; on the test split a copy baseline (prediction = source ids) is
    scored like v1: labels unmasked, both decoded, trimmed, corpus BLEU (13a)
    and generated length.  Encoding runs once; both uses read what it wrote."""
    p = filters.dropna_subset(pairs.select("row_id", "english", "darija_ar"), ["english", "darija_ar"])
    split = sample.split_random(p, test_size, seed)
    enc = encode.encode_pairs(
        split, "row_id", (F.col("english"), F.lit("eng_Latn")), (F.col("darija_ar"), F.lit("ary_Arab")), vocab, max_len, pad=False
    )
    both = written(enc.join(split.select("row_id", "split", "darija_ar"), "row_id"), "v1_encoded")
    test = both.filter(F.col("split") == "test").select("row_id", "input_ids", "labels")
    test = test.withColumn("labels", encode.pad_to(F.col("labels"), max_len, encode.IGNORE_LABEL))
    test = test.withColumn("labels", encode.unmask_labels(F.col("labels")))
    hyp = encode.decode_ids(test, "row_id", "input_ids", vocab, "hyp")
    ref = encode.decode_ids(test, "row_id", "labels", vocab, "ref")
    text = hyp.join(ref, "row_id").select(
        "row_id", F.lit("copy").alias("model"), tx.ustrip(F.col("hyp")).alias("hyp"), tx.ustrip(F.col("ref")).alias("ref")
    )
    bleu = metrics.corpus_bleu(text, ["model"])
    # one (metric, value) row per figure: unions of small aggregates, no join
    per_split = both.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("input_ids")).alias("input_ids"), F.sum(F.size("labels")).alias("labels")
    )
    per_split = per_split.select(*[F.col(c).cast("double").alias(c) for c in ("n", "input_ids", "labels")], "split").unpivot(
        ["split"], ["n", "input_ids", "labels"], "what", "value"
    )
    return merge.union_by_name([
        per_split.select(F.concat_ws("_", "what", "split").alias("metric"), "value"),
        stats.total_tokens(both.withColumn("t", encode.token_count(F.col("darija_ar"))), "t").select(
            F.lit("total_tokens").alias("metric"), F.col("total_tokens").cast("double").alias("value")
        ),
        bleu.select(F.lit("bleu").alias("metric"), F.col("bleu").alias("value")),
        test.agg(F.lit("gen_len").alias("metric"), F.avg(encode.non_pad_len(F.col("input_ids"))).alias("value")),
    ], allow_missing=False)


def role_split_view(conversations: DataFrame) -> DataFrame:
    """A role-split bilingual table from conversation turns (english + Arabic-script darija)."""
    from paracorpus.fixtures import to_arabic

    return conversations.select(
        (F.lit(3_000_000_000_000) + F.col("conv_id") * F.lit(1_000_000) + F.col("turn")).alias("row_id"),
        F.col("text").alias("english"),
        to_arabic(F.col("text")).alias("darija"),
        F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.col("role"),
        F.lit("conversations").alias("dataset"),
    )


def audio_view(bench: DataFrame) -> DataFrame:
    """Audio-aligned pairs: Arabic script, its Latin transliteration, English."""
    return bench.select(
        (F.col("row_id") + F.lit(2_000_000_000)).alias("row_id"),
        F.col("english"),
        F.col("darija").alias("darija_Arab"),
        transliterate(F.col("darija")).alias("darija_Latn"),
    )
