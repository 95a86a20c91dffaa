"""Operator micro fixtures (FIXTURES.md section 3) and properties."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.operators import columns, encode, filters, merge, rowid, sample, stats


def test_dedup_keep_first_nulls_equal(spark):
    df = spark.createDataFrame([(1, "x", "y"), (2, "x", "y"), (3, "x", None), (4, "x", None)], "row_id long, a string, b string")
    got = sorted(r.row_id for r in merge.dedup_keep_first(df, ["a", "b"]).collect())
    assert got == [1, 3]


def test_dedup_is_idempotent(spark):
    df = spark.range(200).select(F.col("id").alias("row_id"), (F.col("id") % 7).cast("string").alias("a"))
    once = merge.dedup_keep_first(df, ["a"])
    twice = merge.dedup_keep_first(once, ["a"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_dedup_plan_has_group_limit(spark):
    df = spark.range(100).select(F.col("id").alias("row_id"), (F.col("id") % 3).alias("k"))
    plan = merge.dedup_keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_neq_keeps_null(spark):
    df = spark.createDataFrame([("audio",), ("a",), (None,)], "s string")
    assert sorted(r.s or "" for r in filters.filter_neq(df, "s", "audio").collect()) == ["", "a"]


def test_blacklist_keeps_null(spark):
    df = spark.createDataFrame([("src3",), ("a",), (None,)], "s string")
    bad = spark.createDataFrame([("src3",)], "source string")
    for b in (["src3"], bad):
        assert sorted(r.s or "" for r in filters.filter_bad_sources(df, b, "s").collect()) == ["", "a"]


def test_dropna_any(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), ("a", "")], "x string, y string")
    assert sorted(filters.dropna_any(df).collect()) == sorted([("a", "b"), ("a", "")])


def test_align_columns_fills_empty_string(spark):
    train = spark.createDataFrame([(1, "i")], "row_id long, id string")
    test = spark.createDataFrame([(2,)], "row_id long")
    out = columns.align_columns({"train": train, "test": test})
    assert out["test"].first()["id"] == ""


def test_histogram_last_bin_closed(spark):
    df = spark.range(0, 51).select(F.col("id").cast("int").alias("t"))
    h = {r.bin: r["count"] for r in stats.token_histogram(df, "t").collect()}
    assert len(h) == 50 and all(h[b] == 1 for b in range(1, 50)) and h[50] == 2


def test_histogram_all_equal(spark):
    df = spark.createDataFrame([(7,), (7,)], "t int")
    h = {r.bin: r["count"] for r in stats.token_histogram(df, "t").collect()}
    assert sum(h.values()) == 2 and h[26] == 2  # numpy widens the range by 0.5


def test_index_spread(spark):
    df = spark.createDataFrame([(1,), (2,), (5,)], "i long")
    r = stats.index_spread(df, "i").first()
    assert (r.mean_gap, r.min_gap, r.max_gap, r.consecutive, r.pct_consecutive) == (2.0, 1, 3, 1, 50.0)


def test_split_positional_float_semantics(spark):
    df = spark.range(10).withColumnRenamed("id", "row_id")
    out = sample.split_positional(df, 0.9)
    assert out.filter(F.col("split") == "train").count() == 0  # int(10 * (1 - 0.9)) == 0


def test_split_random_disjoint_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_id")
    out = sample.split_random(df, 0.01, 1998)
    assert out.count() == 1000 and out.filter(F.col("split") == "test").count() == 10


def test_sample_larger_than_population(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "row_id long, t int")
    got = sample.weighted_sample(df, 10, 1998, "t").collect()
    assert sorted(r.row_id for r in got) == [1, 2, 3] and sorted(r.draw_rank for r in got) == [1, 2, 3]


def test_sample_size_and_no_repeats(spark):
    df = spark.range(500).select(F.col("id").alias("row_id"), (F.col("id") % 50).cast("int").alias("t"))
    got = [r.row_id for r in sample.weighted_sample(df, 100, 1, "t").collect()]
    assert len(got) == 100 and len(set(got)) == 100


def test_sample_prefers_heavy_rows(spark):
    # exp weighting: rows with 10x the mean token count dominate the sample
    df = spark.range(400).select(F.col("id").alias("row_id"), F.when(F.col("id") < 20, 200).otherwise(1).alias("t"))
    got = [r.row_id for r in sample.weighted_sample(df, 20, 5, "t").collect()]
    assert sum(1 for i in got if i < 20) >= 18


def test_row_pos_dense_with_many_buckets(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5003).alias("k"), (F.col("id") % 3).alias("g"))
    out = rowid.with_row_pos(df, "k", "pos", ranges=17)
    pos = sorted((r.k, r.pos) for r in out.collect())
    assert [p for _, p in pos] == list(range(5000))
    per = rowid.with_row_pos(df, "k", "pos", partition_cols="g", ranges=17).collect()
    for g in range(3):
        rows = sorted((r.k, r.pos) for r in per if r.g == g)
        assert [p for _, p in rows] == list(range(len(rows)))


def test_results_independent_of_partitioning(spark):
    base = spark.range(300).select(F.col("id").alias("row_id"), (F.col("id") % 37).cast("int").alias("t"),
                                   (F.col("id") % 5).cast("string").alias("a"))
    def run(df):
        s = sorted(r.row_id for r in sample.weighted_sample(df, 40, 9, "t").collect())
        d = sorted(r.row_id for r in merge.dedup_keep_first(df, ["a"]).collect())
        p = sorted((r.row_id, r.shuffle_pos) for r in sample.seeded_shuffle(df, 9).collect())
        return s, d, p
    assert run(base.repartition(1)) == run(base.repartition(13))


def test_union_count_is_sum(spark):
    a, b = spark.range(10), spark.range(7)
    assert merge.union_by_name([a, b]).count() == 17


def test_id_array_helpers(spark):
    df = spark.createDataFrame([([3, -100, 4], [-1, 2, 9], [1.0, 3.0, 3.0], [5, 0, 7, 0])],
                               "lab array<int>, ids array<int>, v array<float>, p array<int>")
    r = df.select(encode.unmask_labels(F.col("lab")).alias("u"), encode.clip_ids(F.col("ids"), 5).alias("c"),
                  encode.argmax(F.col("v")).alias("a"), encode.non_pad_len(F.col("p")).alias("n")).first()
    assert list(r.u) == [3, 0, 4] and list(r.c) == [0, 2, 4] and r.a == 1 and r.n == 2


def test_batch_pad(spark):
    df = spark.createDataFrame([(1, [1], [4]), (2, [2, 3], [5, 6])], "row_id long, ids array<int>, labels array<int>")
    rows = {r.row_id: r for r in encode.batch_pad(df, "row_id", 2).collect()}
    assert list(rows[1].input_ids) == [1, 0] and list(rows[1].labels) == [4, -100]
    assert list(rows[1].attention_mask) == [1, 0] and list(rows[2].input_ids) == [2, 3]


def test_encode_decode_roundtrip(spark):
    df = spark.createDataFrame([(1, "a b c a", "x y"), (2, "", "z")], "row_id long, s string, t string")
    vocab = encode.build_vocab(df.select(F.col("s").alias("x")).unionByName(df.select(F.col("t").alias("x"))), "x")
    enc = encode.encode_pairs(df, "row_id", (F.col("s"), F.lit("eng_Latn")), (F.col("t"), F.lit("ary_Arab")), vocab, 5, pad=True)
    rows = {r.row_id: r for r in enc.collect()}
    assert len(rows[1].input_ids) == 5 and rows[1].input_ids[-1] == encode.EOS_ID  # tag + 3 words + eos
    assert list(rows[2].attention_mask) == [1, 1, 0, 0, 0]
    dec = {r.row_id: r.text for r in encode.decode_ids(enc, "row_id", "input_ids", vocab).collect()}
    assert dec == {1: "a b c", 2: ""}


def test_shuffled_vocab_join_equals_broadcast(spark):
    df = spark.range(300).select(F.col("id").alias("row_id"), F.concat_ws(" ", F.lit("the"), F.concat(F.lit("w"), F.col("id") % 50), F.lit("the")).alias("s"))
    vocab = encode.build_vocab(df, "s")

    def run():
        enc = encode.encode_sides(df, "row_id", {"x": (F.col("s"), F.lit("eng_Latn"))}, vocab, None)
        return sorted((r.row_id, tuple(r.x_ids)) for r in enc.collect()), sorted(tuple(r) for r in encode.decode_ids(enc, "row_id", "x_ids", vocab).collect())

    small = run()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert dict(small[1]) == {r.row_id: r.s for r in df.collect()}


def test_ragged_encoding_of_a_missing_text(spark):
    df = spark.createDataFrame([(1, "a b", None), (2, "None", "a")], "row_id long, s string, t string")
    vocab = encode.build_vocab(df, "s")
    enc = encode.encode_pairs(df, "row_id", (F.col("s"), F.lit("eng_Latn")), (F.col("t"), F.lit("ary_Arab")), vocab, 9, pad=False)
    rows = {r.row_id: r for r in enc.collect()}
    assert rows[1].labels[1:] == rows[2].input_ids[1:] and len(rows[1].labels) == 3


def test_row_pos_keeps_null_keys_and_groups(spark):
    df = spark.range(1000).select(
        F.col("id"), F.when(F.col("id") % 10 > 0, F.col("id") * 7 % 1009).alias("k"), F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("g")
    )
    for ranges in (1, 10):
        out = rowid.with_row_pos(df, ["k", "id"], "pos", ranges=ranges).collect()
        assert sorted(r.pos for r in out) == list(range(1000))
        assert sorted(r.pos for r in out if r.k is None) == list(range(100))  # null first
        per = rowid.with_row_pos(df, ["k", "id"], "pos", partition_cols="g", ranges=ranges).collect()
        for g in (None, 1, 2, 3):
            assert sorted(r.pos for r in per if r.g == g) == list(range(250))
    assert rowid.with_row_pos(df.limit(0), "k").count() == 0


def test_dedup_tells_null_places_apart(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, "x"), (3, None, "x")], "row_id long, a string, b string")
    assert sorted(r.row_id for r in merge.dedup_keep_first(df, ["a", "b"]).collect()) == [1, 2]


def test_tables_are_read_afresh(spark, tmp_path):
    from paracorpus import fixtures as fx

    for n in (10, 25):
        spark.range(n).write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
        assert fx.table(spark, str(tmp_path), "t").count() == n


def test_weightless_rows_are_never_drawn(spark):
    df = spark.range(100).select(
        F.col("id").alias("row_id"), F.when(F.col("id") < 5, 0).when(F.col("id") < 10, None).otherwise(3).cast("int").alias("t")
    )
    linear = [r.row_id for r in sample.weighted_sample(df, 100, 3, "t", weighting="linear").collect()]
    assert sorted(linear) == list(range(10, 100))
    exp = [r.row_id for r in sample.weighted_sample(df, 5, 3, "t").collect()]
    assert len(exp) == 5 and not set(exp) & set(range(5, 10))
    assert sample.weighted_sample(df.limit(0), 5, 3, "t").count() == 0


def test_first_draw_follows_the_weights(spark):
    df = spark.createDataFrame([(0, 1), (1, 2), (2, 5)], "row_id long, t int")
    first = [0, 0, 0]
    for seed in range(150):
        keys = sample.uniform(F.col("row_id"), str(seed))
        race = F.ln(-F.ln(keys)) - F.ln("t")  # the law that draw_ranks sorts by
        first[df.select("row_id", race.alias("k")).orderBy("k").first().row_id] += 1
    assert abs(first[0] / 150 - 1 / 8) < 0.1 and abs(first[2] / 150 - 5 / 8) < 0.13
    one = sample.draw_ranks(df, 1, 7, "t", weighting="linear").collect()
    assert len(one) == 1 and one[0].draw_rank == 1


def test_token_limit_report(spark):
    df = spark.createDataFrame([(1, "a"), (9, "a"), (None, None), (2, "x"), (3, None)], "t int, s string")
    assert tuple(filters.max_tokens_report(df, "t", 5, "s", "x").first()) == (2, 1, 1, 1)


def test_sinks_leave_the_session_alone(spark, tmp_path):
    from paracorpus.sources import dataset as ds

    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    a = spark.createDataFrame([(1, 5, "train"), (2, 6, "test")], "row_id long, n int, split string")
    path = str(tmp_path / "d")
    assert ds.write_dataset(a, path, "one", tokens_col="n") == {"message": "one", "rows": 2, "tokens": 11}
    b = a.filter("split = 'test'").withColumn("n", F.lit(7))
    assert ds.write_dataset(b, path, "two", tokens_col="n") == {"message": "two", "rows": 1, "tokens": 7}
    got = sorted(tuple(r) for r in ds.read_all_splits(spark, path).select("row_id", "n", "split").collect())
    assert got == [(1, 5, "train"), (2, 7, "test")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert ds.finished_keys(spark, str(tmp_path / "none"), ["row_id"]) is None
    assert ds.finished_keys(spark, path, ["row_id"]).count() == 2


def test_half_failing_model(spark):
    from paracorpus.operators import translate
    from paracorpus.plans import pipelines
    from paracorpus.plans.q_io import HALF_MODEL

    bench = spark.createDataFrame([(i, "ab" * 3 if i % 2 else "abc", "x y") for i in range(40)], "row_id long, english string, darija string")
    long = translate.translate_models(bench, "row_id", "english", [HALF_MODEL]).collect()
    assert {r.row_id for r in long if r.status == "error"} == set(range(0, 40, 2))
    assert all(r.error == "ValueError: text of odd length" for r in long if r.status == "error")
    board = pipelines.bench_leaderboard(bench, [HALF_MODEL]).first()
    assert (board.n_sentences, board.n_errors) == (40, 20)
    assert board.word_edit_rate == 100.0  # a failed row is an empty hypothesis, not a missing score


def test_progressive_sink_raises_read_failures(spark, tmp_path):
    import pytest
    from paracorpus.operators import translate
    from paracorpus.plans.q_io import HALF_MODEL

    path = tmp_path / "sink"
    path.mkdir()
    (path / "part-0.parquet").write_text("no parquet")
    df = spark.createDataFrame([(1, "ab")], "row_id long, english string")
    with pytest.raises(Exception):
        translate.translate_progressive(df, "row_id", "english", HALF_MODEL, ["a"], str(path), 0)


def test_stage_schemas_are_checked(spark):
    import pytest
    from paracorpus.sources import schemas

    good = spark.createDataFrame([], schemas.SAMPLE).withColumn("more", F.lit(1))
    assert schemas.checked(good, schemas.SAMPLE, "s") is good
    with pytest.raises(ValueError, match="s: ary_tokens: bigint, draw_rank: missing"):
        schemas.checked(good.withColumn("ary_tokens", F.lit(1).cast("long")).drop("draw_rank"), schemas.SAMPLE, "s")


@pytest.fixture()
def large_vocab(spark):
    """Every vocabulary counts as too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_blocks_equal_one_row_per_token(spark, large_vocab, monkeypatch):
    monkeypatch.setattr(encode.blocks, "SLICE_ROWS", 3)
    monkeypatch.setattr(encode.blocks, "BLOCK_WORDS", 20)
    texts = ["a b  c a \x1fd", "", None, "   ", "ت تت a", "x " * 9, "unseen words here a"]
    rows = [(None if i == 40 else str(i), texts[i % 7], texts[i % 5], "eng_Latn" if i % 2 else "none") for i in range(60)]
    rows += [("3", "q a", "b", "eng_Latn"), (None, "b a", None, "eng_Latn"), ("9", "a", "a", "ary_Arab"), ("9", "c", "c", "ary_Arab")]
    df = spark.createDataFrame(rows, "k string, s string, t string, code string").repartition(3, "k")
    vocab = encode.build_vocab(df.select("s").filter("s not like 'unseen%'"), "s")
    got = {r.token: r.freq for r in vocab.collect()}
    assert got == Counter(w for r in rows if r[1] and not r[1].startswith("unseen") for w in r[1].split())
    order = sorted(vocab.collect(), key=lambda r: r.id)
    assert [r.id for r in order] == list(range(100, 100 + len(got))) and all(a.freq >= b.freq for a, b in zip(order, order[1:], strict=False))
    for keep in (None, 2, 4, 7):
        sides = {"s": (F.col("s"), F.lit("eng_Latn")), "t": (F.col("t"), F.lit("ary_Arab"))}
        enc = encode.encode_sides(df, "k", sides, vocab, keep)
        plain = encode._encode_exploded(df, "k", sides, vocab.select("token", "id"), keep)
        as_rows = lambda d: sorted(((r[0] or "", *map(tuple, r[1:])) for r in d.collect()))
        assert as_rows(enc) == as_rows(plain)
        dec = encode.decode_ids(enc, "k", "s_ids", vocab)
        assert sorted(map(str, dec.collect())) == sorted(map(str, encode._decode_exploded(enc, "k", "s_ids", vocab.select(F.col("id").cast("int").alias("id"), "token"), "text").collect()))


def test_a_large_vocabulary_meets_distinct_words_only(spark, large_vocab):
    df = spark.range(2000).select(F.col("id").alias("row_id"), F.repeat(F.lit("the cat sat "), 20).alias("s"))
    vocab = encode.build_vocab(df, "s")
    enc = encode.encode_sides(df, "row_id", {"x": (F.col("s"), F.lit("eng_Latn"))}, vocab, None)
    text = enc._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in text.splitlines() if "Exchange" in x]
    assert moved and not any("side" in x or "pos" in x for x in moved), text
    packed = encode.blocks.pack_texts(df.withColumnRenamed("row_id", "__key"), ["s"], None)
    assert packed.agg(F.sum(F.size("words"))).first()[0] <= 3 * packed.count()


def test_a_null_test_computes_no_text(spark, sf001):
    p = filters.dropna_subset(fx.pairs(spark, sf001), ["english", "darija_ar"]).select("english")
    assert "translate" not in p._jdf.queryExecution().optimizedPlan().toString()
    d = spark.createDataFrame([(1, 1.0), (None, 2.0), (3, float("nan")), (4, None)], "a int, b double")
    assert [r.a for r in filters.dropna_subset(d, ["a", "b"]).collect()] == [1]
