"""Physical-plan checks: native operators stay in the JVM, scans prune and
push down on many-file inputs, metric statistics need one exchange."""

from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.operators import encode, filters, merge, metrics
from paracorpus.plans.q_metrics import KEYS, _stripped
from paracorpus.session import scratch_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_operators_have_no_python(spark, sf001):
    p = fx.pairs(spark, sf001)
    for df in (filters.filter_code(p, "darija_ar"), metrics.ngram_stats(_stripped(spark, sf001), KEYS, "hyp", "ref", 6, "char")):
        text = plan(df)
        assert "PythonUDF" not in text and "MapInPandas" not in text and "BatchEvalPython" not in text


def test_many_file_input_is_scanned_directly_with_pushdown(spark, sf001):
    path = scratch_path(spark, "multi")
    fx.table(spark, sf001, "documents").repartition(12).write.parquet(path)
    df = spark.read.parquet(path)
    q = df.filter(F.col("source") == "src5").select("doc_id")
    text = plan(q)
    assert "PushedFilters: [IsNotNull(source), EqualTo(source,src5)]" in text
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in text


def test_ngram_stats_single_exchange(spark, sf001):
    st = metrics.ngram_stats(_stripped(spark, sf001), KEYS, "hyp", "ref", 4, "word")
    text = plan(st)
    # the up-front hash repartition by (row_id, model) serves all three aggregates
    assert text.count("Exchange hashpartitioning") == 1, text


def test_encode_has_no_token_exchange(spark, sf001):
    p = fx.pairs(spark, sf001).na.drop(subset=["english", "darija_ar"])
    vocab = encode.build_vocab(p.select(F.col("english").alias("t")), "t")
    enc = encode.encode_pairs(p, "row_id", (F.col("english"), F.lit("eng_Latn")), (F.col("darija_ar"), F.lit("ary_Arab")), vocab, 512)
    text = plan(enc)
    above, _, below = text.partition("Generate explode")  # printed from the top down
    assert "Exchange hashpartitioning" not in above and below.count("Exchange hashpartitioning") == 1, text
    assert text.count("FileScan parquet") == 2, text  # texts once, vocabulary once


def test_dedup_does_not_sort_texts(spark, sf001):
    p = fx.pairs(spark, sf001)
    text = plan(merge.dedup_keep_first(p, ["english", "darija_ar"]))
    for line in text.splitlines():
        if "Sort [" in line or "Exchange hashpartitioning" in line or "WindowGroupLimit" in line:
            assert "english" not in line and "darija" not in line, line


def test_weighted_training_sample_reads_the_merge_once(spark, sf001):
    from paracorpus.plans import q_pipelines

    text = plan(q_pipelines.q_pipeline_sample(spark, sf001))
    assert "documents.parquet" not in text and "conversations.parquet" not in text, text
