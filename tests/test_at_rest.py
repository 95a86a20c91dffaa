"""Selection, ordered files, published commits and the keep-first index."""

import random

import pytest
from pyspark.sql import functions as F

from paracorpus import fixtures as fx
from paracorpus.operators import sample, select
from paracorpus.operators.keepfirst import KeepFirst
from paracorpus.plans import q_rest
from paracorpus.session import scratch_path
from paracorpus.sources import commits, ordered


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def brute_before(values, position):
    order = sorted(values, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    return {r[1] for r in order[: max(position, 0)]}


@pytest.mark.parametrize("kind", ["spread", "equal", "few", "huge", "nulls"])
def test_cut_against_sorting(spark, monkeypatch, kind):
    monkeypatch.setattr(select, "BINS", 7)
    monkeypatch.setattr(select, "FEW", 5)
    rng = random.Random(kind)
    draw = {
        "spread": lambda: rng.randrange(1 << 52), "equal": lambda: 9, "few": lambda: rng.randrange(4),
        "huge": lambda: rng.choice([-(1 << 63), (1 << 63) - 1, rng.randrange(-(1 << 63), 1 << 63)]), "nulls": lambda: rng.choice([None, None, 3, 8]),
    }[kind]
    rows = [(draw(), i) for i in range(120)]
    df = spark.createDataFrame(rows, "v long, t long").repartition(4)
    for position in (-1, 0, 1, 50, 119, 120, 500):
        cut = select.cut_at(df, position, "v", "t")
        got = {r["t"] for r in df.filter(cut.before(F.col("v"), F.col("t"))).collect()}
        assert got == brute_before(rows, position), position


def test_splits_and_slices_move_no_text(spark, sf001):
    p = fx.pairs(spark, sf001)
    n = p.count()
    for df in (sample.split_random(p, 0.1, 7), sample.split_positional(p, 0.1)):
        assert "Exchange" not in plan(df), plan(df)
        assert df.count() == n
    moved = [x for x in plan(sample.slice_rows(p, 10, 20)).splitlines() if "Exchange" in x]
    assert not any("english" in x or "darija" in x for x in moved), moved
    assert sample.slice_rows(p, n - 3, n + 9).count() == 3 and sample.slice_rows(p, 5, 5).count() == 0
    assert sample.slice_rows(p, -4, 2).count() == 2


def test_row_at_rest_reads_one_file_of_twelve(spark, sf001):
    path = scratch_path(spark, "ordered")
    p = fx.pairs(spark, sf001)
    ordered.write_ordered(p, path, "row_id", 12)
    zones = ordered.zone_map(spark, path).orderBy("first").collect()
    assert len(zones) == 12 and sum(z["n"] for z in zones) == p.count()
    assert all(a["high"] < b["low"] and a["first"] + a["n"] == b["first"] for a, b in zip(zones, zones[1:], strict=False))
    keys = sorted(r["row_id"] for r in p.select("row_id").collect())
    for i in (0, 1, len(keys) // 2, len(keys) - 1):
        row = ordered.read_row(spark, path, i, p.schema)
        assert len(row.inputFiles()) == 1
        assert [(r["row_id"], r["row_pos"]) for r in row.collect()] == [(keys[i], i)]
    assert ordered.read_row(spark, path, len(keys)).count() == 0
    wanted = spark.createDataFrame([(keys[3], "a"), (None, "b"), (-5, "c")], "row_id long, note string")
    got = ordered.read_keys(spark, path, wanted)
    assert len(got.inputFiles()) == 1 and [(r["row_id"], r["note"], r["row_pos"]) for r in got.collect()] == [(keys[3], "a", 3)]


def test_a_killed_write_leaves_the_former_rows(spark):
    path = scratch_path(spark, "commits")
    with pytest.raises(FileNotFoundError):
        commits.read_commit(spark, path)
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, None)], "id int, text string, split string")
    first = commits.write_commit(rows, path, ["split"], "first")
    assert (first["number"], first["rows"]) == (0, 3)
    half = rows.withColumn("text", F.when(F.col("id") == 2, F.raise_error(F.lit("killed"))).otherwise(F.lit("new")))
    with pytest.raises(Exception, match="killed"):
        commits.write_commit(half, path, ["split"], "half")
    read = lambda k=None: sorted((tuple(r) for r in commits.read_commit(spark, path, k).select("id", "text", "split").collect()))
    assert read() == [(1, "a", "x"), (2, "b", "y"), (3, None, None)]
    commits.write_commit(rows.filter("id = 2").withColumn("text", F.lit("c")), path, ["split"], "second")
    assert read() == [(1, "a", "x"), (2, "c", "y"), (3, None, None)] and read(0)[1] == (2, "b", "y")
    with pytest.raises(commits.CommitConflict):
        commits._publish(spark, path, 1, {})


def test_sources_one_by_one_equal_the_batch(spark, sf001):
    pairs = fx.pairs(spark, sf001)
    kept = KeepFirst(spark, scratch_path(spark, "kept"), q_rest.KEYS, buckets=4, blocks=2)
    for number in range(3):
        source = pairs.filter(F.col("row_id") % 3 == number)
        kept.append(source, number)
        kept.append(source, number)  # again, as after a failure
    want = {r["row_id"] for r in q_rest.batch_dedup(pairs).select("row_id").collect()}
    got = [r["row_id"] for r in kept.rows().select("row_id").collect()]
    assert len(got) == len(want) and set(got) == want and len(want) < pairs.count()


def test_the_index_is_not_moved_and_the_filter_passes_few(spark, sf001):
    pairs = fx.pairs(spark, sf001)
    kept = KeepFirst(spark, scratch_path(spark, "kept"), ("row_id",), buckets=8, blocks=2)
    kept.append(pairs.filter("row_id % 2 = 0"), 0)
    keys = pairs.select(*[c.alias(k) for k, c in zip(("k1", "k2"), q_rest.merge.key_hash(["row_id"]), strict=True)])
    old = pairs.filter("row_id % 2 = 0").count()
    maybe = kept._may_be_known(keys).count()
    assert old <= maybe <= old + max(5, 0.1 * old)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(kept.index().join(keys, ["k1", "k2"], "left_semi"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1, text


def test_null_keys_and_empty_sources(spark):
    schema = "row_id long, a string, b string"
    kept = KeepFirst(spark, scratch_path(spark, "kept"), ("a", "b"), buckets=2, blocks=1)
    kept.append(spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, "x", None)], schema), 0)
    kept.append(spark.createDataFrame([], schema), 1)
    kept.append(spark.createDataFrame([(4, None, "x"), (5, None, None), (6, "x", None)], schema), 2)
    assert sorted((r["row_id"], r["source_no"]) for r in kept.rows().collect()) == [(1, 0), (3, 0), (5, 2)]


def test_ordered_files_stay_below_a_size(spark, monkeypatch):
    monkeypatch.setattr(ordered, "FILE_BYTES", 4000)
    rows = spark.range(900).select(F.col("id").alias("row_id"), F.repeat(F.lit("x"), 90).alias("t"), F.array(F.lit("y")).alias("a"))
    path = scratch_path(spark, "ordered")
    ordered.write_ordered(rows, path, "row_id", 3)
    zones = ordered.zone_map(spark, path).orderBy("first").collect()
    assert len(zones) > 15 and max(z["n"] for z in zones) < 120 and sum(z["n"] for z in zones) == 900
    assert all(a["high"] < b["low"] and a["first"] + a["n"] == b["first"] for a, b in zip(zones, zones[1:], strict=False))
    assert [(r["row_id"], r["row_pos"]) for r in ordered.read_row(spark, path, 137, rows.schema).collect()] == [(137, 137)]
