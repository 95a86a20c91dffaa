import random

import pytest
from pyspark.sql import functions as F

from paracorpus.llm import mixing

from .helpers import WORD, awkward, documents, empty, rows


def targets(totals, weights=(5, 2, 1), share=1.5, cap=2):
    """Water filling, one source at a time; totals in order."""
    w = [weights[k % len(weights)] for k in range(len(totals))]
    full = set()
    while True:
        left = share * sum(totals) - sum(cap * totals[k] for k in full)
        level = left / sum(w[k] for k in range(len(w)) if k not in full) if len(full) < len(w) else 0
        new = {k for k in range(len(w)) if k not in full and level * w[k] > cap * totals[k]}
        if not new:
            return [cap * t if k in full else level * w[k] for k, t in enumerate(totals)]
        full |= new


def check(docs, got, tolerance):
    sizes = {}
    for d, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    want = dict(zip(order, targets([sizes[s] for s in order]), strict=True))
    source = {d: s for d, _, s in docs}
    taken = {}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s], rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(tolerance * want[s], 2), (s, taken[s], want[s])


def corpus(seed=1, n=600):
    rng = random.Random(seed)
    names = ["a", "B", "é", "", "z", "\U0001f642", "￿", None, "hot"]
    pick = lambda: "hot" if rng.random() < 0.4 else rng.choice(names)
    return [(i, " ".join(["w"] * int(rng.paretovariate(1.1) * 5)) if i % 50 else None, pick()) for i in range(n)]


def test_targets_and_totals(spark):
    docs = corpus()
    got = mixing.op10_query(documents(spark, docs)).collect()
    assert len(got) == len(docs)
    check(docs, got, 0.02)


def test_on_the_tables(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    got = mixing.op10_query(docs).collect()
    check([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], got, 0.1)  # ten documents a source


def test_reruns_agree_on_other_layouts(spark):
    docs = documents(spark, corpus(3, 200))
    a, b = (sorted(rows(mixing.mix(d).select("doc_id", "copies"))) for d in (docs.repartition(1), docs.repartition(7)))
    assert a == b


def test_base_rates_tilt_and_cap(spark):
    rows_ = [(i, "w " * 10, "s", 0.1 if i % 2 else 1.0) for i in range(400)] + [(400 + i, "w " * 10, "t", 1.0) for i in range(400)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, source string, q double")
    got = mixing.mix(docs, base_rate="q", weights=(1.0,)).collect()
    by = {}
    for r in got:
        by.setdefault((r["doc_id"] < 400, r["doc_id"] % 2), []).append(r["copies"])
    assert sum(map(sum, by.values())) == pytest.approx(1200, abs=4)
    assert set(by[True, 0]) == {2} and sum(by[True, 1]) == pytest.approx(200, abs=2)  # capped, the rest tilted


def test_dual_meets_targets_exactly(spark):
    docs = spark.createDataFrame([("a", 10, 1.0), ("a", 30, 0.5), ("b", 20, 2.0), ("c", 5, 1.0)], "grp string, size long, base double")
    goal = spark.createDataFrame([("a", 40, 33.0), ("b", 20, 7.0), ("c", 5, 10.0)], "grp string, total long, target double")
    lam = {r["grp"]: r["lam"] for r in mixing.solve_rates(docs, goal, 2.0).collect()}
    from math import exp, inf

    assert 10 * min(2, exp(lam["a"])) + 30 * min(2, 0.5 * exp(lam["a"])) == pytest.approx(33, rel=1e-8)
    assert 20 * 2 * exp(lam["b"]) == pytest.approx(7, rel=1e-8) and lam["c"] == inf


def test_mixed_documents_repeat_rows(spark):
    docs = documents(spark, corpus(5, 150) + [(7, "same text here", "a")] * 3)
    copies = mixing.mix(docs).groupBy("doc_id").agg(F.sum("copies").alias("n"))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {r["doc_id"]: r["n"] for r in copies.collect() if r["n"]}


def test_awkward_rows(spark):
    got = mixing.op10_query(awkward(spark)).collect()
    assert len(got) == 9 and {r["doc_id"]: r["size"] for r in got}[2] == 0
    assert rows(mixing.op10_query(empty(spark))) == []
    assert mixing.mixed_documents(awkward(spark)).columns == awkward(spark).columns
    nothing = mixing.op10_query(documents(spark, [(1, None), (2, "")])).collect()
    assert [r["taken"] for r in nothing] == [0, 0]


@pytest.mark.parametrize("share", [1.5, 0.3])
def test_residual_of_a_giant_document_is_made_up(spark, share):
    rng = random.Random(7)
    sizes = {0: 200_000} | {i: rng.randrange(200, 300) for i in range(1, 2001)}
    docs = spark.createDataFrame([(i, n, s) for s in ("a", None) for i, n in sizes.items()], "doc_id long, n int, source string")
    docs = docs.select(F.col("doc_id"), F.expr("repeat('w ', n)").alias("text"), "source")
    mixed = mixing.mix(docs, weights=(1.0,), share=share)
    got = mixed.collect()
    assert len(got) == 2 * len(sizes) and all(0 <= r["copies"] <= 2 for r in got)
    assert abs(sum(r["taken"] for r in got) - 2 * got[0]["target"]) < 2 * 300  # two equal sources


def test_residual_passes_gaps_of_size(spark):
    """Documents far smaller than the ones that no longer fit make up the rest, by second copies too."""
    rows_ = [(i, 0, "s", n) for i, n in enumerate([900, 900, 900, *[10] * 300])]
    df = spark.createDataFrame([(i, c, g, n, 0.5, 4500.0) for i, c, g, n in rows_], "pos long, copies int, grp string, size long, rate double, target double")
    change = {r["pos"]: r["change"] for r in mixing._made_up(df, 2).collect()}
    assert sum(rows_[p][3] * c for p, c in change.items()) == 4500 and max(change.values()) <= 2
    lower = df.withColumn("copies", F.lit(2)).withColumn("target", F.lit(1234.0))
    change = {r["pos"]: r["change"] for r in mixing._made_up(lower, 2).collect()}
    assert sum(rows_[p][3] * (2 + change.get(p, 0)) for p in range(len(rows_))) == 1240 and min(change.values()) >= -2
