import zlib

import numpy as np
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from paracorpus.llm import decontaminate, tokens

from . import test_line_quality, test_mixing, test_near_dup
from .helpers import documents, rows


def test_stages_against_brute_force(spark, sf001, tmp_path):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    columns = docs.columns
    steps = [[tuple(r) for r in docs.collect()]]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf001)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        steps.append([tuple(r) for r in docs.collect()])
        if k < 4:
            assert docs.columns == columns
    read, quality, unique, clean, mix, final = steps

    ok = test_line_quality.brute([(d, t, s) for d, t, _, s, _ in read])
    assert sorted(r[0] for r in quality) == sorted(r[0] for r in ok if r[7])
    groups = test_near_dup.brute([(r[0], r[1]) for r in quality], corpus_pipeline.NEAR_PERCENT)
    assert sorted(r[0] for r in unique) == [r[0] for r in groups if r[3]]
    bench = [r["text"] for r in spark.read.parquet(f"{sf001}/benchmark.parquet").collect()]
    leaks = {r[0] for r in unique if any(decontaminate.normal(b) in decontaminate.normal(r[1]) for b in bench)}
    assert {r[0] for r in clean} == {r[0] for r in unique} - leaks
    sizes = {r[0]: len(r[1].split()) for r in clean}
    times = {}
    for r in mix:
        times[r[0]] = times.get(r[0], 0) + 1
    taken = [{"doc_id": d, "size": n, "taken": n * times.get(d, 0)} for d, n in sizes.items()]
    total = {}
    for r in clean:
        total[r[3]] = total.get(r[3], 0) + sizes[r[0]]
    want = dict(zip(sorted(total), test_mixing.targets([total[s] for s in sorted(total)]), strict=True))
    for r in taken:
        assert r["taken"] <= 2 * r["size"]
    got = {}
    for r in mix:
        got[r[3]] = got.get(r[3], 0) + sizes[r[0]]
    assert all(abs(got.get(s, 0) - t) <= max(0.3 * t, max(sizes.values())) for s, t in want.items())
    plain, start = Tokenizer.from_file(tokens.tokenizer_path()), 0
    for (d, text, *_), r in zip(sorted(mix), sorted(final, key=lambda r: r[1]), strict=True):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert r == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()


def test_near_dedup_takes_copies_from_80_percent(spark):
    base = [f"w{i}" for i in range(104)]  # 100 shingles; one changed word takes five of them
    edited = lambda *at: " ".join(f"e{i}" if i in at else w for i, w in enumerate(base))
    docs = [(1, " ".join(base)), (2, edited(40, 60)), (3, edited(30, 50, 70))] + [(10 + k, f"x{k} " * 60) for k in range(3)]
    assert [r[0] for r in test_near_dup.brute(docs, 80) if r[3]] == [1, 3, 10, 11, 12]
    assert [r[0] for r in test_near_dup.brute(docs) if r[3]] == [1, 2, 3, 10, 11, 12]
    out = corpus_pipeline.near_dedup(spark, documents(spark, docs), "")
    assert sorted(r[0] for r in rows(out)) == [1, 3, 10, 11, 12]


def test_near_dedup_on_the_tables_at_80_percent(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    want = [r[0] for r in test_near_dup.brute([(r["doc_id"], r["text"]) for r in docs.collect()], 80) if r[3]]
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, sf001).collect()) == want


def test_stages_on_awkward_rows(spark, sf001):
    """Null ids and texts, repeated rows and ids with several texts; no rows at all."""
    words = lambda key, n: " ".join(f"{key}{i}" for i in range(n))
    bench = spark.read.parquet(f"{sf001}/benchmark.parquet").first()["text"]
    rows_ = [(1, words("a", 80)), (1, words("a", 80)), (1, words("b", 80)), (None, words("c", 80)), (None, words("a", 80)), (2, None), (3, ""),
             (4, words("d", 80)), (4, words("d", 40) + " " + bench), (None, words("e", 60) + " " + bench), (None, words("f", 60))]
    docs = documents(spark, rows_)
    kept = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    want = lambda *drop: sorted((x for k, x in enumerate(rows_) if k not in drop), key=str)
    assert kept(corpus_pipeline.quality_rules(spark, docs, sf001)) == want(5, 6)
    assert kept(corpus_pipeline.near_dedup(spark, docs, sf001)) == want(1, 4)
    assert kept(corpus_pipeline.decontaminated(spark, docs, sf001)) == want(8, 9)
    assert corpus_pipeline.mixed(spark, docs, sf001).columns == docs.columns
    assert len(rows(corpus_pipeline.token_files(spark, docs, sf001))) == len(rows_)
    for _, stage in corpus_pipeline.STAGES:
        assert rows(stage(spark, docs.limit(0), sf001)) == []
