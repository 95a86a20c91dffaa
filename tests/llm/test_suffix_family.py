import hashlib
import random

import numpy as np
import pytest

from paracorpus.llm import suffix_family as family

from .helpers import awkward, documents, empty, rows


def brute(docs):
    low = lambda d: -(10**30) if d is None else d
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            w = b[i : i + 50]
            first[w] = min(first.get(w, low(d)), low(d))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < low(d):
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, ids):
    rng = random.Random(seed)
    phrases = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(20, 130))) for _ in range(12)]
    docs = []
    for i in range(130):
        text = ""
        for _ in range(rng.randint(0, 8)):
            r = rng.random()
            if r < 0.4:
                text += rng.choice(phrases)
            elif r < 0.55:
                text += rng.choice("-a ") * rng.randint(1, 120)
            elif r < 0.65 and docs:
                other = rng.choice(docs)[1] or ""
                a = rng.randint(0, len(other))
                text += other[a : a + rng.randint(0, 200)]
            else:
                text += "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 60)))
        docs.append((ids(rng, i), None if rng.random() < 0.05 else text))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("ids", ["unique", "repeated and null"])
def test_many_small_batches_and_ranges(spark, monkeypatch, ids):
    monkeypatch.setattr(family, "BATCH_BYTES", 2000), monkeypatch.setattr(family, "SLICE", 300), monkeypatch.setattr(family, "RANGE_ENTRIES", 40)
    for seed in (3, 4):
        docs = corpus(seed, (lambda rng, i: i) if ids == "unique" else lambda rng, i: None if rng.random() < 0.05 else rng.randint(0, 60))
        got = family.op13_query(documents(spark, docs).repartition(5))
        assert sorted(rows(got), key=str) == brute(docs)


def test_query_on_the_tables(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    got = family.repeated_strings(docs).collect()
    texts = {r["doc_id"]: (r["text"] or "") for r in docs.collect()}
    want = brute(list(texts.items()))
    assert sorted((tuple(r)[:5] for r in got), key=str) == want and sum(r[2] for r in want) > 0
    for r in got:
        raw = texts[r["doc_id"]].encode()
        kept = b"".join(raw[a:b] for a, b in zip([0, *[s["end"] for s in r["spans"]]], [*[s["start"] for s in r["spans"]], len(raw)], strict=True))
        assert hashlib.sha256(kept).hexdigest() == r["kept_sha256"]


def test_levels_are_geometric_and_hold_all():
    rng = np.random.default_rng(1)
    index, every = family.Family(), np.zeros((2, 0), np.uint64)
    for n in range(1, 20):
        keys = family.Family.merged(rng.integers(0, 40, (2, 30)).astype(np.uint64), np.zeros((2, 0), np.uint64))
        known = {tuple(x) for x in every.T.tolist()}
        assert index.scan(keys).tolist() == [tuple(x) in known for x in keys.T.tolist()]
        index.add(keys)
        every = family.Family.merged(every, keys)
        assert [x is not None for x in index.levels] == [c == "1" for c in reversed(f"{n:b}")]
        assert (index.all() == every).all()


def test_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    docs = [(1, long), (2, "short"), (3, None), (4, ""), (5, "x" + long[1000:1300]), (5, "x" + long[1000:1300]), (None, long[500:1200]), (6, "é" * 49), (7, "é" * 49)]
    got = sorted(rows(family.op13_query(documents(spark, docs))), key=str)
    kept = {r[0]: r for r in got}
    assert kept[1][2] == 700 and kept[5][2] == 300 and kept[None][2] == 0 and kept[7][2] == 98 and kept[6][2] == 0 and len(got) == 9
    assert rows(family.op13_query(empty(spark))) == []
    texts = [(r["doc_id"], (r["text"] or "")) for r in awkward(spark).collect()]
    assert sorted(rows(family.op13_query(awkward(spark))), key=str) == brute([(d, t) for d, t in texts])
