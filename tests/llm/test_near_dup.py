import random

import numpy as np
from pyspark.sql import functions as F

from paracorpus.llm import near_dup

from .helpers import WORD, awkward, documents, empty, rows

LOWER = {i: i + 32 for i in range(65, 91)}


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs, percent=85):
    sets = [(d, shingle_set(t)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets)


def family(rng, n_words, copies, edits):
    base = [f"w{rng.randrange(500)}" for _ in range(n_words)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        yield " ".join(w)


def corpus(seed, groups=12):
    rng = random.Random(seed)
    texts = [t for _ in range(groups) for t in family(rng, rng.choice([4, 8, 60, 200]), rng.choice([1, 2, 9]), rng.choice([0, 1, 3, 6]))]
    shared = " ".join(f"p{i}" for i in range(60))
    texts += [shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.choice([10, 40]))) for _ in range(30)]
    texts += ["", "  ", "A b C", "a B c", None]
    rng.shuffle(texts)
    return list(enumerate(texts, 1))


def test_shingles_match_sets():
    for _, text in corpus(3):
        assert len(near_dup.shingles(text)) == len(shingle_set(text))
    assert (near_dup.shingles("A b\tc\x0bd  é") == near_dup.shingles("a B c d é")).all()
    assert len(near_dup.shingles("a b c")) == 1  # no-break space is no blank


def test_components_against_brute_force(spark):
    for seed in (1, 2):
        docs = corpus(seed)
        assert sorted(r[:4] for r in rows(near_dup.near_duplicates(documents(spark, docs)))) == brute(docs)


def test_buckets_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    docs = corpus(5, groups=4) + [(1000 + i, t) for i, t in enumerate(family(random.Random(9), 120, 40, 14))]
    assert sorted(r[:4] for r in rows(near_dup.near_duplicates(documents(spark, docs)))) == brute(docs)


def test_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 200), (150, 200)], "a long, b long")
    got = dict(rows(near_dup.components(links)))
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 150: 100, 200: 100}


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    limit = near_dup.most_differing(0.85)
    pool = rng.integers(1, 1 << 63, 4000, dtype=np.uint64)
    for k, similar in ((80, True), (2000, False)):
        a, b = pool[:2000], pool[k : 2000 + k]
        x, y = (near_dup.odd_sketch(near_dup.signature(s)).view(np.uint64) for s in (a, b))
        assert bool(np.bitwise_count(x ^ y).sum() <= limit) == similar


def test_awkward_rows(spark):
    got = rows(near_dup.near_duplicates(awkward(spark)))
    assert len(got) == 9
    by = {}
    for r in got:
        by.setdefault(r[0], []).append(r[1:4])
    assert by[1] == [(8, 1, True)] * 2 and by[2] == [(0, 2, True)] and by[4] == [(0, 4, True)]
    assert by[None] == [(1, None, True)]
    assert rows(near_dup.near_duplicates(empty(spark))) == []


def test_no_pairs_inside_a_component(spark):
    docs = documents(spark, list(enumerate(family(random.Random(4), 300, 150, 2), 1)))
    got = near_dup.near_duplicates(docs)
    assert got.agg(F.countDistinct("component_id")).first()[0] == 1


def test_bands_follow_the_threshold(spark):
    assert near_dup.banding(85) == (32, 6)
    for percent in (20, 50, 70, 80, 85, 95, 100):
        bands, n = near_dup.banding(percent)
        assert bands * n <= near_dup.SAMPLES and (1 - (percent / 100) ** n) ** bands <= near_dup.MISSED
    docs = corpus(2)
    for percent in (50, 80):
        assert sorted(r[:4] for r in rows(near_dup.near_duplicates(documents(spark, docs), percent=percent))) == brute(docs, percent)
