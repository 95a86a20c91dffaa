import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from paracorpus.llm import periodic

from .helpers import awkward, documents, empty, rows


def brute(w):
    """(start, end, period) of every run, from all periods and all stretches."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)  # the smallest period comes first
            i = j + 1
    return sorted(((a, b, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def text_of(rng, kind, n):
    if kind == "two":
        return [rng.randint(0, 1) for _ in range(n)]
    if kind == "words":
        return [rng.randint(0, 30) for _ in range(n)]
    w = []
    while len(w) < n:
        u = [rng.randint(0, 3) for _ in range(rng.randint(1, 25))]
        w += (u * rng.randint(1, 8))[: rng.randint(1, 200)]
    return w


@pytest.mark.parametrize("kind", ["two", "words", "periods"])
def test_runs_against_brute_force(kind):
    rng = random.Random(kind)
    for _ in range(200):
        texts = [text_of(rng, kind, rng.randint(0, 150)) for _ in range(rng.randint(1, 4))]
        words = np.array([x for w in texts for x in w], np.int64)
        want, start = [], 0
        for w in texts:
            want += [(a + start, b + start, q) for a, b, q in brute(w)]
            start += len(w)
        got = periodic.runs(words, np.repeat(np.arange(len(texts)), [len(w) for w in texts]))
        assert [tuple(r) for r in got.tolist()] == want, texts


def test_grammar_derives_the_sequence():
    rng = random.Random(5)
    words = np.array(text_of(rng, "periods", 400) + text_of(rng, "words", 300), np.int64)
    text = np.repeat([0, 1], [400 if len(words) > 700 else len(words) - 300, len(words) - (400 if len(words) > 700 else len(words) - 300)])
    g = periodic.Grammar(words, text)
    for rule, place in zip(g.rules.tolist(), g.places.tolist(), strict=True):
        n = g.end[rule] - g.first[rule]
        assert (words[place : place + n] == words[g.first[rule] : g.end[rule]]).all()
    assert sorted((g.cut[g.rules] - g.first[g.rules] + g.places).tolist()) == [k for k in range(1, len(words)) if text[k] == text[k - 1]]
    assert len(g.first) < len(g.rules)  # rules are used again


def test_long_repetitive_texts_stay_fast():
    rng = np.random.default_rng(1)
    fibonacci, b = [0], [0, 1]
    while len(b) < 100_000:
        fibonacci, b = b, b + fibonacci
    cases = [
        (np.zeros(100_000, np.int64), [(0, 100_000, 1)]),
        (np.tile(rng.permutation(20_000), 10), [(0, 200_000, 20_000)]),
        (np.tile([0] * 50 + [1], 2000), None),
        (np.array(b), []),
        (rng.integers(0, 2, 100_000), None),
    ]
    began = time.time()
    for words, want in cases:
        got = [tuple(r) for r in periodic.runs(words, words * 0).tolist()]
        assert want is None or got == want
    assert time.time() - began < 60


def expected(key, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(key).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n and key is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    gone = {i for a, b, q in found for i in range(a + q, b)}
    best = min(found, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    four = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return key, len(found), *four, sha("".join(f"{a},{b - a},{q}\n" for a, b, q in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))


def test_query_on_the_tables(spark, sf001, monkeypatch):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 8000]
    small = documents(spark, texts)
    want = sorted(expected(*x) for x in texts)
    assert sorted(rows(periodic.op12_query(small))) == want and any(r[1] for r in want)
    monkeypatch.setattr(periodic, "BATCH_WORDS", 500)
    assert sorted(rows(periodic.op12_query(small))) == want


def test_awkward_rows(spark):
    docs = [(1, "a b " * 20), (1, "a b " * 20), (None, "x " * 9), (2, None), (3, ""), (4, " \n\t"), (5, "one"), (20, "k l m n o p q r s t u v w x y z " * 3)]
    key = lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:]))
    assert sorted(rows(periodic.op12_query(documents(spark, docs))), key=key) == sorted((expected(*x) for x in docs), key=key)
    assert rows(periodic.op12_query(empty(spark))) == []
    got = {r["doc_id"]: r for r in periodic.op12_query(awkward(spark)).collect()}
    assert got[2]["n_runs"] == 0 and got[2]["start"] is None and got[2]["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
    assert len(got) == 8
