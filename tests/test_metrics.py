"""Metrics against plain-Python restatements of the published formulas."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paracorpus.operators import metrics


def _grams(units, n):
    return Counter(tuple(units[i:i + n]) for i in range(len(units) - n + 1))


def py_bleu(h, r):
    ht, rt = h.split(), r.split()
    correct, total = [], []
    for n in range(1, 5):
        hg, rg = _grams(ht, n), _grams(rt, n)
        correct.append(sum(min(c, rg[g]) for g, c in hg.items()))
        total.append(sum(hg.values()))
    if correct[0] == 0:
        return 0.0
    precisions, smooth, eff = [], 1.0, 4
    for n in range(4):
        if total[n] == 0:
            break
        eff = n + 1
        if correct[n] == 0:
            smooth *= 2
            precisions.append(100.0 / (smooth * total[n]))
        else:
            precisions.append(100.0 * correct[n] / total[n])
    hl, rl = len(ht), len(rt)
    bp = 1.0 if hl >= rl else (math.exp(1 - rl / hl) if hl > 0 else 0.0)
    return bp * math.exp(sum(math.log(p) for p in precisions) / eff)


def py_chrf(h, r, order=6, beta=2.0):
    hs, rs = "".join(h.split()), "".join(r.split())
    ps, rcs, eff = 0.0, 0.0, 0
    for n in range(1, order + 1):
        hg, rg = Counter(hs[i:i + n] for i in range(len(hs) - n + 1)), Counter(rs[i:i + n] for i in range(len(rs) - n + 1))
        m = sum(min(c, rg[g]) for g, c in hg.items())
        if hg and rg:
            ps += m / sum(hg.values())
            rcs += m / sum(rg.values())
            eff += 1
    p, rc = (ps / eff, rcs / eff) if eff else (0.0, 0.0)
    return 100 * (1 + beta**2) * p * rc / (beta**2 * p + rc) if p + rc else 0.0


def py_edit_rate(h, r):
    a, b = h.lower().split(), r.lower().split()
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    edits = prev[-1]
    return 100.0 * edits / len(b) if b else (100.0 if edits else 0.0)


def _pairs(seed, n, vocab_size, max_len):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocab_size)]
    out = []
    for i in range(n):
        ref = " ".join(rng.choice(words) for _ in range(rng.randint(0, max_len)))
        toks = ref.split()
        hyp = " ".join(t if rng.random() < 0.7 else rng.choice(words) for t in toks[: rng.randint(0, len(toks))])
        out.append((i, "m", hyp, ref))
    return out


@pytest.fixture(scope="module")
def scored(spark):
    rows = _pairs(11, 150, 12, 14) + [(900, "m", "the cat sat", "the cat sat down"), (901, "m", "a", "b"),
                                      (902, "m", "", "b"), (903, "m", "", ""), (904, "m", "x y z", "x y z")]
    df = spark.createDataFrame(rows, "row_id long, model string, hyp string, ref string")
    got = {r.row_id: r for r in metrics.score_sentences(df, ["row_id", "model"]).collect()}
    return rows, got


def test_bleu_matches_formula(scored):
    rows, got = scored
    for rid, _, h, r in rows:
        assert got[rid].bleu == pytest.approx(py_bleu(h, r), abs=1e-9), (h, r)


def test_chrf_matches_formula(scored):
    rows, got = scored
    for rid, _, h, r in rows:
        assert got[rid].chrf == pytest.approx(py_chrf(h, r), abs=1e-9), (h, r)


def test_edit_rate_matches_dp(scored):
    rows, got = scored
    for rid, _, h, r in rows:
        assert got[rid].word_edit_rate == pytest.approx(py_edit_rate(h, r), abs=1e-9), (h, r)


def test_fixture_values(scored):
    _, got = scored
    assert got[900].bleu == pytest.approx(100 * math.exp(-1 / 3), abs=1e-4)
    assert got[901].bleu == 0.0 and got[902].bleu == 0.0
    assert got[904].bleu == pytest.approx(100.0) and got[904].chrf == pytest.approx(100.0) and got[904].word_edit_rate == 0.0


def test_edit_rate_example(spark):
    df = spark.createDataFrame([(1, "the cat sat", "the dog sat down")], "row_id long, hyp string, ref string")
    assert metrics.word_edit_rate(df, ["row_id"]).first().word_edit_rate == pytest.approx(50.0)


def test_edit_rate_many_distinct_tokens(spark):
    # more distinct words than one-byte codes allow: still exact
    rng = random.Random(5)
    rows = []
    for i in range(5):
        ref = " ".join(f"t{rng.randint(0, 400)}" for _ in range(300))
        hyp = " ".join(t if rng.random() < 0.8 else f"u{rng.randint(0, 50)}" for t in ref.split())
        rows.append((i, hyp, ref))
    df = spark.createDataFrame(rows, "row_id long, hyp string, ref string")
    got = {r.row_id: r.word_edit_rate for r in metrics.word_edit_rate(df, ["row_id"]).collect()}
    for i, h, r in rows:
        assert got[i] == pytest.approx(py_edit_rate(h, r), abs=1e-9)


def test_corpus_bleu_identity(spark):
    df = spark.createDataFrame([(1, "m", "Hello, world.", "Hello, world."), (2, "m", "a b c d e", "a b c d e")],
                               "row_id long, model string, hyp string, ref string")
    assert metrics.corpus_bleu(df, ["model"]).first().bleu == pytest.approx(100.0)


def test_tokenize_13a(spark):
    df = spark.createDataFrame([("Hello, world. 3.5 a-b 1-2",)], "s string")
    assert df.select(metrics.tokenize_13a(F.col("s")).alias("t")).first().t == "Hello , world . 3.5 a-b 1 - 2"


def test_edit_rate_has_no_token_limit_and_is_fast(spark):
    import time

    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(32_200)), "w7")], "row_id long, hyp string, ref string")
    assert metrics.word_edit_rate(df, ["row_id"]).first().word_edit_rate == pytest.approx(100.0 * 32_199)
    rng = random.Random(2)
    ref = [f"w{rng.randrange(9000)}" for _ in range(20_000)]
    hyp = [w for w in ref if rng.random() < 0.9]
    t0 = time.perf_counter()
    assert metrics.word_edits(hyp, ref) == 20_000 - len(hyp)
    assert time.perf_counter() - t0 < 20


def test_chrf_of_long_texts(spark):
    text = " ".join(f"word{i}" for i in range(20_000))
    df = spark.createDataFrame([(1, text, text)], "row_id long, hyp string, ref string")
    assert metrics.sentence_chrf(df, ["row_id"]).first().chrf == pytest.approx(100.0)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def brute_shifted(hyp, ref):
    """Every move of every run, each with a plain distance."""
    shifts = 0
    while True:
        now, best = levenshtein(hyp, ref), None
        for i in range(len(hyp)):
            for j in range(len(ref)):
                for n in range(1, 11):
                    if i != j and i + n <= len(hyp) and j + n <= len(ref) and hyp[i : i + n] == ref[j : j + n]:
                        rest = hyp[:i] + hyp[i + n :]
                        moved = rest[:j] + hyp[i : i + n] + rest[j:]
                        key = (levenshtein(moved, ref), -n, i, j)
                        best = min(best, (key, moved)) if best else (key, moved)
        if best is None or best[0][0] + 1 >= now:
            return now + shifts
        hyp, shifts = best[1], shifts + 1


def test_shifted_edits_against_brute_force():
    import random

    from paracorpus.operators.metrics import shifted_edits, word_edits

    rng = random.Random(8)
    fewer = 0
    for _ in range(300):
        ref = [rng.choice("abcdefg") for _ in range(rng.randint(0, 9))]
        hyp = [rng.choice("abcdefg") for _ in range(rng.randint(0, 9))] if rng.random() < 0.3 else list(ref)
        for _ in range(rng.randint(0, 2)):
            if hyp:
                i, n, j = rng.randrange(len(hyp)), rng.randint(1, 4), rng.randint(0, len(hyp))
                run, rest = hyp[i : i + n], hyp[:i] + hyp[i + n :]
                hyp = rest[:j] + run + rest[j:]
        got = shifted_edits(hyp, ref)
        assert got == brute_shifted(hyp, ref) <= word_edits(hyp, ref), (hyp, ref)
        fewer += got < word_edits(hyp, ref)
    assert fewer > 30
    assert shifted_edits("d e f a b c".split(), "a b c d e f".split()) == 1


def test_shift_edit_rate_rows(spark):
    from paracorpus.operators import metrics

    df = spark.createDataFrame([(1, "d e f a b c", "A B C D E F"), (2, None, "a"), (3, "x", ""), (4, None, None), (5, "a b", "a b")], "row_id long, hyp string, ref string")
    got = {r["row_id"]: (r["word_edit_rate"], r["shift_edit_rate"]) for r in metrics.shift_edit_rate(df, ["row_id"]).collect()}
    assert got == {1: (100.0, 100.0 / 6), 2: (100.0, 100.0), 3: (100.0, 100.0), 4: (0.0, 0.0), 5: (0.0, 0.0)}
