"""Translation metrics as Spark aggregations.

Published definitions (Papineni et al. 2002; Popovic 2015; sacreBLEU, Post
2018), re-expressed relationally:

* n-gram statistics: the input is hash-partitioned once by the row key; each
  row explodes the n-grams of both sides; clipped matches come from one
  aggregate over (key, n, gram) and fold to (key, n) and (key) without a
  further exchange, because every later grouping starts with the key.
* sentence BLEU (exp smoothing, effective order), chrF (char 1..6, beta 2,
  whitespace removed), corpus BLEU (13a tokenizer, 4 orders) are closed-form
  column expressions on those statistics.
* word edit rate: word-level Levenshtein / reference words x 100
  (case-insensitive, no block shifts).  Spark's ``levenshtein`` compares
  characters, so the word distance is a bit-parallel scan over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from paracorpus.functions.text import WS_CLASS, split_ws

BLEU_ORDER = 4
CHRF_ORDER = 6
CHRF_BETA = 2.0


def _units(c: Column, kind: str) -> Column:
    """What n-grams are cut from: the array of words, or of the non-blank characters."""
    return split_ws(c) if kind == "word" else F.filter(F.split(F.regexp_replace(c, WS_CLASS, ""), ""), lambda x: x != "")


def _ngrams(u: Column, n: int, kind: str) -> Column:
    """n-grams of an already materialised array ``u`` (an attribute, so the
    lambda below never re-evaluates the tokenizer, and a slice costs n)."""
    glue = " " if kind == "word" else ""
    grams = F.transform(F.sequence(F.lit(1), F.size(u) - n + 1), lambda i: F.array_join(F.slice(u, i, n), glue))
    return F.when(F.size(u) >= n, grams).otherwise(F.array().cast("array<string>"))


def _side_grams(u: Column, side: str, n_max: int, kind: str) -> Column:
    def tag(n: int):
        return lambda g: F.struct(F.lit(n).alias("n"), F.lit(side).alias("side"), g.alias("g"))

    parts = [F.transform(_ngrams(u, n, kind), tag(n)) for n in range(1, n_max + 1)]
    return F.concat(*parts)


def ngram_stats(
    df: DataFrame, keys: Sequence[str], hyp: str, ref: str, n_max: int, kind: str = "word", prepartition: bool = True
) -> DataFrame:
    """Per key: ``m{n}`` clipped matches, ``h{n}`` hyp n-grams, ``r{n}`` ref n-grams."""
    keys = list(keys)
    base = df.select(*keys, F.col(hyp).alias("__h"), F.col(ref).alias("__r"))
    if prepartition:
        base = base.repartition(*keys)
    units = base.select(*keys, _units(F.col("__h"), kind).alias("__hu"), _units(F.col("__r"), kind).alias("__ru"))
    grams = units.select(
        *keys,
        F.explode_outer(F.concat(_side_grams(F.col("__hu"), "h", n_max, kind), _side_grams(F.col("__ru"), "r", n_max, kind))).alias("x"),
    ).select(*keys, F.col("x.n").alias("n"), F.col("x.side").alias("side"), F.col("x.g").alias("g"))
    per_gram = grams.groupBy(*keys, "n", "g").agg(
        F.count_if(F.col("side") == "h").alias("hc"), F.count_if(F.col("side") == "r").alias("rc")
    )
    per_n = per_gram.groupBy(*keys, "n").agg(
        F.sum(F.least("hc", "rc")).alias("m"), F.sum("hc").alias("h"), F.sum("rc").alias("r")
    )
    aggs = []
    for k in range(1, n_max + 1):
        for s in ("m", "h", "r"):
            aggs.append(F.coalesce(F.sum(F.when(F.col("n") == k, F.col(s))), F.lit(0)).alias(f"{s}{k}"))
    return per_n.groupBy(*keys).agg(*aggs)


def bleu_from_stats(effective_order: bool = True, order: int = BLEU_ORDER) -> Column:
    """sacreBLEU's BLEU with 'exp' smoothing on m1..m4 / h1..h4, hyp length h1, ref length r1."""
    m = [F.col(f"m{k}") for k in range(1, order + 1)]
    h = [F.col(f"h{k}") for k in range(1, order + 1)]
    hyp_len, ref_len = F.col("h1").cast("double"), F.col("r1").cast("double")
    zeros = [F.when(x == 0, 1).otherwise(0) for x in m]
    logs = []
    for k in range(order):
        z = zeros[0]
        for j in range(1, k + 1):
            z = z + zeros[j]
        p = F.when(m[k] == 0, F.lit(100.0) / (F.pow(F.lit(2.0), z) * h[k])).otherwise(F.lit(100.0) * m[k] / h[k])
        logs.append(F.when(h[k] > 0, F.ln(p)).otherwise(F.lit(0.0 if effective_order else -9999999999.0)))
    total = logs[0]
    for x in logs[1:]:
        total = total + x
    eff = F.least(F.lit(order), F.col("h1")).cast("double") if effective_order else F.lit(float(order))
    bp = F.when(hyp_len < ref_len, F.when(hyp_len > 0, F.exp(F.lit(1.0) - ref_len / hyp_len)).otherwise(0.0)).otherwise(1.0)
    return F.when(m[0] == 0, F.lit(0.0)).otherwise(bp * F.exp(total / eff))


def chrf_from_stats(order: int = CHRF_ORDER, beta: float = CHRF_BETA) -> Column:
    """chrF from m/h/r per order: mean precision and recall over orders where
    both sides have n-grams, then the F-beta score x 100."""
    prec_sum, rec_sum, eff = F.lit(0.0), F.lit(0.0), F.lit(0)
    for k in range(1, order + 1):
        m, h, r = F.col(f"m{k}"), F.col(f"h{k}"), F.col(f"r{k}")
        both = (h > 0) & (r > 0)
        prec_sum = prec_sum + F.when(both, m / h).otherwise(0.0)
        rec_sum = rec_sum + F.when(both, m / r).otherwise(0.0)
        eff = eff + F.when(both, 1).otherwise(0)
    p = F.when(eff > 0, prec_sum / eff).otherwise(0.0)
    r = F.when(eff > 0, rec_sum / eff).otherwise(0.0)
    f2 = beta * beta
    return F.when(p + r > 0, F.lit(100.0) * (1 + f2) * p * r / (F.lit(f2) * p + r)).otherwise(0.0)


def sentence_bleu(df: DataFrame, keys: Sequence[str], hyp: str = "hyp", ref: str = "ref") -> DataFrame:
    """M1: keys + ``bleu`` (inputs already punctuation-free: 13a = whitespace split)."""
    st = ngram_stats(df, keys, hyp, ref, BLEU_ORDER, "word")
    return st.select(*keys, bleu_from_stats().alias("bleu"))


def sentence_chrf(df: DataFrame, keys: Sequence[str], hyp: str = "hyp", ref: str = "ref") -> DataFrame:
    """M2: keys + ``chrf``."""
    st = ngram_stats(df, keys, hyp, ref, CHRF_ORDER, "char")
    return st.select(*keys, chrf_from_stats().alias("chrf"))


def word_edits(hyp: Sequence[str], ref: Sequence[str]) -> int:
    """Levenshtein distance of two word lists (bit-parallel: one row of the
    distance matrix is two integers with a bit per reference word)."""
    m = len(ref)
    if not m or not len(hyp):
        return max(m, len(hyp))
    places: dict[str, int] = {}
    for j, w in enumerate(ref):
        places[w] = places.get(w, 0) | 1 << j
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m  # vertical steps of +1 and of -1
    for w in hyp:
        same = places.get(w, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right_up, right_down = down | ~(diagonal | up) & full, up & diagonal
        score += bool(right_up & last) - bool(right_down & last)
        right_up, right_down = (right_up << 1 | 1) & full, (right_down << 1) & full
        up, down = right_down | ~(diagonal | right_up) & full, right_up & diagonal
    return score


@F.pandas_udf(IntegerType())
def _word_edits(hyp: pd.Series, ref: pd.Series) -> pd.Series:
    return pd.Series([word_edits(h, r) for h, r in zip(hyp, ref)], dtype="int32")


def word_edit_rate(df: DataFrame, keys: Sequence[str], hyp: str = "hyp", ref: str = "ref") -> DataFrame:
    """M3: ``word_edit_rate`` = 100 x word Levenshtein / ref words, per row; a null text is empty."""
    keys = list(keys)
    words = lambda c: split_ws(F.lower(F.coalesce(F.col(c), F.lit(""))))
    x = df.select(*keys, words(hyp).alias("__h"), words(ref).alias("__r"))
    x = x.select(*keys, F.size("__r").cast("double").alias("__n"), _word_edits("__h", "__r").cast("double").alias("__e"))
    rate = F.when(F.col("__n") > 0, F.lit(100.0) * F.col("__e") / F.col("__n")).when(F.col("__e") > 0, F.lit(100.0)).otherwise(F.lit(0.0))
    return x.select(*keys, rate.alias("word_edit_rate"))


# Fixed values of the published metric: most words of a shift, and how far it goes.
SHIFT_WORDS, SHIFT_DISTANCE = 10, 50


def shifted_edits(hyp: Sequence[str], ref: Sequence[str]) -> int:
    """Edits to ``ref`` where moving a run of words counts as one.

    Greedy: of all runs of ``hyp`` that the reference has at another place, the move
    to that place that leaves the fewest edits is made (ties: the longest run, then
    the first one, then the first place), as long as it saves more than it costs.
    Meant for sentences: a step compares every candidate with the reference.
    """
    words, places = list(hyp), {}
    for j, w in enumerate(ref):
        places.setdefault(w, []).append(j)
    edits, shifts = word_edits(words, ref), 0
    while edits > 1:
        runs = []
        for i, w in enumerate(words):
            for j in places.get(w, ()):
                if i == j or abs(i - j) > SHIFT_DISTANCE:
                    continue
                for n in range(1, min(SHIFT_WORDS, len(words) - i, len(ref) - j) + 1):
                    if words[i + n - 1] != ref[j + n - 1]:
                        break
                    runs.append((-n, i, j))
        best = None
        for size, i, j in sorted(runs):
            n = -size
            if edits - 2 * n > (best[0] if best else edits - 2):
                continue  # n words moved save 2 n edits at most
            rest = words[:i] + words[i + n :]
            at = min(j, len(rest))
            moved = rest[:at] + words[i : i + n] + rest[at:]
            left = word_edits(moved, ref)
            if left + 1 < edits and (best is None or left < best[0]):
                best = left, moved
        if best is None:
            break
        edits, words, shifts = best[0], best[1], shifts + 1
    return edits + shifts


@F.pandas_udf(IntegerType())
def _shifted_edits(hyp: pd.Series, ref: pd.Series) -> pd.Series:
    return pd.Series([shifted_edits(h, r) for h, r in zip(hyp, ref)], dtype="int32")


def shift_edit_rate(df: DataFrame, keys: Sequence[str], hyp: str = "hyp", ref: str = "ref") -> DataFrame:
    """M3 with block shifts: ``shift_edit_rate`` = 100 x edits and shifts / ref words, beside ``word_edit_rate``."""
    keys = list(keys)
    words = lambda c: split_ws(F.lower(F.coalesce(F.col(c), F.lit(""))))
    x = df.select(*keys, words(hyp).alias("__h"), words(ref).alias("__r"))
    x = x.select(*keys, F.size("__r").cast("double").alias("__n"), _word_edits("__h", "__r").cast("double").alias("__e"), _shifted_edits("__h", "__r").cast("double").alias("__s"))
    rate = lambda e: F.when(F.col("__n") > 0, F.lit(100.0) * F.col(e) / F.col("__n")).when(F.col(e) > 0, F.lit(100.0)).otherwise(F.lit(0.0))
    return x.select(*keys, rate("__e").alias("word_edit_rate"), rate("__s").alias("shift_edit_rate"))


def tokenize_13a(c: Column) -> Column:
    """sacreBLEU's default '13a' tokenizer as regex replacements (output: tokens joined by ' ')."""
    s = F.replace(F.replace(F.replace(c, F.lit("<skipped>"), F.lit("")), F.lit("-\n"), F.lit("")), F.lit("\n"), F.lit(" "))
    for a, b in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.concat(F.lit(" "), s, F.lit(" "))
    s = F.regexp_replace(s, r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 ")
    s = F.regexp_replace(s, r"([^0-9])([\.,])", "$1 $2 ")
    s = F.regexp_replace(s, r"([\.,])([^0-9])", " $1 $2")
    s = F.regexp_replace(s, r"([0-9])(-)", "$1 $2 ")
    return F.array_join(split_ws(s), " ")


def corpus_bleu(df: DataFrame, group: Sequence[str], hyp: str = "hyp", ref: str = "ref", key: str = "row_id") -> DataFrame:
    """M4: corpus BLEU per group: statistics summed over sentences, 4 orders."""
    group = list(group)
    tok = df.select(*group, key, tokenize_13a(F.col(hyp)).alias("__h"), tokenize_13a(F.col(ref)).alias("__r"))
    st = ngram_stats(tok, group + [key], "__h", "__r", BLEU_ORDER, "word")
    sums = [F.sum(f"{s}{k}").alias(f"{s}{k}") for k in range(1, BLEU_ORDER + 1) for s in ("m", "h", "r")]
    tot = st.groupBy(*group).agg(*sums)
    return tot.select(*group, bleu_from_stats(effective_order=False).alias("bleu"))


def score_sentences(df: DataFrame, keys: Sequence[str], hyp: str = "hyp", ref: str = "ref") -> DataFrame:
    """BLEU, chrF and word edit rate per sentence, sharing one partitioning."""
    keys = list(keys)
    base = df.select(*keys, F.col(hyp).alias("hyp"), F.col(ref).alias("ref")).repartition(*keys)
    b = ngram_stats(base, keys, "hyp", "ref", BLEU_ORDER, "word", prepartition=False).select(*keys, bleu_from_stats().alias("bleu"))
    c = ngram_stats(base, keys, "hyp", "ref", CHRF_ORDER, "char", prepartition=False).select(*keys, chrf_from_stats().alias("chrf"))
    t = word_edit_rate(base, keys)
    return b.join(c, keys).join(t, keys)


def macro_scores(scores: DataFrame, group: Sequence[str], digits: int = 4, extra: dict[str, Column] | None = None) -> DataFrame:
    """Mean of sentence scores per group, rounded half-even."""
    aggs = [F.bround(F.avg(m), digits).alias(m) for m in ("bleu", "chrf", "word_edit_rate")]
    for name, c in (extra or {}).items():
        aggs.append(F.bround(F.avg(c), digits).alias(name))
    return scores.groupBy(*group).agg(*aggs)
