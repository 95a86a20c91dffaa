"""Phrase-table translation: the longest phrase that fits, from left to right.

The phrase table becomes a trie whose nodes are word prefixes: one row for each
prefix, named by the hash of its words, with the phrase that ends there if any.
Texts walk down the trie level by level: every join keeps only the places whose words
so far are a prefix, so few rows pass the first levels.  One scan of a text's matches
then takes the longest phrase, skips its words and goes on; other words stay.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from paracorpus.fixtures import word_tokens
from paracorpus.session import written


def phrase_trie(phrases: DataFrame, phrase_col: str = "phrase", out_col: str = "out") -> DataFrame:
    """(depth, node, out) of every prefix of (phrase, out); ``out`` is null where no phrase ends.

    Phrases are split into words; blank and null ones are dropped, of equal ones
    the smallest ``out`` is taken.
    """
    words = phrases.select(word_tokens(F.col(phrase_col)).alias("w"), F.col(out_col).alias("o")).filter(F.size("w") > 0)
    prefix = F.explode(F.transform(F.sequence(F.lit(1), F.size("w")), lambda k: F.struct(k.alias("depth"), F.slice("w", F.lit(1), k).alias("p"))))
    nodes = words.select("w", "o", prefix.alias("x")).select(
        F.col("x.depth").alias("depth"), F.md5(F.array_join("x.p", " ")).alias("node"), F.when(F.size("w") == F.col("x.depth"), F.col("o")).alias("o")
    )
    return nodes.groupBy("depth", "node").agg(F.min("o").alias("out"))


def phrase_translate(df: DataFrame, key: str, text_col: str, phrases: DataFrame, out: str = "translation") -> DataFrame:
    """(key, out): each text with its phrases replaced, longest first match; unknown words stay.

    ``key`` is unique.  A null or blank text gives an empty one.
    """
    trie = written(phrase_trie(phrases), "trie")
    deepest = trie.agg(F.max("depth")).first()[0] or 0
    rows = df.select(F.col(key).alias("__key"), word_tokens(F.col(text_col)).alias("__w"))
    rows = written(rows.repartition("__key"), "phrase_rows")
    ahead = F.transform("__w", lambda w, k: F.slice("__w", k + 1, max(deepest, 1)))
    walk, matches = rows.select("__key", F.posexplode(ahead).alias("pos", "ahead")), None
    for depth in range(1, deepest + 1):
        level = trie.filter(F.col("depth") == depth).select("node", "out")
        node = F.md5(F.array_join(F.slice("ahead", 1, depth), " "))
        walk = written(walk.filter(F.size("ahead") >= depth).withColumn("node", node).join(level, "node").drop("node"), "trie_walk")
        here = walk.filter("out IS NOT NULL").select("__key", "pos", F.lit(depth).alias("n"), "out")
        matches = here if matches is None else matches.unionByName(here)
        walk = walk.drop("out")
    if matches is None:
        return rows.select(F.col("__key").alias(key), F.coalesce(F.array_join("__w", " "), F.lit("")).alias(out))
    longest = matches.groupBy("__key", "pos").agg(F.max(F.struct("n", "out")).alias("m"))
    found = longest.groupBy("__key").agg(F.sort_array(F.collect_list(F.struct("pos", "m.n", "m.out"))).alias("f"))
    joined = rows.join(found, "__key", "left")
    return joined.select(F.col("__key").alias(key), _said("__w", "f.pos", "f.n", "f.out").alias(out))


@F.pandas_udf(StringType())
def _said(words: pd.Series, places: pd.Series, lengths: pd.Series, outs: pd.Series) -> pd.Series:
    """The words with their phrases said: from left to right, a phrase begins after the last one's words only."""
    texts = []
    for w, at, n, out in zip(words, places, lengths, outs):
        w, said, done = [] if w is None else w, [], 0
        for k, size, phrase in () if at is None else zip(at.tolist(), n.tolist(), out.tolist()):
            if k >= done:
                said.extend(w[done:k])
                said.append(phrase)
                done = k + size
        said.extend(w[done:])
        texts.append(" ".join(said))
    return pd.Series(texts, dtype=object)
