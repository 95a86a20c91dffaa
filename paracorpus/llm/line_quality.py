"""Quality rules: per-document counts and the frequency of lines across documents.

One pass over the texts gives each document its counts and the hashes of its
normalised lines.  Lines are then counted per host over distinct documents, lines
above the host's limit are removed, and a document that keeps too few of its words
is rejected.

Copies are for deduplication to judge: documents with equal text count once, and
near copies do not count.  Two pages that share so many of their words in common
lines that they are alike to ``NEAR_PERCENT`` are near copies; a page with less in
common is its own, with boilerplate around it, however much that is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paracorpus.llm.common import fresh_worker, spill

#: Fixed values of the rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"

#: A line is frequent in a host if it occurs in more distinct documents than this,
#: whatever the host's size.
MIN_DOCUMENTS = 6
#: Similarity of near copies.  Two texts of n words that share s of them are alike
#: to s / (2 n - s), so near copies share this percentage of their words.
NEAR_PERCENT = 80
NEAR_SHARED_PERCENT = 200 * NEAR_PERCENT / (100 + NEAR_PERCENT)
#: A document is depleted if frequent lines hold more than this percentage of its words.
MAX_REMOVED_PERCENT = 70

#: Texts of an Arrow batch that are measured at a time.
SLICE_ROWS = 512
_SCHEMA = (
    "doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<bigint>, line_words array<bigint>, line_places array<array<int>>"
)


def line_hash(line: str) -> int:
    """Signed 64-bit hash of a line without case and runs of blanks."""
    h = xxhash.xxh3_64_intdigest(" ".join(line.casefold().split()))
    return h - (1 << 64) if h >> 63 else h


def repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more, the first included."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, len(words))
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(number) + ids[2:]
    order = np.argsort(window, kind="stable")
    same = np.diff(window[order]) == 0
    if not same.any():
        return 0
    covered = np.zeros(len(words), bool)
    twice = order[np.append(same, False) | np.append(False, same)]
    for k in range(3):
        covered[twice + k] = True
    return int(covered.sum())


def measure(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; distinct line hashes, their words and their places."""
    if not text:
        return 0, 0, 0, 0, 0, [], [], []
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: at the six ASCII blanks
    word_chars = len(text) - (len(raw) - len(raw.translate(None, BLANKS)))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[str] = set()
    duplicates, held, places = 0, {}, {}
    for k, line in enumerate(text.split("\n")):
        n = len(line.encode("utf-8", "surrogatepass").split())
        if n:
            duplicates += line in seen
            seen.add(line)
            h = line_hash(line)
            held[h] = held.get(h, 0) + n
            places.setdefault(h, []).append(k)
    return len(words), word_chars, n_symbols, duplicates, repeat_words(words), list(held), list(held.values()), list(places.values())


def measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker()
        for whole in batches:
            for begin in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(begin, SLICE_ROWS)
                columns = zip(*[measure(t.as_py()) for t in batch.column(3)], strict=True)
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.list_(pa.int32()))]
                values = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *values], names=names)

    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), host_key(F.col(host_col)).alias("host"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    ).mapInArrow(run, _SCHEMA)


def host_key(host: Column) -> Column:
    """A never-null key: null is a host of its own."""
    return F.when(host.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), host.cast("string")))


def _removed(entries: DataFrame, frequent: DataFrame) -> DataFrame:
    """(host, text_hash, removed_words, removed_lines, removed_places) of the texts that hold frequent lines."""
    held = entries.join(frequent.select("host", "line"), ["host", "line"])
    return held.groupBy("host", "text_hash").agg(
        F.sum("words").alias("removed_words"), F.collect_list("line").alias("removed_lines"), F.flatten(F.collect_list("places")).alias("removed_places")
    )


def frequent_lines(entries: DataFrame, texts: DataFrame, min_documents: int) -> DataFrame:
    """(host, line) in more than ``min_documents`` distinct documents of a host that are not near copies."""
    common = entries.groupBy("host", "line").agg(F.count(F.lit(1)).alias("documents")).filter(F.col("documents") > min_documents)
    common = spill(common, "line_common")
    shared = _removed(entries, common).join(texts.select("host", "text_hash", "n_words"), ["host", "text_hash"])
    copies = shared.filter(F.col("removed_words") * 100 > F.col("n_words") * NEAR_SHARED_PERCENT).select("host", F.explode("removed_lines").alias("line"))
    among = copies.groupBy("host", "line").agg(F.count(F.lit(1)).alias("among"))
    return common.join(among, ["host", "line"], "left").filter(F.col("documents") - F.coalesce("among", F.lit(0)) > min_documents).select("host", "line")


def line_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    max_removed_percent: int = MAX_REMOVED_PERCENT,
) -> DataFrame:
    """One row per input row: counts, ``base_failed``, ``removed_words``, ``removed_lines``
    (hashes), ``removed_places`` (numbers of ``\\n``-split lines), ``kept``, and the keys
    host and text_hash.

    Null and empty texts have no words and fail the base rules.  Repeated rows
    get equal verdicts and count as one document, as do all equal texts of a
    host.  A null host is a host of its own.  An empty table gives an empty
    result; other columns are ignored.
    """
    base = spill(measured(docs, id_col, text_col, host_col), "line_base")
    held = F.first(F.struct(F.col("lines").alias("line"), F.col("line_words").alias("words"), F.col("line_places").alias("places"), "n_words"))
    texts = base.groupBy("host", "text_hash").agg(held.alias("t"))
    texts = spill(texts.select("host", "text_hash", "t.n_words", F.arrays_zip("t.line", "t.words", "t.places").alias("entries")), "line_texts")
    entries = texts.select("host", "text_hash", F.inline("entries"))
    frequent = spill(frequent_lines(entries, texts, min_documents), "line_frequent")
    out = base.drop("lines", "line_words", "line_places").join(_removed(entries, frequent), ["host", "text_hash"], "left")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    lost = F.coalesce("removed_words", F.lit(0))
    return out.withColumns(
        {
            "base_failed": failed,
            "removed_words": lost,
            "kept": ~failed & (lost * 100 <= F.col("n_words") * max_removed_percent),
        }
    )


def without_frequent_lines(docs: DataFrame, rules: DataFrame, text_col: str = "text", host_col: str = "source", length_col: str = "n_chars") -> DataFrame:
    """The kept rows of ``docs`` with their frequent lines removed, columns unchanged.

    ``rules`` is the result of :func:`line_rules` on ``docs``.  Verdicts belong to
    (host, text), so a row finds its own by those keys.
    """
    verdicts = rules.filter("kept").groupBy("host", "text_hash").agg(F.first("removed_places").alias("__removed"))
    verdicts = spill(verdicts.select(F.col("host").alias("__host"), F.col("text_hash").alias("__hash"), "__removed"), "line_verdicts")
    joined = docs.join(verdicts, (host_key(F.col(host_col)) == F.col("__host")) & (F.xxhash64(F.col(text_col)) == F.col("__hash")))
    left = F.filter(F.split(F.col(text_col), "\n", -1), lambda x, k: ~F.array_contains(F.col("__removed"), k))
    text = F.when(F.col("__removed").isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    changed = {text_col: text}
    if length_col in docs.columns:
        changed[length_col] = F.char_length(text).cast(docs.schema[length_col].dataType)
    return joined.select(*[changed[c].alias(c) if c in changed else docs[c] for c in docs.columns])


def op4_query(docs: DataFrame) -> DataFrame:
    return line_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"
    )
