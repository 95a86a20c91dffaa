"""Token ids in Simple-8b segments.

A 64-bit word holds a 4-bit selector (top bits) and 60 bits of payload: as many
ids as fit in equal fields.  An id that needs more than 60 bits is escaped: the
word holds its index in a list of exceptions at the end of the segment, so
decoding never depends on the word before.  Ids are packed in blocks of
``BLOCK`` that start at fresh words; block offsets let all blocks be decoded at
once, or one alone.

A segment is self-contained (all numbers little-endian)::

    "S8B1" | n_docs u4 | n_ids u4 | n_blocks u4 | n_words u4 | n_exceptions u4
    ids per document u4[n_docs] | first word of each block u4[n_blocks]
    words u8[n_words] | exceptions u8[n_exceptions]

Segments are rows of a Parquet table, written by Spark's committer in ascending
document order, so a retried task leaves no partial file and any store that
Spark writes to will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paracorpus.llm import tokens
from paracorpus.llm.common import shuffle_partitions
from paracorpus.session import scratch_path

BLOCK = 1024
#: A segment is closed once it holds this many ids; a document stays in one segment.
SEGMENT_IDS = 1 << 20
MAGIC = b"S8B1"
#: Fixed values of the coding: ids per word and bits per id, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
_LIMITS = np.left_shift(np.uint64(1), WIDTHS.astype(np.uint64))
_STEP = np.array([*COUNTS, 1, 1])
#: Width class (smallest selector that holds the id) of ids up to 65,535.
_WIDTH_CLASS = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)


def _selectors(classes: np.ndarray) -> np.ndarray:
    """For every place of flat width classes (``COUNTS[0]`` free places follow) the
    selector of a word that begins there: the most ids that all fit."""
    n = len(classes) - int(COUNTS[0])
    maxima = {1: classes}  # by power of two, the widest class of so many places
    for k in (1, 2, 4, 8, 16):
        maxima[2 * k] = np.maximum(maxima[k][:-k], maxima[k][k:])
    sel = np.where(classes[:n] == len(WIDTHS), ESCAPE, len(WIDTHS) - 1).astype(np.uint8)
    for s in range(len(WIDTHS) - 2, -1, -1):
        count = int(COUNTS[s])
        k = 1 << (count.bit_length() - 1)
        widest = np.maximum(maxima[k][:n], maxima[k][count - k : count - k + n])
        sel[widest <= s] = s
    return sel


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word of each block, words, exceptions) of unsigned ids."""
    ids = np.asarray(ids, np.uint64)
    n_blocks, width = -(-len(ids) // BLOCK), BLOCK + int(COUNTS[0])
    if not n_blocks:
        return np.zeros(0, "<u4"), np.zeros(0, "<u8"), np.zeros(0, "<u8")
    grid = np.zeros((n_blocks, width), np.uint64)  # zeros after a block fit any word
    padded = np.zeros(n_blocks * BLOCK, np.uint64)
    padded[: len(ids)] = ids
    grid[:, :BLOCK] = padded.reshape(n_blocks, BLOCK)
    flat = grid.reshape(-1)
    classes = _WIDTH_CLASS[np.minimum(flat, len(_WIDTH_CLASS) - 1).astype(np.int64)]
    large = np.flatnonzero(flat >= len(_WIDTH_CLASS))
    classes[large] = np.searchsorted(_LIMITS, flat[large], side="right")
    sel = _selectors(np.concatenate([classes, np.zeros(int(COUNTS[0]), np.uint8)]))
    first = np.arange(n_blocks) * width
    ends = first + BLOCK
    ends[-1] = first[-1] + len(ids) - (n_blocks - 1) * BLOCK
    at, block, sizes, found = first.copy(), np.arange(n_blocks), np.zeros(n_blocks, np.int64), []
    while len(block):  # the next word of every block at a time
        s = sel[at]
        found.append((block, at, s))
        sizes[block] += 1
        at = at + _STEP[s]
        more = at < ends[block]
        block, at = block[more], at[more]
    firsts = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    place, chosen = np.zeros(total, np.int64), np.zeros(total, np.uint8)
    for k, (b, p, s) in enumerate(found):
        place[firsts[b] + k], chosen[firsts[b] + k] = p, s
    words = chosen.astype(np.uint64) << np.uint64(60)
    for k, (count, bits) in enumerate(zip(COUNTS, WIDTHS, strict=True)):
        rows = np.flatnonzero(chosen == k)
        if len(rows):
            p, w = place[rows], words[rows]
            for j in range(count):
                w |= flat[p + j] << np.uint64(bits * j)
            words[rows] = w
    escaped = np.flatnonzero(chosen == ESCAPE)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    return firsts.astype("<u4"), words.astype("<u8"), flat[place[escaped]].astype("<u8")


def decode_ids(firsts: np.ndarray, words: np.ndarray, exceptions: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of whole blocks, all words of a selector at a time."""
    n_blocks = len(firsts)
    if not n_blocks:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(_STEP[sel])
    starts = ends - _STEP[sel]
    width = BLOCK + int(COUNTS[0])
    sizes = np.diff(np.append(firsts.astype(np.int64), len(words)))
    block = np.repeat(np.arange(n_blocks), sizes)
    place = starts - starts[firsts.astype(np.int64)][block] + block * width
    out = np.zeros(n_blocks * width, np.uint64)
    for k, (count, bits) in enumerate(zip(COUNTS, WIDTHS, strict=True)):
        rows = np.flatnonzero(sel == k)
        w, at, mask = words[rows], place[rows], np.uint64((1 << int(bits)) - 1)
        for j in range(count if len(rows) else 0):
            out[at + j] = (w >> np.uint64(bits * j)) & mask
    escaped = np.flatnonzero(sel == ESCAPE)
    out[place[escaped]] = exceptions[(words[escaped] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out.reshape(n_blocks, width)[:, :BLOCK].reshape(-1)[:n_ids]


def pack_segment(documents: list[np.ndarray]) -> bytes:
    counts = np.array([len(d) for d in documents], "<u4")
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint64)
    firsts, words, exceptions = encode_ids(ids)
    head = struct.pack("<4s5I", MAGIC, len(counts), len(ids), len(firsts), len(words), len(exceptions))
    return b"".join([head, counts.tobytes(), firsts.tobytes(), words.tobytes(), exceptions.tobytes()])


def unpack_segment(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids per document, all ids) of a segment."""
    magic, n_docs, n_ids, n_blocks, n_words, n_exceptions = struct.unpack_from("<4s5I", payload)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at, parts = struct.calcsize("<4s5I"), []
    for kind, n in (("<u4", n_docs), ("<u4", n_blocks), ("<u8", n_words), ("<u8", n_exceptions)):
        parts.append(np.frombuffer(payload, kind, n, at))
        at += parts[-1].nbytes
    counts, firsts, words, exceptions = parts
    return counts, decode_ids(firsts, words, exceptions, n_ids)


def write_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 0,
) -> None:
    """Write the token ids of whole texts to ``path`` in ascending ``id_col`` order.

    Every document gets ``end_id`` appended; a null or empty text is that id
    alone.  Null ids come first; rows that repeat an id are written each, ordered
    by text.  An empty table gives an empty dataset.  Other columns are ignored.
    The range shuffle moves ids and texts once; a task holds one segment and the
    batch that it reads.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = tokens.encoder(tokens.tokenizer_path(tokenizer)).encode_all
        end = np.array([end_id], "<u4")
        part, start, held, keys, size = TaskContext.get().partitionId(), 0, [], [], 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"part": [part], "start": [start], "n_ids": [size], "ids": [keys], "payload": [pack_segment(held)]},
                schema=schema,
            )

        for batch in batches:
            for key, found in zip(batch.column(0).to_pylist(), encode_all(batch.column(1)), strict=True):
                ids = np.concatenate([found, end])
                held.append(ids)
                keys.append(key)
                size += len(ids)
                if size >= SEGMENT_IDS:
                    yield segment()
                    start, held, keys, size = start + size, [], [], 0
        if keys:
            yield segment()

    schema = pa.schema(
        [("part", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.list_(pa.int64())), ("payload", pa.binary())]
    )
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "id").sortWithinPartitions("id", "text")
    out = ordered.mapInArrow(pack, "part int, start long, n_ids long, ids array<bigint>, payload binary")
    out.write.option("compression", "zstd").parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document of a token dataset, decoded from its segments.

    ``start`` counts the ids of all documents before it.  The driver reads one
    id total per written partition.
    """
    segments = spark.read.schema("part int, start long, n_ids long, ids array<bigint>, payload binary").parquet(path)
    totals = {r["part"]: r["n"] for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    base, seen = {}, 0
    for part in sorted(totals):
        base[part] = seen
        seen += totals[part]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part, start, keys, payload = (batch.column(c)[k].as_py() for c in range(4))
                counts, ids = unpack_segment(payload)
                raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(counts, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(ends - counts + start + base[part], pa.int64()),
                        pa.array(counts.astype(np.int64), pa.int64()),
                        pa.array([zlib.crc32(raw[4 * (e - c) : 4 * e]) for c, e in zip(counts.tolist(), ends.tolist(), strict=True)], pa.int64()),
                    ],
                    names=["id", "start", "n_tokens", "ids_crc32"],
                )

    return segments.select("part", "start", "ids", "payload").mapInArrow(
        unpack, "id long, start long, n_tokens long, ids_crc32 long"
    )


def op2_query(docs: DataFrame) -> DataFrame:
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path)
    out = read_tokens(docs.sparkSession, path)
    return out.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")
