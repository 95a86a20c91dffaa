"""Near-duplicate documents by MinHash bands and odd sketches.

1. Every text becomes its set of distinct five-word shingles (64-bit hashes), a
   MinHash signature, one key per band of the signature, and an odd sketch: the
   parity bitmap of the signature's samples, whose XOR with another one has as
   many ones as the samples differ, folded.
2. Documents with equal sets are one node; the rest works on nodes.
3. In each band bucket all nodes are paired with the bucket's smallest node.
   The XOR population count of the two sketches estimates the similarity; pairs
   well below the threshold are dropped, the others are confirmed on full sets.
4. Links are closed to components.  Buckets that still hold nodes of several
   components are searched in blocks, where sketches of nodes in different
   components are compared.  One round confirms each node's nearest one only,
   which joins most of what belongs together; the last round confirms every pair
   left that may be similar.

So each pair of a bucket is either known to be connected, compared by sketch, or
confirmed on full sets; no pairs are listed inside a component, however large.
The bands follow from the threshold: a link is missed only if no band of the
signature agrees (probability below ``MISSED`` at the threshold) or the sketch
is off by more than :func:`margin`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paracorpus.llm.common import drop_spill, fresh_worker, shuffle_partitions, spill

#: Probability that no band of a pair at the threshold agrees.
MISSED = 3e-7
#: Samples of a band and bands of a signature at most, while fewer samples a band can do.
MOST_ROWS, MOST_BANDS = 6, 64
#: MinHash samples of a signature; the first ones make the bands, all the sketch.
SAMPLES = 1024
SKETCH_WORDS = 32
SKETCH_BITS = 64 * SKETCH_WORDS
#: Estimated similarity may be lower than the threshold by this much, or by so many
#: standard deviations of the estimate (0.012 at a similarity of 0.85), if more.
MARGIN = 0.06
DEVIATIONS = 4.8
#: Nodes of a bucket that one task compares with as many others.
BLOCK = 1024

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_rng = np.random.default_rng(20240229)
_BASE = np.uint64(int(_rng.integers(1, 1 << 62)) * 2 + 1)
_PLACE = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLY = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
_SALT = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
_powers = np.ones(1, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text, A-Z
    lower-cased; a shorter text is one shingle; none without words."""
    global _powers
    if not text:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    space = _SPACES[raw]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    if not len(edge):
        return np.zeros(0, np.uint64)
    begin, end = edge[::2], edge[1::2]
    longest = int((end - begin).max())
    if longest >= len(_powers):
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * longest, _BASE)]))
    length = end - begin
    # polynomial hash of each word: every byte times the power of its place
    owner = np.repeat(np.arange(len(begin)), length)
    at = np.flatnonzero(~space)
    terms = (raw[at].astype(np.uint64) + np.uint64(1)) * _powers[at - begin[owner]]
    words = _mix(np.add.reduceat(terms, np.cumsum(length) - length) + length.astype(np.uint64))
    n = min(width, len(words))
    count = len(words) - n + 1
    total = np.full(count, np.uint64(n))
    for k in range(n):
        total += words[k : k + count] * _PLACE[k]
    return np.unique(_mix(total))


def signature(grams: np.ndarray) -> np.ndarray:
    """MinHash samples of a non-empty set."""
    out = np.empty(SAMPLES, np.uint64)
    step = max(1, (1 << 15) // len(grams))
    for k in range(0, SAMPLES, step):
        out[k : k + step] = (_MULTIPLY[k : k + step, None] * grams + _ADD[k : k + step, None]).min(axis=1)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples as ``SKETCH_WORDS`` 64-bit numbers."""
    bit = (_mix(samples + _SALT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = (np.bincount(bit, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows): the longest bands of which at most ``MOST_BANDS`` find a pair at the threshold."""
    for rows in range(MOST_ROWS, 0, -1):
        agree = (percent / 100) ** rows
        bands = 1 if agree >= 1 else math.ceil(math.log(MISSED) / math.log1p(-agree)) if agree > 0 else SAMPLES + 1
        if bands <= (MOST_BANDS if rows > 1 else SAMPLES):
            return bands, rows
    raise ValueError(f"{SAMPLES} samples can't find pairs of {percent} % similarity")


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = samples[: bands * rows].reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        key = _mix(key * _PLACE[5] + parts[:, k])
    return key.view(np.int64)


def margin(threshold: float) -> float:
    """How far the estimate may be off: samples that agree by chance, elements that meet on a bit."""
    m, n = 2 * SAMPLES * (1 - threshold), SKETCH_BITS
    met = (n / 4 * (1 - math.exp(-4 * m / n)) - m * math.exp(-4 * m / n)) * math.exp(4 * m / n) / (2 * SAMPLES) ** 2
    return max(MARGIN, DEVIATIONS * math.sqrt(threshold * (1 - threshold) / SAMPLES + max(0.0, met)))


def most_differing(threshold: float) -> int:
    """Ones in the XOR of two sketches up to which a pair may reach the threshold.

    Of ``SAMPLES`` samples about ``(1 - J)`` differ; a differing one adds an
    element on each side, and m elements thrown on n bits leave
    ``n / 2 * (1 - exp(-2 m / n))`` odd ones.
    """
    differ = 2 * SAMPLES * (1 - max(0.0, threshold - margin(threshold)))
    return int(SKETCH_BITS / 2 * (1 - np.exp(-2 * differ / SKETCH_BITS)))


_SIGNED = "id long, text_hash long, n_shingles long, set_hash binary, bands array<bigint>, sketch array<bigint>"


def signatures(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(id, n_shingles, set_hash, bands, sketch) of every row; no bands without words."""
    n_bands, n_rows = banding(percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker()
        for batch in (whole.slice(k, 512) for whole in batches for k in range(0, whole.num_rows, 512)):
            sizes, hashes, bands, sketches = [], [], [], []
            for text in batch.column(1):
                grams = shingles(text.as_py())
                sizes.append(len(grams))
                if not len(grams):
                    hashes.append(None), bands.append(None), sketches.append(None)
                    continue
                samples = signature(grams)
                hashes.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                bands.append(band_keys(samples, n_bands, n_rows))
                sketches.append(odd_sketch(samples))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary()), pa.array(bands, longs), pa.array(sketches, longs)],
                names=["id", "text_hash", "n_shingles", "set_hash", "bands", "sketch"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    return rows.mapInArrow(sign, _SIGNED)


def full_sets(docs: DataFrame) -> DataFrame:
    """(id, grams) of (id, text): the full shingle sets."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                grams = [shingles(t.as_py()).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(grams, pa.list_(pa.int64()))], names=["id", "grams"])

    return docs.mapInArrow(sets, "id long, grams array<bigint>")


def _different_bits(a: Column, b: Column) -> Column:
    ones = [F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(SKETCH_WORDS)]
    return sum(ones[1:], ones[0])


def confirm(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of node ids whose full sets reach ``percent`` similarity.

    ``docs`` is (id, text).  Only the texts named in pairs are shingled again.
    The sets of ``b`` travel once per pair, those of ``a`` once.
    """
    ids = spill(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "dup_ids")
    texts = docs.join(ids, "id", "left_semi")
    sets = spill(full_sets(texts), "dup_sets")
    first = sets.select(F.col("id").alias("a"), F.col("grams").alias("grams_a"))
    second = sets.select(F.col("id").alias("b"), F.col("grams").alias("grams_b"))
    both = pairs.join(second, "b").join(first, "a")
    shared = F.size(F.array_intersect("grams_a", "grams_b"))
    union = F.size("grams_a") + F.size("grams_b") - shared
    return both.filter(shared * 100 >= union * percent).select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every linked node: the smallest id that it reaches.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so long chains shrink by doubling; every round is one
    aggregation and two joins over links, written to the shared folder.
    """
    edges = spill(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "dup_edges")
    labels = spill(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "dup_labels")
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), F.col("label").alias("theirs")), "b")
        best = near.groupBy(F.col("a").alias("id")).agg(F.min("theirs").alias("theirs"))
        merged = labels.join(best, "id").select("id", "label", F.least("label", "theirs").alias("low"))
        root = labels.select(F.col("id").alias("low"), F.col("label").alias("lower"))
        step = spill(merged.join(root, "low").select("id", "lower", (F.col("lower") < F.col("label")).alias("moved")), "dup_labels")
        drop_spill(labels)
        labels = step.select("id", F.col("lower").alias("label"))
        if step.filter("moved").limit(1).count() == 0:
            return labels


def _search_blocks(limit: int, nearest: bool, n_bands: int):
    """Pairs in different components with similar sketches, of each (bucket, block, block).

    Rows come sorted by (key, low, high).  ``nearest`` gives each node's most
    similar one only; else a pair that shares several bands is given by the
    first one.
    """

    def pairs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        key, low, high = (rows.column(c)[0].as_py() for c in ("key", "low", "high"))
        side, node, label = (rows.column(c).to_numpy() for c in ("block", "id", "label"))
        bands = _matrix(rows.column("bands"), n_bands)
        # unsigned: numpy counts the ones of a negative number's magnitude
        sketch = _matrix(rows.column("sketch"), SKETCH_WORDS).view(np.uint64)
        band = int(np.flatnonzero(bands[0] == key)[0])
        left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
        out_a, out_b = [], []
        for i in left:
            there = right[label[right] != label[i]]
            if low == high and not nearest:
                there = there[node[there] > node[i]]
            differ = np.bitwise_count(sketch[there] ^ sketch[i]).sum(axis=1)
            if nearest:
                there = there[[int(np.argmin(differ))]] if len(differ) and differ.min() <= limit else there[:0]
            else:
                there = there[differ <= limit]
                there = there[~(bands[there, :band] == bands[i, :band]).any(axis=1)]
            out_a.append(np.minimum(node[there], node[i])), out_b.append(np.maximum(node[there], node[i]))
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if rest is None else pa.concat_tables([rest, part]).combine_chunks()
            groups = np.stack([part.column(c).to_numpy() for c in ("key", "low", "high")])
            cuts = np.flatnonzero((groups[:, 1:] != groups[:, :-1]).any(axis=0)) + 1
            begin = 0
            for end in cuts.tolist():
                yield from emit(part.slice(begin, end - begin))
                begin = end
            rest = part.slice(begin)
        if rest is not None and rest.num_rows:
            yield from emit(rest)

    def emit(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        a, b = pairs(rows)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).reshape(-1, width)


def _mixed_pairs(shared: DataFrame, nodes: DataFrame, labels: DataFrame, limit: int, nearest: bool, n_bands: int) -> DataFrame:
    """Similar pairs of different components from the buckets that hold several."""
    placed = shared.join(labels, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    placed = spill(placed, "dup_placed")
    mixed = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    mixed = mixed.select("key", F.expr(f"cast((n + {BLOCK - 1}) div {BLOCK} as int)").alias("blocks"))
    rows = placed.join(mixed, "key").join(nodes.select("id", "sketch", "bands").dropDuplicates(["id", "bands"]), "id")
    rows = rows.filter(F.array_contains("bands", F.col("key")))  # of a repeated id, the text that is in the bucket
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other", "blocks")
    parts = shuffle_partitions(shared.sparkSession)
    dealt = rows.repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high", "id")
    return dealt.mapInArrow(_search_blocks(limit, nearest, n_bands), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row per input row: (id, n_shingles, component_id, kept, text_hash).

    Texts whose shingle sets have ``100 * shared >= percent * union`` are linked;
    ``component_id`` is the smallest id reachable and ``kept`` tells whether it
    is the row's own.  Null, empty and blank texts have no shingles and are
    linked with nothing (their own component).  Rows that repeat an id count as
    one document with several texts; a null id is no component's smallest unless
    all are null, then ``component_id`` is null and the row is kept.  An empty
    table gives an empty result; other columns are ignored.
    """
    limit = most_differing(percent / 100)
    signed = spill(signatures(docs, id_col, text_col, percent), "dup_signed")
    classes = signed.filter("set_hash is not null").groupBy("set_hash").agg(F.min("id").alias("node"))
    classes = spill(classes, "dup_classes")
    # one row per node: any document with the class's set and smallest id
    members = signed.join(classes, "set_hash").select("id", "n_shingles", "node", "bands", "sketch")
    nodes = spill(members.filter("id = node").select("id", "n_shingles", "bands", "sketch").dropDuplicates(["id", "bands"]), "dup_nodes")
    # bands of nodes that share a bucket with another node
    entries = nodes.select("id", "n_shingles", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).filter("pivot < last")
    shared = spill(entries.join(buckets.select("key", "pivot"), "key").select("key", "pivot", "id"), "dup_shared")
    sketches = nodes.select("id", "sketch", "n_shingles")

    star = shared.filter("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    tested = spill(_alike(star, sketches, limit, percent), "dup_star")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    links = spill(confirm(tested, texts, percent), "dup_links")
    labels = components(links)
    for nearest in (True, False):
        found = _mixed_pairs(shared, nodes, labels, limit, nearest, banding(percent)[0])
        fresh = spill(_alike(found.join(tested, ["a", "b"], "left_anti"), sketches, limit, percent), "dup_found")
        tested = tested.unionByName(fresh)
        more = spill(confirm(fresh, texts, percent), "dup_more")
        if more.limit(1).count():
            links = links.unionByName(more)
            labels = components(links)

    own = signed.select("id", "text_hash", "n_shingles", "set_hash").join(classes, "set_hash", "left")
    final = own.join(labels.withColumnRenamed("id", "node"), "node", "left")
    component = F.coalesce("label", "node", "id")
    return final.select("id", "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), "text_hash")


def _alike(pairs: DataFrame, sketches: DataFrame, limit: int, percent: int) -> DataFrame:
    """Pairs whose sketches and set sizes allow the similarity."""
    one = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sa"), F.col("n_shingles").alias("na"))
    two = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sb"), F.col("n_shingles").alias("nb"))
    both = pairs.join(one, "a").join(two, "b")
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    return both.filter(sizes & (_different_bits(F.col("sa"), F.col("sb")) <= limit)).select("a", "b").distinct()


def op7_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
