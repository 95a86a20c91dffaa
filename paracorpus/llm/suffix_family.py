"""Repeated strings of whole texts through a logarithmic family of suffix arrays.

Documents are read in batches of ascending ids.  A batch gets a sparse suffix array:
its sampled suffixes in the order of the fingerprint of their first ``GRAM`` bytes and
then of the context around them.  (Equal strings meet in any total order, and ranges
of fingerprints are even, so this order is dealt to tasks instead of the bytes' own.)
A suffix is sampled where its gram is the least one of some window of ``LENGTH`` bytes:
equal windows sample equal places, so a string that occurs twice has common samples.

The array's ranges go to tasks, and every range keeps a family of levels there.  A new
batch is merge-scanned against the levels, which hold all earlier batches, and becomes
a level itself; levels of equal size merge, so n batches make log n levels and an
entry is merged log n times.  A scan tells of every entry

* found: an earlier batch has the whole context, so all its windows repeat;
* mixed: the gram has other contexts too.  Only the windows of these entries, each in
  the first document that has the context, go through a second family, whose entries
  are the windows themselves.

The verdicts return to their batch as one byte an entry; repeats inside a batch are
judged by its own arrays.  Strings are compared by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paracorpus.llm.common import shuffle_partitions, spill

#: Bytes of a string that counts, and of the gram that samples it.
LENGTH, GRAM = 50, 24
#: Grams of a window.
SPAN = LENGTH - GRAM + 1
#: Bytes of texts in a batch (or one longer text), windows that are sampled at a time.
BATCH_BYTES, SLICE = 6 << 20, 1 << 18
#: Entries that a range of the arrays should hold.
RANGE_ENTRIES = 1 << 18

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_CODEC = "zstd"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _lanes(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number."""
    return np.ndarray(max(len(raw) - 7, 0), "<u8", np.ascontiguousarray(raw), 0, (1,))


def _hash(lanes: np.ndarray, at: np.ndarray | slice, size: int, seed: int) -> np.ndarray:
    """Hash of the ``size`` bytes (8 at least) from each place on."""
    h = np.uint64(seed)
    for k in [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]:
        h = _mix((lanes[at.start + k : at.stop + k] if isinstance(at, slice) else lanes[at + k]) ^ h)
    return h


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    out, have = values, 1
    while 2 * have <= width:
        out, have = best(out[:-have], out[have:]), 2 * have
    return best(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def _order(major: np.ndarray, *ties: np.ndarray) -> np.ndarray:
    """The places in the order of ``major``, equal ones by ``ties``."""
    order = np.argsort(major, kind="stable")
    a = major[order]
    same = a[1:] == a[:-1]
    some = np.flatnonzero(np.append(False, same) | np.append(same, False)[: len(a)])
    order[some] = order[some][np.lexsort((*[t[order[some]] for t in reversed(ties)], a[some]))]
    return order


def samples(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text number, low, high, gram, context) of every sampled suffix of joined texts.

    ``ends`` are the ends of the texts.  The windows that a sample stands for begin
    at the places ``low`` to ``high``: a stretch of windows with the same least gram,
    ``SPAN`` at most.
    """
    none, far = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(raw) < LENGTH:
        return none, none, none, far, far
    lanes = _lanes(raw)
    least = _sliding(_hash(lanes, slice(0, len(raw) - GRAM + 1), GRAM, 1), SPAN, np.minimum)
    cut = (ends[:, None] - np.arange(1, LENGTH)).ravel()
    least[cut[(cut >= 0) & (cut < len(least))]] = 0  # no window begins there
    low = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    high = np.append(low[1:], len(least)) - 1
    # two texts that touch have windows between them that begin nowhere, so no stretch spans both
    low, high = low[least[low] != 0], high[least[low] != 0]
    pieces = (high - low) // SPAN + 1
    if len(pieces) and pieces.max() > 1:
        which = np.repeat(np.arange(len(low)), pieces)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        low, high = low[which] + nth * SPAN, np.minimum(high[which], low[which] + nth * SPAN + SPAN - 1)
    # the windows at both ends cover the whole context
    context = _mix(_hash(lanes, low, LENGTH, 2) + (high - low).astype(np.uint64)) ^ _hash(lanes, high, LENGTH, 3)
    return np.searchsorted(ends, low, "right"), low, high, least[low], context


class Batch:
    """The texts of one batch and its suffix array; ids ascend."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, raw: np.ndarray):
        self.ids, self.raw = ids, raw
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        found = []
        k = 0
        while k < len(ids):
            n = max(k + 1, int(np.searchsorted(self.ends, self.starts[k] + SLICE, "right")))
            base, stop = int(self.starts[k]), int(self.ends[n - 1])
            if n > k + 1:
                found.append((k, base, samples(raw[base:stop], self.ends[k:n] - base)))
            else:  # a longer text in slices whose windows follow one another
                for a in range(base, max(stop - LENGTH + 1, base), SLICE):
                    b = min(a + SLICE + LENGTH - 1, stop)
                    found.append((k, a, samples(raw[a:b], np.array([b - a]))))
            k = n
        none, far = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        self.text = np.concatenate([none, *[x[0] + k for k, _, x in found]])
        self.low, self.high = (np.concatenate([none, *[x[i] + base for _, base, x in found]]) for i in (1, 2))
        gram, context = (np.concatenate([far, *[x[i] for _, _, x in found]]) for i in (3, 4))
        self.keys, self.entry, self.first = self._array(gram, context, self.text)

    def _array(self, major: np.ndarray, minor: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (major, minor) in order, the entry of each occurrence, and the first occurrence of each entry."""
        order = _order(major, minor, text)
        a, b = major[order], minor[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
        entry = np.empty(len(a), np.int64)
        entry[order] = np.cumsum(new) - 1
        return np.stack([a[new], b[new]]), entry, order[new]

    def later(self, entry: np.ndarray, first: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Which occurrences have their entry in a document of this batch with a smaller id."""
        return self.ids[text] > self.ids[text[first[entry]]]

    def windows(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, place) of the windows to be compared one by one: those of mixed entries in the first document that has them."""
        k = np.flatnonzero((codes[self.entry] == 2) & ~self.later(self.entry, self.first, self.text))
        count = self.high[k] - self.low[k] + 1
        return np.repeat(self.text[k], count), np.repeat(self.low[k] + count - np.cumsum(count), count) + np.arange(int(count.sum()))

    def window_array(self, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(keys, entry, first, text, place) of the windows' own array."""
        text, place = self.windows(codes)
        lanes = _lanes(self.raw)
        return *self._array(_hash(lanes, place, LENGTH, 4), _hash(lanes, place, LENGTH, 5), text), text, place

    def removed(self, codes: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Whether each byte goes, by the verdicts on entries and on windows."""
        whole = (codes[self.entry] == 1) | self.later(self.entry, self.first, self.text)
        _, entry, first, text, place = self.window_array(codes)
        single = (found[entry] == 1) | self.later(entry, first, text)
        edge = np.zeros(len(self.raw) + 1, np.int32)
        np.add.at(edge, self.low[whole], 1), np.add.at(edge, self.high[whole] + LENGTH, -1)
        np.add.at(edge, place[single], 1), np.add.at(edge, place[single] + LENGTH, -1)
        return np.cumsum(edge[:-1]) > 0


class Family:
    """Levels of sorted (major, minor) entries; level k holds the entries of up to 2**k batches."""

    def __init__(self):
        self.levels: list[np.ndarray | None] = []

    def scan(self, keys: np.ndarray) -> np.ndarray:
        """Which entries of a batch some level has."""
        found = np.zeros(keys.shape[1], bool)
        for level in self.levels:
            if level is None:
                continue
            low, high = np.searchsorted(level[0], keys[0], "left"), np.searchsorted(level[0], keys[0], "right")
            some = np.flatnonzero(high > low)
            low, stop, minor = low[some], high[some], keys[1][some]
            high = stop
            while (low < high).any():  # of equal majors, the first minor not below
                mid = (low + high) >> 1
                below = (low < high) & (level[1][np.minimum(mid, level.shape[1] - 1)] < minor)
                low, high = np.where(below, mid + 1, low), np.where(below | (low >= high), high, mid)
            at = np.minimum(low, level.shape[1] - 1)
            found[some[(low < stop) & (level[1][at] == minor)]] = True
        return found

    def add(self, keys: np.ndarray) -> None:
        """A batch's array as a level of its own; equal levels merge."""
        k = 0
        while k < len(self.levels) and self.levels[k] is not None:
            keys = self.merged(self.levels[k], keys)
            self.levels[k] = None
            k += 1
        if k == len(self.levels):
            self.levels.append(None)
        self.levels[k] = keys

    @staticmethod
    def merged(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        both = np.concatenate([one, two], axis=1)
        order = _order(both[0], both[1])
        major, minor = both[0][order], both[1][order]
        new = np.append(True, (major[1:] != major[:-1]) | (minor[1:] != minor[:-1]))[: len(order)]
        return np.stack([major[new], minor[new]])

    def all(self) -> np.ndarray:
        out = np.zeros((2, 0), np.uint64)
        for level in self.levels:
            out = out if level is None else self.merged(out, level)
        return out


def verdicts(batches: list[np.ndarray]) -> list[np.ndarray]:
    """One code for each entry of batches in ascending order: 1 found, 2 mixed, 0 neither."""
    family, found = Family(), []
    for keys in batches:
        found.append(family.scan(keys))
        family.add(keys)
    major = family.all()[0]
    several = major[1:][major[1:] == major[:-1]]
    out = []
    for keys, hit in zip(batches, found, strict=True):
        k = np.searchsorted(several, keys[0])
        mixed = several[np.minimum(k, len(several) - 1)] == keys[0] if len(several) else np.zeros(len(hit), bool)
        out.append(np.where(hit, 1, np.where(mixed, 2, 0)).astype(np.uint8))
    return out


_BATCH = "batch long, n_bytes long, ids binary, sizes binary, texts binary"
_PARTS = "part long, batch long, entries binary"
_CODES = "batch long, part long, codes binary"


def _squeezed(raw) -> bytes:
    return pa.compress(raw, _CODEC, asbytes=True)


def _unpacked(row: dict) -> Batch:
    texts = pa.decompress(row["texts"], row["n_bytes"], _CODEC, asbytes=True) if row["n_bytes"] else b""
    return Batch(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["sizes"], "<i8"), np.frombuffer(texts, np.uint8))


def batched(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of whole texts in ascending id order, ``BATCH_BYTES`` or one text each; batch numbers ascend too.

    A null id is below all others.  Rows of one id stay in one batch.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.col(text_col).cast("binary").alias("text"))
    dealt = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "id").sortWithinPartitions("id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def row() -> pa.RecordBatch:
            sizes = np.fromiter(map(len, texts), "<i8", len(texts))
            columns = [[(part << 32) + n], [size], [np.array(ids, "<i8").tobytes()], [sizes.tobytes()], [_squeezed(b"".join(texts))]]
            kinds = [pa.int64()] * 2 + [pa.binary()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _BATCH.split(", ")])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if size >= BATCH_BYTES and key != ids[-1]:
                    yield row()
                    n, ids, texts, size = n + 1, [], [], 0
                texts.append(text.as_py() or b"")
                ids.append(key)
                size += len(texts[-1])
        if ids:
            yield row()

    return spill(dealt.mapInArrow(pack, _BATCH), "suffix_batches")


def _parts(keys: np.ndarray, batch: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A batch's array cut to the ranges of the first ``bits`` bits."""
    part = (keys[0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(keys.shape[1], np.int64)
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)]), len(part))
    for a in range(0, len(cuts) - 1, 64):  # a few ranges at a time
        some = cuts[a : a + 65]
        blobs = [np.ascontiguousarray(keys[:, i:j]).tobytes() for i, j in zip(some[:-1].tolist(), some[1:].tolist(), strict=True)]
        columns = [pa.array(part[some[:-1]]), pa.array([batch] * len(blobs), pa.int64()), pa.array(blobs, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "batch", "entries"])


def judged(parts: DataFrame) -> DataFrame:
    """(batch, codes): the verdicts on each batch's entries, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, numbers, held = None, [], []

        def flush() -> pa.RecordBatch:
            codes = [_squeezed(c.tobytes()) for c in verdicts(held)]
            kinds = [pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([numbers, [part] * len(codes), codes], kinds, strict=True)], names=["batch", "part", "codes"])

        for rows in batches:
            for p, batch, blob in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(2), strict=True):
                if p != part and held:
                    yield flush()
                    numbers, held = [], []
                part = p
                numbers.append(batch), held.append(np.frombuffer(blob.as_py(), np.uint64).reshape(2, -1))
        if held:
            yield flush()

    n = shuffle_partitions(parts.sparkSession)
    dealt = parts.repartition(n, "part").sortWithinPartitions("part", "batch")
    codes = dealt.mapInArrow(run, _CODES)
    # as many rows for a batch as its array has ranges
    return codes.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("part", "codes"))).alias("parts")).select("batch", F.col("parts.codes").alias("codes"))


def _codes(blobs: list[bytes] | None, n: int) -> np.ndarray:
    """The verdicts on ``n`` entries from the blobs of their ranges."""
    out = [np.frombuffer(pa.Codec(_CODEC).decompress(b, _size(b), asbytes=True), np.uint8) for b in blobs or []]
    codes = np.concatenate([np.zeros(0, np.uint8), *out])
    if len(codes) != n:
        raise ValueError(f"{len(codes)} verdicts on {n} entries")
    return codes


def _size(blob: bytes) -> int:
    import zstandard

    return zstandard.frame_content_size(blob)


def _per_batch(rows: DataFrame, work, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for k in range(some.num_rows):
                yield from work(some.slice(k, 1).to_pylist()[0])

    return rows.mapInArrow(run, schema)


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans).

    A byte is removed if a string of ``LENGTH`` bytes covers it that also begins in
    a document with a smaller id; strings are judged on the input.  ``spans`` are the
    maximal removed runs as byte offsets, end exclusive.  Rows that repeat an id
    are one document: they remove nothing from each other.  A null id is below all
    others and stays null.  Null texts are empty; texts below ``LENGTH`` bytes keep
    all.  An empty table gives an empty result; other columns are ignored.
    """
    texts = batched(docs, id_col, text_col)
    total = texts.agg(F.sum("n_bytes")).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1.0, total * 2 / (SPAN + 1) / RANGE_ENTRIES)))))

    def sampled(row: dict) -> Iterator[pa.RecordBatch]:
        yield from _parts(_unpacked(row).keys, row["batch"], bits)

    def opened(row: dict) -> Iterator[pa.RecordBatch]:
        batch = _unpacked(row)
        yield from _parts(batch.window_array(_codes(row["codes"], batch.keys.shape[1]))[0], row["batch"], bits)

    def cut(row: dict) -> Iterator[pa.RecordBatch]:
        batch = _unpacked(row)
        codes = _codes(row["codes"], batch.keys.shape[1])
        gone = batch.removed(codes, _codes(row["found"], batch.window_array(codes)[0].shape[1]))
        rows = []
        for key, a, b in zip(batch.ids.tolist(), batch.starts.tolist(), batch.ends.tolist(), strict=True):
            flags, raw = gone[a:b], batch.raw[a:b]
            edge = np.flatnonzero(np.diff(flags, prepend=False, append=False))
            spans = [{"start": i, "end": j} for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
            kept = raw[~flags] if len(edge) else raw
            rows.append((None if key == -(1 << 63) else key, b - a, int(flags.sum()), len(spans), hashlib.sha256(kept.tobytes()).hexdigest(), spans))
        kinds = [*[pa.int64()] * 4, pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    codes = spill(judged(_per_batch(texts, sampled, _PARTS)), "suffix_codes")
    with_codes = texts.join(codes, "batch", "left")
    found = spill(judged(_per_batch(with_codes, opened, _PARTS)), "suffix_windows")
    both = codes.join(found.withColumnRenamed("codes", "found"), "batch", "left")
    return _per_batch(texts.join(both, "batch", "left"), cut, _OUT)


def op13_query(docs: DataFrame) -> DataFrame:
    return repeated_strings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
