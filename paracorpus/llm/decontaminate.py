"""Benchmark decontamination by the q-gram lemma.

A passage of m characters that occurs in a text with at most k edits shares at
least ``m - q + 1 - k * q`` q-grams with it, and all of them lie on diagonals
(text position minus passage position) at most k apart.  The shared q-grams of
every document are counted in diagonal bands that overlap by k; bands that
reach the passage's bound are verified by banded alignment, many at a time.

The lemma holds for any part of a passage's q-grams too: of r of them at least
``r - k * q`` are shared.  So q-grams that many passages have (a common prompt) are
left out where the rest still gives a bound, and cost nothing in texts that hold
only them.  q is 12, or the largest smaller one that gives a passage a bound.

The benchmark is the query set: it is indexed in blocks of bounded size and
every block is compared with all documents, so no document is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paracorpus.llm.common import fresh_worker, spill

#: q-gram length, shorter ones for passages that it gives no bound, and edits per passage character.
Q = 12
SHORTER = (10, 8, 6, 4)
EDIT_RATE = 0.05
#: A q-gram of more passages than this is common.
COMMON = 16
#: Candidates that are aligned at a time.
ALIGNED = 2048
#: Characters of benchmark text in one index block.
BLOCK_CHARS = 4_000_000
#: Characters of documents that are searched at a time.
CHUNK_CHARS = 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_TABLE_BITS = 22
_SCHEMA = "doc_id long, item_id long, start long, end long, edits int"


def normal(text: str) -> str:
    """Without case, runs of blanks as one space."""
    return " ".join(text.replace("\x00", " ").casefold().split())


def offsets(text: str) -> list[int]:
    """Place in ``text`` of every character of ``normal(text)``, and its end."""
    out: list[int] = []
    gap = None
    for i, c in enumerate(text):
        if c == "\x00" or c.isspace():
            gap = i if gap is None else gap
            continue
        if gap is not None and out:
            out.append(gap)
        gap = None
        out.extend([i] * len(c.casefold()))
    return out


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(chars: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of every q-gram: polynomials of doubling windows, joined for ``q``."""
    if len(chars) < q:
        return np.zeros(0, np.uint64)
    grown, width, done, used = chars.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if q & width:
            done = grown if done is None else done[: len(grown) - used] + grown[used:] * _power(used)
            used += width
        if 2 * width > q:
            break
        grown = grown[:-width] + grown[width:] * _power(width)
        width *= 2
    h = done[: len(chars) - q + 1]
    return h ^ (h >> np.uint64(29))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


class _Grams:
    """The q-grams of those passages that are searched by one q, for texts of many passages."""

    def __init__(self, q: int, numbers: list[int], grams: list[np.ndarray], bounds: list[int], places: list[np.ndarray]):
        self.q = q
        hashes = np.concatenate(grams)
        order = np.argsort(hashes, kind="stable")
        self.grams, self.first = np.unique(hashes[order], return_index=True)
        self.last = np.append(self.first[1:], len(hashes))
        self.item = np.repeat(numbers, [len(g) for g in grams])[order]
        self.place = np.concatenate(places)[order]
        self.bound = dict(zip(numbers, bounds, strict=True))
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self._slot(self.grams)] = True

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return ((grams * _BASE) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def hits(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text place, item, item place) of all shared q-grams."""
        at, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for begin in range(0, max(len(chars) - self.q + 1, 0), CHUNK_CHARS):
            h = gram_hashes(chars[begin : begin + CHUNK_CHARS + self.q - 1], self.q)
            near = np.flatnonzero(self.table[self._slot(h)])
            k = np.searchsorted(self.grams, h[near])
            same = np.flatnonzero((k < len(self.grams)) & (self.grams[np.minimum(k, len(self.grams) - 1)] == h[near]))
            at.append(near[same] + begin), found.append(k[same])
        at, found = np.concatenate(at), np.concatenate(found)
        times = self.last[found] - self.first[found] if len(found) else np.zeros(0, np.int64)
        total = int(times.sum())
        which = np.repeat(self.first[found], times) + np.arange(total) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(at, times), self.item[which], self.place[which]


def _searches(texts: list[str], edits: np.ndarray) -> list[_Grams]:
    """Every passage of ``SHORTER[-1]`` characters by one q with a positive bound.

    The largest q whose rare grams alone give a bound is best; else the largest q
    whose grams do.
    """
    dealt: dict[int, tuple[list, list, list, list]] = {}
    waiting = [k for k, t in enumerate(texts) if t]
    for every in (False, True):
        for q in (Q, *SHORTER):
            rest, mine = [], dealt.setdefault(q, ([], [], [], []))
            hashes = {k: gram_hashes(codes(texts[k]), q) for k in waiting}
            if not every and waiting:
                distinct = np.concatenate([np.unique(h) for h in hashes.values()])
                value, count = np.unique(distinct, return_counts=True)
                common = value[count > COMMON]
            for k in waiting:
                h = hashes[k]
                rare = np.arange(len(h)) if every else np.flatnonzero(~np.isin(h, common))
                bound = len(rare) - int(edits[k]) * q
                if bound < 1:
                    rest.append(k)
                    continue
                mine[0].append(k), mine[1].append(h[rare]), mine[2].append(bound), mine[3].append(rare)
            waiting = rest
    return [_Grams(q, *x) for q, x in dealt.items() if x[0]]


class PassageIndex:
    """The q-grams of one block of passages."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.ids = [i for i, _ in items]
        self.texts = [normal(t) for _, t in items]
        self.codes = [codes(t) for t in self.texts]
        lengths = np.array([len(t) for t in self.texts], np.int64)
        #: edits: the rate, or fewer where no q gives a bound
        self.edits = np.maximum(np.minimum((lengths * rate).astype(np.int64), lengths // SHORTER[-1] - 1), 0)
        self.shift = np.array([int(k).bit_length() for k in self.edits], np.int64)  # band width: 2**shift > edits
        self.searches = _searches(self.texts, self.edits)
        sought = {k for s in self.searches for k in s.bound}
        self.short = [k for k, t in enumerate(self.texts) if t and k not in sought]

    def _bands(self, search: _Grams, chars: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, item, band) of the bands that reach their passage's bound."""
        at, item, place = search.hits(chars)
        text = np.searchsorted(starts, at, side="right") - 1
        reach, shift = self.edits[item], self.shift[item]
        diagonal = at - starts[text] - place + reach  # none that counts is negative
        ok = diagonal >= 0
        band, rest = diagonal >> shift, diagonal & ((1 << shift) - 1)
        lower = np.flatnonzero(ok & (rest < reach) & (band > 0))
        upper = np.flatnonzero(ok)
        hit, band = np.concatenate([upper, lower]), np.concatenate([band[upper], band[lower] - 1])
        order = np.lexsort((band, item[hit], text[hit]))
        text, item, band = text[hit][order], item[hit][order], band[order]
        new = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1]))[: len(order)]
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(order)))
        bound = np.array([search.bound[k] for k in item[begin].tolist()], np.int64)
        begin = begin[count >= bound]
        return text[begin], item[begin], band[begin]

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, start, end, edits) in normalised texts, best of overlapping ones."""
        chars = codes("\x00".join(texts))
        starts = np.cumsum([0, *[len(t) + 1 for t in texts]])[: len(texts)]
        out: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for search in self.searches:
            found = self._bands(search, chars, starts)
            for k in range(0, len(found[0]), ALIGNED):
                some = [x[k : k + ALIGNED].tolist() for x in found]
                windows, begins = [], []
                for t, i, band in zip(*some, strict=True):
                    edits, width = int(self.edits[i]), 1 << int(self.shift[i])
                    low = band * width - edits  # the band's diagonals in text places
                    begins.append(max(0, low - edits))
                    stop = min(low + width + 2 * edits + len(self.texts[i]), len(texts[t]))
                    windows.append(chars[starts[t] + begins[-1] : starts[t] + max(stop, begins[-1])])
                aligned = align([self.codes[i] for i in some[1]], windows, self.edits[some[1]])
                for t, i, begin, region in zip(some[0], some[1], begins, aligned, strict=True):
                    if region is not None:
                        out.setdefault((t, i), []).append((region[2], begin + region[0], begin + region[1]))
        for i in self.short:
            for t, body in enumerate(texts):
                p = body.find(self.texts[i])
                while p >= 0:
                    out.setdefault((t, i), []).append((0, p, p + len(self.texts[i])))
                    p = body.find(self.texts[i], p + len(self.texts[i]))
        result = []
        for (t, i), spans in sorted(out.items()):
            taken: list[tuple[int, int]] = []
            for edits, a, b in sorted(spans):
                if all(b <= x or y <= a for x, y in taken):
                    taken.append((a, b))
                    result.append((t, i, a, b, edits))
        return result


def _ends(passage: np.ndarray, window: np.ndarray, free_start: bool) -> np.ndarray:
    """Edits to the whole passage of the best region that ends at each place of the window."""
    places = np.arange(len(window) + 1)
    row = np.zeros(len(window) + 1, np.int64) if free_start else places.copy()
    for k, c in enumerate(passage):
        step = np.empty_like(row)
        step[0] = k + 1
        step[1:] = np.minimum(row[:-1] + (window != c), row[1:] + 1)
        row = np.minimum.accumulate(step - places) + places  # steps along the window
    return row


def align(passages: list[np.ndarray], windows: list[np.ndarray], edits: np.ndarray) -> list[tuple[int, int, int] | None]:
    """(start, end, edits) of the best region of each window within ``edits`` of its passage.

    The window is the band's stretch of text, little longer than the passage.
    Rows are computed over the diagonals of the bands only, for all pairs at once.
    """
    out: list[tuple[int, int, int] | None] = [None] * len(passages)
    if not passages:
        return out
    ends, costs = _banded(passages, windows, edits)
    for k in np.flatnonzero(costs <= edits).tolist():
        passage, end = passages[k], int(ends[k])
        back = _ends(passage[::-1], windows[k][max(0, end - len(passage) - int(edits[k])) : end][::-1], False)
        out[k] = end - int(np.argmin(back)), end, int(costs[k])
    return out


def _banded(passages: list[np.ndarray], windows: list[np.ndarray], edits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, edits) of the best region of each window: only diagonals from -edits to the spare length count."""
    m, n = (np.array([len(x) for x in y], np.int64) for y in (passages, windows))
    longest, margin = int(m.max()), int(edits.max())
    width = int((np.maximum(n - m, 0) + 2 * edits).max()) + 1  # diagonals -edits .. n - m + edits
    pattern = np.full((longest, len(m)), 0xFFFFFFFE, np.uint32)
    padded = np.full((len(m), margin + longest + width + int(n.max())), 0xFFFFFFFF, np.uint32)
    for k, (p, w) in enumerate(zip(passages, windows, strict=True)):
        pattern[: len(p), k] = p
        padded[k, int(edits[k]) : int(edits[k]) + len(w)] = w
    diagonals = np.arange(width, dtype=np.int32)
    far = np.int32(1 << 29)
    row = np.where(diagonals >= edits[:, None], np.int32(0), far)  # free start; no place before the window
    last = row.copy()
    alive = np.arange(len(m))
    for k in range(longest):
        cross = row + (padded[alive, k : k + width] != pattern[k, alive, None])
        np.minimum(cross[:, :-1], row[:, 1:] + 1, out=cross[:, :-1])
        row = np.minimum.accumulate(cross - diagonals, axis=1) + diagonals
        done = m[alive] == k + 1
        last[alive[done]] = row[done]
        going = ~done & (row.min(axis=1) <= edits[alive])
        last[alive[~done & ~going]] = far
        if not going.all():
            alive, row = alive[going], row[going]
            if not len(alive):
                break
    place = diagonals - edits[:, None] + m[:, None]
    last = np.where((place >= 0) & (place <= n[:, None]), last, far)
    best = np.argmin(last, axis=1)
    each = np.arange(len(m))
    return place[each, best], last[each, best].astype(np.int64)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """Passages in blocks of about BLOCK_CHARS characters, by a hash of their ids."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter("t is not null")
    total = items.agg(F.sum(F.char_length("t"))).first()[0] or 0
    n = -(-total // BLOCK_CHARS)
    for k in range(n):
        yield sorted((r["i"], r["t"]) for r in items.filter(F.pmod(F.xxhash64("i"), F.lit(n)) == k).distinct().collect())


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    rate: float = EDIT_RATE,
) -> DataFrame:
    """(doc_id, item_id, start, end, edits): every region of a text within
    ``rate`` edits per character of a benchmark passage, after case and runs of
    blanks are set aside; start and end are code points of the original text.

    Overlapping regions of one passage give the one with the fewest edits, ties
    the first.  Passages under 20 characters have no edits and those under
    ``SHORTER[-1]`` are searched as they are.
    Null, empty and blank texts and passages match nothing; repeated rows give
    their regions each; an empty table gives an empty result; other columns are
    ignored.  The driver holds one block of passages at a time.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for items in _blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast((items, rate))
        found = rows.mapInArrow(_search(shared), _SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else rows.limit(0).selectExpr("doc_id", "doc_id item_id", "doc_id start", "doc_id end", "cast(doc_id as int) edits")


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker()
        items, rate = shared.value
        index = PassageIndex(items, rate)

        def flush(held: list[tuple[int, str, str]]) -> pa.RecordBatch:
            found = index.search([h[2] for h in held])
            rows, mapped = [], {}
            for t, i, a, b, edits in found:
                if t not in mapped:
                    mapped[t] = offsets(held[t][1])
                places = mapped[t]
                rows.append((held[t][0], index.ids[i], places[a], places[b - 1] + 1, edits))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(5)]
            kinds = [pa.int64()] * 4 + [pa.int32()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "start", "end", "edits"]
            )

        held, size = [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if text and (body := normal(text)):
                    held.append((key, text, body))
                    size += len(body)
                    if size >= CHUNK_CHARS:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark passage.

    Rows are judged by id and text: a row stays or goes by its own text, also
    where it has no id or shares it with other rows.
    """
    key = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.col(text_col))
    keyed = docs.select(key.alias("__key"), F.col(text_col).alias("__text"))
    hit = spill(contaminations(keyed, benchmark, "__key", "__text", **options).select(F.col("doc_id").alias("__hit")).distinct(), "leaks")
    return docs.join(hit, key == F.col("__hit"), "left_anti")


def op8_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminations(docs, benchmark)
