"""Periodic runs of words, found on a Re-Pair grammar.

The texts of a batch become one sequence of word ids with a mark after every text.
Re-Pair replaces pairs of neighbours that occur twice or more by nonterminals, round
by round; in a round a pair is taken wherever it is more frequent than both pairs
that overlap it.  What stays of a text is joined pairwise, so every text is derived
from one tree of rules ``X -> Y Z``, and a rule that is used again is stored once.

A run lies inside the lowest nonterminal that holds it whole and crosses its boundary
there.  So the runs that cross a boundary are computed once for each rule, at its first
place, and moved to all other places where the rule is derived.  A stretch that goes on
beyond a nonterminal is found whole at a higher one; merging keeps the maximal ones.

A run of four periods has two of them on one side of the boundary, so the periods to
try are those of a square that ends or begins there.  Its first ``2**k`` words occur
again at a distance from ``2**k`` up to ``2**(k+1)``: these places come from hashes of
``2**k`` words and are compared word by word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least words of a run and least periods in it.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Words of texts that share a grammar; a longer text has its own.
BATCH_WORDS = 400_000
#: Periods up to this are tried at every boundary, longer ones from hashes.
DIRECT = 8


def numbered(words: list[bytes]) -> np.ndarray:
    return pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)


class Grammar:
    """Rules of a Re-Pair grammar, and every place where one is derived.

    ``first``, ``cut`` and ``end`` give, for each rule, its first place in the
    sequence and there the boundary between its two sides and its end;
    ``rules`` and ``places`` list all derivations, sorted by rule.
    """

    def __init__(self, sequence: np.ndarray, text: np.ndarray):
        """``text`` tells the text of each place; no pair spans two texts."""
        symbols, starts = np.array(sequence, np.int64), np.arange(len(sequence))
        ends, owner = starts + 1, np.asarray(text)
        made, total, again = int(symbols.max(initial=-1)) + 1, 0, True
        #: whether the pair that begins at a place may occur twice; one that doesn't never will
        alive = np.ones(len(symbols), bool)
        rules, places, first, cut, end = ([np.zeros(0, np.int64)] for _ in range(5))
        while len(symbols) > 1:
            if again:
                chosen, rule, new = self._frequent(symbols, owner, alive, made)
                again = len(chosen) > 0
            if not again:  # no pair occurs twice: join what is left of each text
                chosen = self._alternate(owner)
                rule = new = np.arange(len(chosen))
                if not len(chosen):
                    break
            first.append(starts[chosen[new]]), cut.append(ends[chosen[new]]), end.append(ends[chosen[new] + 1])
            rules.append(total + rule), places.append(starts[chosen])
            symbols[chosen] = made + rule
            ends[chosen] = ends[chosen + 1]
            alive[chosen], alive[np.maximum(chosen - 1, 0)] = True, True
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            symbols, starts, ends, owner, alive = symbols[keep], starts[keep], ends[keep], owner[keep], alive[keep]
            made, total = made + len(new), total + len(new)
        self.first, self.cut, self.end = np.concatenate(first), np.concatenate(cut), np.concatenate(end)
        every = np.concatenate(rules)
        order = np.argsort(every, kind="stable")
        self.rules, self.places = every[order], np.concatenate(places)[order]

    @staticmethod
    def _frequent(symbols: np.ndarray, owner: np.ndarray, alive: np.ndarray, made: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of left symbols, rule numbers, index of each rule's first place) of the pairs replaced this round."""
        at = np.flatnonzero(alive[:-1] & (owner[:-1] == owner[1:]))
        key = symbols[at] * made + symbols[at + 1]
        order = np.argsort(key)
        change = np.append(True, key[order[1:]] != key[order[:-1]])[: len(at)]
        number = np.empty(len(at), np.int64)
        number[order] = np.cumsum(change) - 1
        count = np.bincount(number)[number]
        alive[at[count == 1]] = False
        at, number, count = at[count > 1], number[count > 1], count[count > 1]
        # higher is better: frequent first, ties by the pair, so equal stretches are cut alike
        found = count * (int(number.max(initial=0)) + 2) + number + 1
        # of equal neighbours a pair overlaps its own next one: every second counts
        same = np.append(False, (number[1:] == number[:-1]) & (at[1:] == at[:-1] + 1))[: len(at)]
        begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
        found[(np.arange(len(at)) - begin) % 2 == 1] = 0
        score = np.zeros(len(symbols) + 1, np.int64)
        score[at + 1] = found
        best = (found > 0) & (found >= score[at]) & (found > np.append(score, 0)[at + 2])
        chosen, number = at[best], number[best]
        times = np.bincount(number)
        chosen, number = chosen[times[number] > 1], number[times[number] > 1]
        _, new, rule = np.unique(number, return_index=True, return_inverse=True)
        return chosen, rule, new

    @staticmethod
    def _alternate(owner: np.ndarray) -> np.ndarray:
        """Every second place of each text that has a neighbour to the right."""
        change = np.append(True, owner[1:] != owner[:-1])
        begin = np.maximum.accumulate(np.where(change, np.arange(len(owner)), 0))
        odd = (np.arange(len(owner)) - begin) % 2 == 0
        return np.flatnonzero(odd[:-1] & (owner[:-1] == owner[1:]))


def _recur(words: np.ndarray, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether the ``period`` words at each place occur again right after."""
    ok = np.ones(len(at), bool)
    alive, k = np.arange(len(at)), 0
    while len(alive) > 8:  # all pairs at once, word by word
        alive = alive[period[alive] > k]
        same = words[at[alive] + k] == words[at[alive] + k + period[alive]]
        ok[alive[~same]] = False
        alive, k = alive[same], k + 1
    for i in alive.tolist():
        a, p = int(at[i]), int(period[i])
        ok[i] = np.array_equal(words[a : a + p], words[a + p : a + 2 * p])
    return ok


def _reach(words: np.ndarray, at: int, stop: int, period: int, step: int) -> int:
    """How far from ``at`` words equal those ``period`` before (step 1) or after (step -1), up to ``stop``."""
    size = 64
    while at != stop:
        n = min(size, abs(stop - at))
        if step > 0:
            differ = words[at : at + n] != words[at - period : at - period + n]
        else:
            differ = (words[at - n : at] != words[at - n + period : at + period])[::-1]
        k = int(differ.argmax()) if differ.any() else n
        at += step * k
        if k < n:
            break
        size *= 2
    return at


class _Boundaries:
    """The runs that cross the boundaries of a grammar's rules, shorter periods first."""

    def __init__(self, words: np.ndarray, text: np.ndarray, grammar: Grammar):
        self.words, self.text = words, text
        self.first, self.cut, self.end = grammar.first, grammar.cut, grammar.end
        self.size = self.end - self.first
        #: periodic stretches found so far go from the boundary to these places
        self.left, self.right = self.cut.copy(), self.cut.copy()
        self.rows: list[tuple[int, int, int, int]] = []
        self.of_cut = np.full(len(words) + 1, -1)  # every place is the boundary of one rule at most
        enough = np.flatnonzero(self.size >= MIN_WORDS)
        self.of_cut[self.cut[enough]] = enough
        for p in range(1, DIRECT):
            rule = enough[self.size[enough] >= MIN_PERIODS * p]
            for begin in (self.cut[rule] - 2 * p, self.cut[rule]):
                self._try(rule, begin, np.full(len(rule), p))
        self._longer()

    def _try(self, rule: np.ndarray, begin: np.ndarray, period: np.ndarray) -> None:
        """Extend the squares among (begin, period) to stretches and keep the runs."""
        first, end = self.first[rule], self.end[rule]
        ok = (begin >= first) & (begin + 2 * period <= end) & (end - first >= np.maximum(MIN_PERIODS * period, MIN_WORDS))
        rule, begin, period = rule[ok], begin[ok], period[ok]
        ok = _recur(self.words, begin, period)
        for r, a, p in zip(rule[ok].tolist(), begin[ok].tolist(), period[ok].tolist(), strict=True):
            b = _reach(self.words, a + 2 * p, int(self.end[r]), p, 1)
            a = _reach(self.words, a, int(self.first[r]), p, -1)
            self.left[r], self.right[r] = min(a, self.left[r]), max(b, self.right[r])
            if b - a >= max(MIN_PERIODS * p, MIN_WORDS) and a < self.cut[r] < b:
                self.rows.append((r, a, b, p))

    def _longer(self) -> None:
        words, most, span = self.words, int(self.size.max(initial=0)), len(self.words) + 1
        width, known, hashes = DIRECT, 1, words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        places = np.arange(len(words))
        while MIN_PERIODS * width <= most:
            while known < width:  # hashes of twice as many words
                mixed = hashes[:-known] ^ (hashes[:-known] >> np.uint64(29))
                hashes = mixed * np.uint64(0xBF58476D1CE4E5B9) + hashes[known:]
                known *= 2
            places = places[places < len(hashes)]
            if len(places) < 2:
                break
            own = (hashes[places] ^ (hashes[places] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + self.text[places].astype(np.uint64)
            order = np.argsort(own, kind="stable")
            places, own = places[order], own[order]
            same = own[1:] == own[:-1]
            twice = np.append(same, False) | np.append(False, same)
            places, own = places[twice], own[twice]  # words that occur once do not begin a longer repeat either
            if not len(places):
                break
            group = np.cumsum(np.append(True, own[1:] != own[:-1]))
            for forward in (True, False):
                self._recurring(places, group, group * span + places, width, forward)
            places = np.sort(places)
            width *= 2

    def _recurring(self, places: np.ndarray, group: np.ndarray, key: np.ndarray, width: int, forward: bool) -> None:
        """Try the squares that begin (or end) at a boundary, by where its next (or last) words recur.

        Recurrences inside a stretch already found have a multiple of its period and are skipped.
        """
        rule = self.of_cut[places if forward else places + width]
        hit = np.flatnonzero((rule >= 0) & (self.size[rule] >= MIN_PERIODS * width))
        rule = rule[hit]
        span = len(self.words) + 1
        if forward:
            inside = self.right[rule] - width
            other = np.searchsorted(key, group[hit] * span + np.maximum(inside, places[hit]), "right")
        else:
            inside = np.minimum(self.left[rule], places[hit])
            other = np.searchsorted(key, group[hit] * span + inside, "left") - 1
        tried = []
        while len(hit):
            there = (other >= 0) & (other < len(places))
            there[there] = group[other[there]] == group[hit[there]]
            hit, other, rule = hit[there], other[there], rule[there]
            distance = np.abs(places[other] - places[hit])
            near = distance < 2 * width
            hit, other, rule, distance = hit[near], other[near], rule[near], distance[near]
            use = distance >= width
            tried.append((rule[use], distance[use]))
            other = other + (1 if forward else -1)
        if tried:
            rule, period = (np.concatenate(x) for x in zip(*tried, strict=True))
            self._try(rule, self.cut[rule] - (0 if forward else 2 * period), period)


def boundary_runs(words: np.ndarray, text: np.ndarray, grammar: Grammar) -> np.ndarray:
    """Rows (rule, begin, end, period) of the runs inside a rule across its boundary, from the rule's first place."""
    least: dict[tuple[int, int, int], int] = {}
    for rule, a, b, p in _Boundaries(words, text, grammar).rows:
        key = (rule, a - int(grammar.first[rule]), b - int(grammar.first[rule]))
        least[key] = min(p, least.get(key, p))  # a stretch has the multiples of its period too
    return np.array([(*k, p) for k, p in least.items()], np.int64).reshape(-1, 4)


def runs(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Rows (begin, end, period), sorted, of all maximal runs of a sequence of word ids."""
    if len(words) < MIN_WORDS:
        return np.zeros((0, 3), np.int64)
    grammar = Grammar(words, text)
    local = boundary_runs(words, text, grammar)
    low, high = np.searchsorted(grammar.rules, local[:, 0], "left"), np.searchsorted(grammar.rules, local[:, 0], "right")
    times = high - low
    which = np.repeat(np.arange(len(local)), times)
    place = grammar.places[np.repeat(low, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)]
    found = np.stack([place + local[which, 1], place + local[which, 2], local[which, 3]], axis=1)
    # merge: of each period, what lies inside another stretch is a part of it
    found = found[np.lexsort((-found[:, 1], found[:, 0], found[:, 2]))]
    reach = np.maximum.accumulate(found[:, 1] + found[:, 2] * (len(words) + 1)) if len(found) else found[:, 1]
    inside = np.append(False, found[1:, 1] + found[1:, 2] * (len(words) + 1) <= reach[:-1]) if len(found) else np.zeros(0, bool)
    found = found[~inside]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def digest(words: list[bytes], found: np.ndarray) -> tuple:
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of one text."""
    listed = "".join(f"{a},{b - a},{p}\n" for a, b, p in found.tolist())
    if not len(found):
        best, kept = (None,) * 4, words
    else:
        a, b, p = min(found.tolist(), key=lambda r: (r[0] - r[1], r[0], r[2]))
        best = (a, b - a, p, 1000 * (b - a) // p)
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, found[:, 0] + found[:, 2], 1), np.add.at(edge, found[:, 1], -1)
        kept = [w for w, drop in zip(words, np.cumsum(edge)[:-1].tolist(), strict=True) if not drop]
    return len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()


def repeated(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's words: in one of ten texts a stretch is repeated to the end."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n or doc_id is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


_SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Callable[[int | None, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """One row per input row: number and digest of its runs, the longest one, and the digest of the
    text without the repeated words.

    A run is a stretch of words with smallest period q that no neighbouring word
    extends, of at least ``MIN_WORDS`` words and ``MIN_PERIODS`` periods.  Null,
    empty and blank texts have no words and no runs.  Repeated rows give equal
    rows; null ids stay; an empty table gives an empty result; other columns are
    ignored.  A task holds one batch of words (or one longer text) at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int | None] = []
        held: list[list[bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            words = numbered([w for x in held for w in x])
            text = np.repeat(np.arange(len(held)), [len(x) for x in held])
            found = runs(words, text)
            starts = np.cumsum([0, *map(len, held)])
            cuts = np.searchsorted(found[:, 0], starts)
            rows = [digest(x, found[i:j] - [s, s, 0]) for x, s, (i, j) in zip(held, starts.tolist(), pairwise(cuts.tolist()), strict=False)]
            columns = [list(keys), *map(list, zip(*rows, strict=True))]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                keys.append(key), held.append(change(key, words) if change else words)
                size += len(words)
                if size >= BATCH_WORDS:
                    yield flush()
                    keys, held, size = [], [], 0
        if keys:
            yield flush()

    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _SCHEMA)


def op12_query(docs: DataFrame) -> DataFrame:
    return periodic_runs(docs, change=repeated)
