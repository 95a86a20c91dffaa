"""Whole-text token ids through the tokenizers library, with a bounded cache of pieces.

The byte-level BPE tokenizers cut a text into words (pre-tokens) by a fixed
pattern and encode each word alone.  A space that follows no blank always begins
a word, so a text may be cut there: its ids are those of its pieces one after the
other, each with its space.  Corpora repeat their pieces, so most come from a
per-process cache; the library encodes the new ones, many in one call.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from paracorpus.llm.common import WORKER_CACHES

#: Cached pieces per generation and Python worker; two generations are kept.
MAX_PIECES = 600_000
#: Bytes of text that are encoded together; each distinct piece in them is looked up once.
CHUNK_BYTES = 8 << 20
#: New pieces that the library encodes in one call.
CALL_PIECES = 20_000
#: The space of a byte-level vocabulary.
SPACE = "Ġ"
#: A space that follows no blank.  Python's blanks include all of the tokenizer's.
_CUT = re.compile(r"(?<=\S) ")


class _Pieces:
    """Ids of pieces; once full, the entries become the old generation."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def find(self, keys: list[str]) -> list[bytes | None]:
        found = list(map(self.new.get, keys))
        if self.old:
            again = [(k, v) for k, f in enumerate(found) if f is None and (v := self.old.get(keys[k])) is not None]
            for k, v in again:
                found[k] = v
            self.put([keys[k] for k, _ in again], [v for _, v in again])
        return found

    def put(self, keys: list[str], values: list[bytes]) -> None:
        begin = 0
        while begin < len(keys):
            if len(self.new) >= self.limit:
                self.old, self.new = self.new, {}
            end = begin + self.limit - len(self.new)
            self.new.update(zip(keys[begin:end], values[begin:end], strict=True))
            begin = end


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    Strings of added tokens in a text get these tokens' ids, as the library does
    it; ``special_as_text`` makes them ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [] if special_as_text else [x.content for x in added if x.content]
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self.pieces = _Pieces(MAX_PIECES)

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces with a space before each, which the library gets as one text.
        If no piece has a space of its own, the tokens that begin with one tell where pieces begin."""
        text = " " + " ".join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.begins[ids])
        if len(cuts) != len(pieces) or cuts[0]:
            return [self._library(" " + p) for p in pieces]
        raw, cuts = ids.tobytes(), [*(cuts * 4).tolist(), 4 * len(ids)]
        return [raw[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]

    def known(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces that hold no space and don't end with a blank."""
        found = self.pieces.find(pieces)
        missing = [k for k, v in enumerate(found) if v is None]
        for i in range(0, len(missing), CALL_PIECES):
            places = missing[i : i + CALL_PIECES]
            some = [pieces[k] for k in places]
            ids = self._new(some)
            self.pieces.put(some, ids)
            for k, v in zip(places, ids, strict=True):
                found[k] = v
        return found

    def encode(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            return self._library(text)
        first, *rest = _CUT.split(text)
        plain = list(dict.fromkeys(p for p in rest if p and " " not in p and not p[-1].isspace()))
        of = dict(zip(plain, self.known(plain), strict=True))
        return b"".join([self._library(first), *[of[p] if p in of else self._library(" " + p) for p in rest]])

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of every text of a string array, null as empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        sizes = np.cumsum(pc.binary_length(texts).to_numpy())
        begin = 0
        while begin < len(texts):
            base = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, base + CHUNK_BYTES, side="right")))
            yield from self._encode_chunk(texts.slice(begin, end - begin))
            begin = end

    def _encode_chunk(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Texts that hold an added token, or a run of blanks with a space in it, go one by one."""
        split = pc.split_pattern(texts, " ")
        begins = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = pc.dictionary_encode(split.flatten())
        index, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        starts = begins[:-1]
        plain = pc.and_(pc.not_equal(distinct, ""), pc.equal(pc.utf8_rtrim_whitespace(distinct), distinct))
        plain = plain.to_numpy(zero_copy_only=False)
        unsure = ~plain[index]
        unsure[begins[1:] - 1] &= begins[1:] - 1 > starts  # a text of one piece
        unsure[starts] &= pc.not_equal(distinct.take(pa.array(index[starts])), "").to_numpy(zero_copy_only=False)
        bad = np.logical_or.reduceat(unsure, starts)
        for x in self.special:
            bad |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        rest = np.repeat(~bad, np.diff(begins))
        rest[starts] = False
        used = np.zeros(len(distinct), bool)
        used[index[rest]] = True  # the first piece of a text follows no space
        places = np.flatnonzero(used)
        known = self.known(distinct.take(pa.array(places)).to_pylist())
        at = np.full(len(distinct), len(known))
        at[places] = np.arange(len(places))
        index[~rest] = 0
        where = np.where(rest, at[index], len(known))
        heads = split.flatten().take(pa.array(starts)).to_pylist()
        whole = iter(texts.filter(pa.array(bad)).to_pylist())
        known.append(b"")  # the other pieces of a text that is encoded whole
        where[starts] = len(known) + np.arange(len(starts))
        known += [self.encode(next(whole)) if b else self._library(h) for b, h in zip(bad.tolist(), heads, strict=True)]
        length = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first = np.cumsum(length) - length
        pool = np.frombuffer(b"".join(known), "<u4")
        n = length[where]
        ends = np.cumsum(n)
        step = np.int32 if max(int(ends[-1]), len(pool)) < 1 << 31 else np.int64
        place = np.repeat((first[where] - (ends - n)).astype(step), n)
        place += np.arange(len(place), dtype=step)
        yield from np.split(pool.take(place), (ends - n)[starts[1:]])


def encoder(path: str, special_as_text: bool = False) -> WordEncoder:
    """The process's encoder for the tokenizer file ``path``."""
    held = WORKER_CACHES.setdefault("encoders", {})
    if (path, special_as_text) not in held:
        held[path, special_as_text] = WordEncoder(path, special_as_text)
    return held[path, special_as_text]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer file, looked up where the code runs."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
