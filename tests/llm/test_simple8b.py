import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paracorpus.llm import simple8b, tokens

from .helpers import awkward, documents, empty, rows


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 70_000) | st.integers(0, 1), max_size=400), st.integers(1, 9))
def test_ids_round_trip(ids, times):
    a = np.array(ids * times, np.uint64)
    firsts, words, exceptions = simple8b.encode_ids(a)
    assert (simple8b.decode_ids(firsts, words, exceptions, len(a)) == a).all()


def test_words_are_full():
    for bits, count in zip(simple8b.WIDTHS.tolist(), simple8b.COUNTS.tolist(), strict=True):
        a = np.full(simple8b.BLOCK, (1 << bits) - 1, np.uint64)
        assert len(simple8b.encode_ids(a)[1]) == -(-simple8b.BLOCK // count)


TEXTS = [
    "", " ", "a  b", "  x", " a \n b", "a   b  c", "<|endoftext|> a<|endoftext|>", "x\n y\n\n  z ", "it's  we'll don't\t t",
    "\x1c a\x1c b \x85 c", "a\r\n b", "x² y_. ½ Ⅷa __.", "été  a　b", "中文 🙂🙂 ok", "1234567 3.14",
]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_librarys(text):
    path = tokens.tokenizer_path()
    plain = Tokenizer.from_file(path)
    assert np.frombuffer(tokens.encoder(path).encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_strings_of_added_tokens():
    path = tokens.tokenizer_path()
    of = lambda special: np.frombuffer(tokens.encoder(path, special).encode("hi <|endoftext|> there"), "<u4").tolist()
    assert of(False) == [5303, 220, 50256, 612]
    assert 50256 not in of(True) and of(True)[:3] == [5303, 1279, 91]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_the_librarys_for_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    encoder = tokens.encoder(tokens.tokenizer_path())
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


def test_cache_generations(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 3)
    monkeypatch.setattr(tokens, "CALL_PIECES", 2)
    encoder = tokens.WordEncoder(tokens.tokenizer_path())
    for text in ("one two three four five one two three", "two six", "five one three\nseven", "two"):
        assert encoder.encode(text) == encoder._library(text)
        assert len(encoder.pieces.new) <= 3 and len(encoder.pieces.old) <= 3


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=" ab1'.\n\t\x1c\x85\xa0²é\u2028\u3000中", max_size=12), max_size=6))
def test_chunks_of_any_texts(texts):
    encoder = tokens.encoder(tokens.tokenizer_path())
    assert [ids.tobytes() for ids in encoder.encode_all(pa.array(texts, pa.string()))] == [encoder._library(t) for t in texts]


def test_chunks_of_texts(monkeypatch):
    encoder = tokens.WordEncoder(tokens.tokenizer_path())
    texts = pa.array([*TEXTS, None, "a b", "a", "the end"])
    for size in (1, 40, 1 << 20):
        monkeypatch.setattr(tokens, "CHUNK_BYTES", size)
        for text, ids in zip(texts.to_pylist(), encoder.encode_all(texts), strict=True):
            assert ids.tobytes() == encoder._library(text or "")
    assert list(encoder.encode_all(pa.array([], pa.string()))) == []


def brute(docs):
    tok, out, start = Tokenizer.from_file(tokens.tokenizer_path()), [], 0
    for key, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_against_the_library(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(rows(simple8b.op2_query(docs))) == sorted(want)


def test_awkward_rows_and_segments(spark, monkeypatch):
    docs = awkward(spark)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = rows(simple8b.op2_query(docs))
    assert sorted(got, key=lambda r: r[1]) == sorted(want, key=lambda r: r[1])
    assert rows(simple8b.op2_query(empty(spark))) == []
    monkeypatch.setattr(simple8b, "SEGMENT_IDS", 8)
    many = documents(spark, [(i, "word " * (i % 7)) for i in range(60)])
    assert sorted(rows(simple8b.op2_query(many))) == sorted(brute([(r["doc_id"], r["text"]) for r in many.collect()]))


def test_foreign_payload_is_refused():
    with pytest.raises(ValueError):
        simple8b.unpack_segment(b"NOPE" + bytes(40))
