import random

from paracorpus.llm import decontaminate

from .helpers import awkward, documents, empty, rows

ITEM_SCHEMA = "item_id long, text string, label string"


def items(spark, pairs):
    return spark.createDataFrame([(i, t, "x") for i, t in pairs], ITEM_SCHEMA)


def least_edits(passage, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(passage):
        new = [i + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, n):
    p = list(text)
    for _ in range(n):
        k = rng.randrange(len(p))
        p[k : k + rng.choice([0, 1, 1])] = rng.choice(["", "x", "y"])
    return "".join(p)


def test_regions_against_brute_force():
    rng = random.Random(1)
    letters = "abcde fgh"
    passages = [(k, "".join(rng.choice(letters) for _ in range(rng.choice([40, 90, 150]))).strip() + "z") for k in range(6)]
    index = decontaminate.PassageIndex(passages, decontaminate.EDIT_RATE)
    for _ in range(120):
        k = rng.randrange(6)
        noise = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 200))) for _ in range(2)]
        text = decontaminate.normal(noise[0] + edited(rng, index.texts[k], rng.randrange(10)) + noise[1])
        want = {(i, n) for i, t in enumerate(index.texts) if (n := least_edits(t, text)) <= index.edits[i]}
        found = index.search(["other", text])
        assert {(i, n) for t, i, _, _, n in found if t == 1} == want
        for _, i, a, b, n in found:
            assert least_edits(index.texts[i], text[a:b]) == n


def test_passages_of_20_to_23_characters_take_an_edit():
    for length in (20, 21, 22, 23):
        passage = "abcdefghijklmnopqrstuvw"[:length]
        index = decontaminate.PassageIndex([(1, passage)], decontaminate.EDIT_RATE)
        for k in range(length):
            text = f"before {passage[:k]}#{passage[k + 1 :]} after"
            assert [r[4] for r in index.search([text])] == [1]
        assert index.search([f"{passage[:3]}##{passage[5:]}"]) == []


def test_more_pairs_than_32_bits():
    passages = [(i, f"{i:016d}".translate(str.maketrans("0123456789", "abcdefghij")) * 2) for i in range(120_000)]
    index = decontaminate.PassageIndex(passages, decontaminate.EDIT_RATE)
    texts = [f"text {k}" for k in range(22_000)]
    for k in (5, 21_000):
        texts[k] += " " + passages[119_000 + k % 900][1]
    assert {(r[0], r[1]) for r in index.search(texts) if r[4] == 0} == {(k, 119_000 + k % 900) for k in (5, 21_000)}


def test_many_passages_with_one_prompt():
    prompt = "read the question and choose the answer: "
    rng = random.Random(2)
    tail = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(60))
    passages = [(i, prompt + tail()) for i in range(2000)]
    index = decontaminate.PassageIndex(passages, decontaminate.EDIT_RATE)
    texts = [prompt + tail() for _ in range(200)] + [f"xy {passages[k][1]} z" for k in (3, 1999)]
    assert [(r[0], r[1], r[4]) for r in index.search([decontaminate.normal(t) for t in texts])] == [(200, 3, 0), (201, 1999, 0)]


def test_query_on_the_tables(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    bench = spark.read.parquet(f"{sf001}/benchmark.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = {r["item_id"]: r["text"] for r in bench.collect()}
    exact = {(d, i) for d, t in texts.items() for i, p in known.items() if decontaminate.normal(p) in decontaminate.normal(t)}
    got = decontaminate.op8_query(docs, bench).collect()
    assert exact <= {(r["doc_id"], r["item_id"]) for r in got}
    for r in got:
        region = decontaminate.normal(texts[r["doc_id"]][r["start"] : r["end"]])
        assert least_edits(decontaminate.normal(known[r["item_id"]]), region) == r["edits"]


def test_offsets_name_original_characters():
    for text in ("  A  ß c ", "İx\x00y", "a\n\nB", ""):
        places = decontaminate.offsets(text)
        assert len(places) == len(decontaminate.normal(text))


def test_passage_across_case_blanks_and_chunks(spark, monkeypatch):
    passage = "The quick brown fox jumps over the lazy dog near the river bank"
    monkeypatch.setattr(decontaminate, "CHUNK_CHARS", 50)
    docs = documents(spark, [(1, "x " * 90 + passage.upper().replace(" ", "\n ") + " y" * 50), (2, passage[: len(passage) // 2] + " and more"), (3, passage + ". " + passage)])
    got = sorted(rows(decontaminate.contaminations(docs, items(spark, [(7, passage)]))))
    assert [(r[0], r[1], r[4]) for r in got] == [(1, 7, 0), (3, 7, 0), (3, 7, 0)]
    assert got[0][2] == 180


def test_blocks_of_passages_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    known = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(20))) for i in range(12)]
    docs = documents(spark, [(i, f"before {known[i % 12][1]} after") for i in range(30)])
    whole = sorted(rows(decontaminate.contaminations(docs, items(spark, known))))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)
    assert len(whole) == 30 and sorted(rows(decontaminate.contaminations(docs, items(spark, known)))) == whole


def test_awkward_rows(spark):
    docs = awkward(spark)
    bench = items(spark, [(1, "a plain text with some words in it"), (2, None), (3, ""), (4, "  "), (5, "x"), (1, "a plain text with some words in it")])
    got = rows(decontaminate.contaminations(docs, bench))
    assert sorted(r[:2] for r in got if r[1] == 1) == [(1, 1), (1, 1)]
    assert {r[0] for r in got if r[1] == 5} == {1, 6, 7}  # short passages are searched exactly
    assert rows(decontaminate.contaminations(empty(spark), bench)) == []
    assert rows(decontaminate.contaminations(docs, bench.limit(0))) == []
    kept = decontaminate.clean_documents(docs, bench.filter("item_id = 1"))
    assert kept.columns == docs.columns and kept.count() == 7
    mixed = documents(spark, [(None, "a plain text with some words in it"), (None, "clean"), (1, "clean too"), (1, "say: a plain text with some words in it")])
    assert sorted(r["text"] for r in decontaminate.clean_documents(mixed, bench.filter("item_id = 1")).collect()) == ["clean", "clean too"]
