import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from paracorpus.llm import line_quality

from .helpers import WORD, awkward, documents, empty, rows


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def brute(docs, min_documents=line_quality.MIN_DOCUMENTS, percent=line_quality.MAX_REMOVED_PERCENT):
    norm = lambda x: " ".join(x.casefold().split())
    where = defaultdict(set)
    for _, t, h in docs:
        for x in (t or "").split("\n"):
            if WORD.search(x):
                where[h, norm(x)].add(t)

    def common_words(t, h):
        return sum(len(WORD.findall(x)) for x in (t or "").split("\n") if WORD.search(x) and len(where[h, norm(x)]) > min_documents)

    # near copies at 0.8 share more than 8 of 9 words in lines that are common
    copies = {(h, t) for _, t, h in docs if 9 * common_words(t, h) > 8 * len(WORD.findall(t or ""))}
    own = {k: {t for t in held if (k[0], t) not in copies} for k, held in where.items() if len(held) > min_documents}
    where = defaultdict(set, own)
    out = []
    for d, t, h in docs:
        n, *rest = counts(t)
        failed = n < 50 or 100 * rest[-1] > 50 * n
        lost = common_words(t, h)
        out.append((d, n, *rest, failed, not failed and 100 * lost <= percent * n, lost))
    return sorted(out, key=repr)


def corpus():
    line = "subscribe to our newsletter and read the terms of use before you go on " * 3
    docs = []
    for i in range(60):
        own = " ".join(f"w{i}x{j}" for j in range(60 if i % 3 else 20))
        docs.append((i, f"{own}\n{line if i % 2 else line.upper()}\n{line}\n#| tail {i}", f"h{i % 4 and 1}"))
    docs += [(100 + i, docs[1][1], "h1") for i in range(30)]
    docs += [(200, " ".join(["a b c d"] * 40), "h0"), (201, None, "h0"), (202, "x\nx\n \nx", None)]
    return docs


def test_against_brute_force(spark):
    docs = corpus()
    got = line_quality.line_rules(documents(spark, docs), min_documents=5)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"]
    assert sorted(rows(got.select(*cols)), key=repr) == brute(docs, 5)


def test_production_values_against_brute_force(spark):
    docs = templates() + corpus()
    got = line_quality.op4_query(documents(spark, docs))
    assert sorted(rows(got), key=repr) == brute(docs)


def templates():
    """Hosts whose pages are a template around their own words, in growing shares, and near copies."""
    words = lambda key, n: " ".join(f"{key}x{j}" for j in range(n))
    docs = []
    for host, shared in (("t50", 80), ("t67", 107), ("t75", 120), ("t85", 136), ("t95", 152)):
        lines = "\n".join(words(f"{host}{k}", shared // 4) for k in range(4))
        docs += [(len(docs), f"{lines}\n{words(f'{host}own{i}', 160 - shared)}", host) for i in range(40)]
    return docs


def test_pages_of_a_template_lose_it_or_go(spark):
    got = line_quality.line_rules(documents(spark, templates())).groupBy("host", "kept").agg(F.count("*").alias("n"), F.min("removed_words").alias("lost"))
    want = {("+t50", True, 40, 80), ("+t67", True, 40, 104), ("+t75", False, 40, 120), ("+t85", False, 40, 136), ("+t95", True, 40, 0)}
    assert set(rows(got)) == want


def test_counts_on_the_tables(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in line_quality.op4_query(docs).collect():
        assert tuple(r)[1:6] == counts(texts[r["doc_id"]])


def test_frequent_lines_go_and_columns_stay(spark):
    docs = documents(spark, corpus())
    rules = line_quality.line_rules(docs, min_documents=5)
    out = line_quality.without_frequent_lines(docs, rules)
    assert out.columns == docs.columns
    got = out.collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in rules.filter("kept").collect()}
    assert all("newsletter" not in r["text"].lower() and r["n_chars"] == len(r["text"]) for r in got)


def test_copies_of_a_document_do_not_deplete_it(spark):
    text = "\n".join(" ".join(f"l{k}w{j}" for j in range(20)) for k in range(5))
    got = line_quality.line_rules(documents(spark, [(i, text) for i in range(40)]), min_documents=3).collect()
    assert len(got) == 40 and all(r["kept"] for r in got)


def test_awkward_rows(spark):
    got = {r["doc_id"]: r for r in line_quality.op4_query(awkward(spark)).collect()}
    assert got[2]["n_words"] == got[3]["n_words"] == got[4]["n_words"] == 0 and got[2]["base_failed"]
    assert got[5]["n_words"] == 60_000 and got[5]["kept"]
    assert rows(line_quality.op4_query(empty(spark))) == []
    docs = awkward(spark)
    assert line_quality.without_frequent_lines(docs, line_quality.line_rules(docs)).count() == 1


def test_limits_on_small_and_large_hosts(spark):
    """Production values: the same line goes from a host of 10 texts and from one of 2,000."""
    line = "all content of this site is provided as it is and without any warranty"
    own = lambda h, i, n: " ".join(f"{h}{i}x{j}" for j in range(n))
    docs = []
    for h, size, holders in (("small", 10, 7), ("large", 2000, 30), ("few", 2000, 6)):
        docs += [(len(docs) + i, own(h, i, 60) + (f"\n{line}" if i < holders else ""), h) for i in range(size)]
    depleted = "\n".join(" ".join(f"d{k}x{j}" for j in range(30)) for k in range(4))
    docs += [(10_000 + i, f"{depleted}\n{own('d', i, 20 if i < 7 else 100)}", "depleted") for i in range(14)]
    docs += [(20_000 + i, f"{depleted}\n{own('n', i, 12)}", "near copies") for i in range(300)]
    df = documents(spark, docs)
    got = line_quality.line_rules(df)
    lost = {r["host"]: r["n"] for r in got.filter("removed_words > 0").groupBy("host").agg(F.count("*").alias("n")).collect()}
    assert lost == {"+small": 7, "+large": 30, "+depleted": 14}
    assert sorted(r["doc_id"] for r in got.filter("not kept").collect()) == list(range(10_000, 10_007))
    texts = line_quality.without_frequent_lines(df, got).filter(F.col("text").contains(line))
    assert [tuple(r) for r in texts.groupBy("source").count().collect()] == [("few", 6)]
