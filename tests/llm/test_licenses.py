import pytest

from paracorpus.llm import licenses

from .helpers import awkward, empty, rows

#: The licence lines of the tables and their families.
LINES = {
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "All rights reserved.": "Proprietary",
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(spark, docs):
    return licenses.fit(licenses.sample_lines(docs, "text", licenses.SAMPLE_LINES))


def test_documents_against_their_lines(spark, docs, model):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in licenses.scan(docs, model=model).collect():
        text = texts[r["doc_id"]]
        want = sorted(f for line, f in LINES.items() for _ in range(text.count(line)))
        assert sorted(s["family"] for s in r["licenses"]) == want, text[-300:]
        for s in r["licenses"]:
            assert text[s["start"] : s["end"]].split()[0] in ("Licensed", "This", "Released", "All")


def test_held_out_accuracy(docs, model):
    """Rows made with another seed, from lines that were not sampled for the fit."""
    lines = [x for r in docs.orderBy("doc_id").collect() for x in r["text"].split("\n") if 30 < len(x) < 2000][-800:]
    rows_, labels = licenses.training_rows(lines, seed=77)
    right = alarms = known = unknown = 0
    for w, y in zip(rows_, labels, strict=True):
        found = licenses.find(model, " ".join(w))[1]
        if y == licenses.UNKNOWN:
            unknown += 1
            alarms += bool(found) and not any(licenses.matched(w, f) >= licenses.CONFIRMED for f in range(licenses.UNKNOWN))
        else:
            known += 1
            right += any(s[2] == licenses.FAMILIES[y] for s in found)
    assert alarms <= 0.01 * unknown
    assert right >= 0.8 * known, right / known


def test_notices_in_context(model):
    for family in licenses.FAMILIES:
        for notice in licenses.NOTICES[family]:
            found = licenses.find(model, f"Ordinary prose comes first here.\n{notice}\nand more text follows it")[1]
            assert [s[2] for s in found] == [family], notice


def test_unknown_text_stays_unknown(model):
    text = "the license plate was renewed under the version of the law\nAll rights to the city\nreleased under the bridge\nthe to to"
    assert licenses.find(model, text) == (4, [])


def test_notice_inside_a_long_paragraph(model):
    text = "word " * 300 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction " + "word " * 300
    assert [s[2] for s in licenses.find(model, text)[1]] == ["MIT"]


def test_awkward_rows(spark, model):
    got = {r["doc_id"]: r for r in licenses.scan(awkward(spark), model=model).collect()}
    assert [got[k]["n_paragraphs"] for k in (2, 3, 4, 5)] == [0, 0, 0, 1] and all(not r["licenses"] for r in got.values())
    assert rows(licenses.op6_query(empty(spark))) == []


#: Forms that are not among the notices, word for word.
UNSEEN = {
    "The MIT License": "MIT", "This project is licensed under the terms of the MIT license.": "MIT", "It is released under the MIT License": "MIT",
    "THE MIT LICENSE (MIT)": "MIT", "GNU General Public License version 3, 29 June 2007": "GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\tVersion 2, June 1991": "GPL-2.0",
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies": "ISC",
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)": "BSL-1.0", "licensed under the Apache License, version 2.0": "Apache-2.0",
    "The code is licensed under the BSD 2-Clause License": "BSD", "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.": "BSD",
    "GNU Lesser General Public License, version 2.1, February 1999": "LGPL", "Mozilla Public License, version 2.0": "MPL-2.0",
}


def test_recall_on_forms_that_were_not_trained_on(model):
    found = {text: [s[2] for s in licenses.find(model, f"some words first\n{text}\nand after")[1]] for text in UNSEEN}
    missed = {t: f for t, f in found.items() if f != [UNSEEN[t]]}
    assert len(missed) <= 2, missed


def test_sample_is_distinct_and_the_first_by_hash(spark):
    df = spark.createDataFrame([(i, "\n".join(["a common line"] * 50 + [f"line number {i}", f"line number {i // 2}"])) for i in range(300)], "doc_id long, text string")
    got = licenses.sample_lines(df, "text", 20)
    assert len(got) == len(set(got)) == 20 and licenses.sample_lines(df.repartition(7), "text", 20) == got
    assert len(licenses.sample_lines(df, "text", 1000)) == 301


def test_each_notice_inside_a_long_line(model):
    """In one line of 100 other words, at its ends and between; places are the notice's own."""
    around = [f"plain{i} words{i}" for i in range(50)]
    for at in (0, 25, 50):
        for family in licenses.FAMILIES:
            for notice in licenses.NOTICES[family]:
                text = " ".join([*around[:at], notice, *around[at:]])
                found = licenses.find(model, text)[1]
                assert [s[2] for s in found] == [family], (notice, at)
                assert licenses.words_of(text[found[0][0] : found[0][1]]) == licenses.words_of(notice)


def test_sentences_around_short_notices(model):
    text = (
        "This project was written by the members of the team for the users of the library and is licensed under the MIT license. See the docs "
        "for the terms of use of the service. " + "More words follow here and there. " * 12 + "Copyright of the authors. All rights reserved."
    )
    assert [s[2] for s in licenses.find(model, text)[1]] == ["MIT", "Proprietary"]
