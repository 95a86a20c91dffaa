"""Scalar text rules: FIXTURES.md section 3 cases and brute-force checks."""

import random
import re

import pytest
from pyspark.sql import functions as F

from paracorpus.functions import text as tx
from paracorpus.functions.translit import AR_TO_LATIN, SHADDA, transliterate


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "s string")
    return df.select(expr(F.col("s")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "src,expected",
    [("a <unk> b", "a- b"), ("<unk>a", "a"), ("a <unk><unk>", "a-"), (None, None)],
)
def test_clean_unk(spark, src, expected):
    assert one(spark, src, tx.clean_unk) == expected


def test_strip_punct_ascii_only(spark):
    assert one(spark, " «a,b.c»! ", tx.strip_punct) == "«abc»"


def test_extract_assistant(spark):
    assert one(spark, "x<|assistant|> y", tx.extract_assistant) == " y"
    assert one(spark, "x", tx.extract_assistant) == "x"


def test_clean_markers(spark):
    assert one(spark, "<|user|> a \n\t b<|im_end|>", tx.clean_markers) == "a b"


@pytest.mark.parametrize("src,expected", [("point", True), ("SELECT 1", True), ("مرحبا", False), ("x = 1;", True),
                                          ("élif", False), ("if x", True), ("İF y", True)])
def test_code_detector(spark, src, expected):
    assert one(spark, src, tx.contains_code) is expected


def test_code_detector_matches_python_re(spark):
    combined = re.compile("|".join(tx.CODE_PATTERNS), re.IGNORECASE)
    rng = random.Random(7)
    alphabet = list("abcdefIFxyz =;{}<>()#.éàُّ\n") + ["def ", "if", " from ", "SELECT", "<p>", "</p>", "print"]
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r["o"] for r in df.select(tx.contains_code(F.col("s")).alias("o")).collect()]
    want = [bool(combined.search(s)) for s in samples]
    assert got == want


def test_strip_matches_python(spark):
    samples = ["  a b ", "　x ", "\x1cq\x1f", "", "   ", "a​b "]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r["o"] for r in df.select(tx.ustrip(F.col("s")).alias("o")).collect()]
    assert got == [s.strip() for s in samples]


def test_split_ws_matches_python(spark):
    samples = [" a  b\tc\n", "", " x y ", "one"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [list(r["o"]) for r in df.select(tx.split_ws(F.col("s")).alias("o")).collect()]
    assert got == [s.split() for s in samples]


def test_stringify(spark):
    assert one(spark, None, tx.stringify) == "None"


TRANSLIT_CASES = [
    ("مرحبا", "mr7ba"), ("كيف حالك؟", "kif 7alk?"), ("شكرا", "chkra"), ("واش بغيتي شي حاجة؟", "wach bghiti chi 7aja?"),
    ("قهوة", "9hwa"), ("الحمد لله", "al7md llh"), ("شنو هاد الشي؟", "chnw had alchi?"), ("زوين بزّاف", "zwin bzzaf"),
    ("القسم 5 و القسم 6", "al9ssm 5 w al9ssm 6"), ("", ""), (None, None), ("a" + SHADDA, "a"),
]


@pytest.mark.parametrize("src,expected", TRANSLIT_CASES)
def test_transliterate_examples(spark, src, expected):
    assert one(spark, src, transliterate) == expected


def _translit_reference(text):
    """Independent restatement: regex pairs (char + shadda), then a map."""
    def pair(m):
        ch = m.group(1)
        return AR_TO_LATIN[ch] * 2 if ch in AR_TO_LATIN else ch
    parts = re.split(r"((?s:.)" + SHADDA + ")", text)
    out = []
    for i, p in enumerate(parts):
        if i % 2:
            out.append(pair(re.match(r"(?s)(.)" + SHADDA, p)))
        else:
            out.append("".join(AR_TO_LATIN.get(c, c) for c in p))
    return "".join(out)


def test_transliterate_random_strings(spark):
    rng = random.Random(3)
    keys = list(AR_TO_LATIN) + [SHADDA] * 6 + list("ab 1?é")
    samples = ["".join(rng.choice(keys) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r["o"] for r in df.select(transliterate(F.col("s")).alias("o")).collect()]
    assert got == [_translit_reference(s) for s in samples]
