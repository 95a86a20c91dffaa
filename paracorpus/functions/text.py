"""Scalar text expressions: all JVM-side Column builders.

Python's ``str.strip``/``split`` and ``re`` classes are Unicode-wide, while
Spark's ``trim`` removes spaces only and Java's ``\\s``/``\\b`` are ASCII by
default.  Every helper below spells its character classes out so that the
Spark expression and the DuckDB oracle (RE2) agree with Python on the same
input.  The same pattern strings are reused verbatim by the oracle SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.isspace() accepts (what strip()/split() remove).
WS_CLASS = (
    r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# Python's \w for str patterns: letters, numbers, underscore.
WORD_CLASS = r"[\p{L}\p{N}_]"
NON_WORD_CLASS = r"[^\p{L}\p{N}_]"

STRIP_PATTERN = rf"^{WS_CLASS}+|{WS_CLASS}+$"

# Fixed value: Python's string.punctuation (ASCII punctuation), in its order.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Unknown-token cleanup, applied in this order (literal replace).
UNK_REPLACEMENTS = [(" <unk>", "-"), ("<unk>", "")]

# Chat markers removed by the causal-LM text cleaner, in order.
SPECIAL_MARKERS = ["<|im_end|>", "<|assistant|>", "<|user|>", "<|system|>"]
ASSISTANT_MARKER = "<|assistant|>"

# The code detector's ten patterns, joined with "|" and matched
# case-insensitively with search (not full-match) semantics.
CODE_PATTERNS = [
    r"\bdef\b|\bclass\b|\bimport\b|\bfrom\b",
    r"\bfor\b|\bwhile\b|\bif\b|\belse\b",
    r"[{};<>]",
    r"#include\s*<.*?>",
    r"system\(.+\)|printf\(.+\)|cout\s*<<",
    r"console\.log\(.+\)|function\s*\w*\s*\(",
    r"public|private|static|void|int|string",
    r"\<\w+\>.*\<\/\w+\>",
    r"\bSELECT\b|\bINSERT\b|\bUPDATE\b",
    r"\=.*\;",
]


# Python's re.IGNORECASE also matches these non-ASCII letters to ASCII pattern
# letters (simple case folding); they are folded before lower-casing.
CASE_FOLD_FROM, CASE_FOLD_TO = "\u0130\u0131\u017f\u212a", "iisk"


def _regex_for(pattern: str, engine: str) -> str:
    """Python-only shorthands rewritten into classes Java and RE2 share.

    Matching runs on lower-cased text, so the pattern is lower-cased first
    (its escapes hold no letters that change meaning).  ``\\b`` becomes a
    lookaround pair in Java and a consuming edge group in RE2 (which has no
    lookaround); for search-only matching the two answer the same.  ``\\w``
    and ``\\s`` become the Unicode classes above; needless escapes of
    ``< > / = ;`` (which RE2 rejects) become plain characters.
    """
    pattern = pattern.lower()
    if engine == "java":
        edge = lambda m: rf"(?<!{WORD_CLASS}){m.group(1)}(?!{WORD_CLASS})"
    else:
        edge = lambda m: rf"(?:\A|{NON_WORD_CLASS}){m.group(1)}(?:{NON_WORD_CLASS}|\z)"
    out = re.sub(r"\\b(\w+)\\b", edge, pattern)
    out = out.replace(r"\w", WORD_CLASS).replace(r"\s", WS_CLASS)
    for ch in "<>/=;":
        out = out.replace("\\" + ch, ch)
    return out


# Java: d = only \n ends a line for "."; one search over the folded text.
CODE_REGEX_SPARK = "(?d)" + "|".join(_regex_for(p, "java") for p in CODE_PATTERNS)
CODE_REGEX_RE2 = "|".join(_regex_for(p, "re2") for p in CODE_PATTERNS)


def case_folded(c: Column) -> Column:
    return F.lower(F.translate(c, CASE_FOLD_FROM, CASE_FOLD_TO))


def ustrip(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(c, STRIP_PATTERN, "")


def is_blank(c: Column) -> Column:
    """``text.strip() == ""`` (null stays null)."""
    return ustrip(c) == F.lit("")


def collapse_ws(c: Column) -> Column:
    """``re.sub(r"\\s+", " ", text)``."""
    return F.regexp_replace(c, f"{WS_CLASS}+", " ")


def clean_unk(c: Column) -> Column:
    """T1: ' <unk>' -> '-', then '<unk>' -> '' (literal, in this order)."""
    out = c
    for src, dst in UNK_REPLACEMENTS:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def strip_punct(c: Column) -> Column:
    """Delete ASCII punctuation, then strip."""
    return ustrip(F.translate(c, ASCII_PUNCTUATION, ""))


def extract_assistant(c: Column) -> Column:
    """T5: text after the last assistant marker, whole text when absent."""
    return F.substring_index(c, ASSISTANT_MARKER, -1)


def clean_markers(c: Column) -> Column:
    """Drop the four chat markers, collapse whitespace, strip."""
    out = c
    for m in SPECIAL_MARKERS:
        out = F.replace(out, F.lit(m), F.lit(""))
    return ustrip(collapse_ws(out))


def stringify(c: Column) -> Column:
    """``str(x)`` of a possibly-null value: null renders as 'None'."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def contains_code(c: Column) -> Column:
    """code detector: any of the patterns found, case-insensitively
    (text case-folded once, then one case-sensitive search, which Java runs
    far faster than Unicode case-insensitive matching); null gives null."""
    return case_folded(c).rlike(CODE_REGEX_SPARK)


def split_ws(c: Column) -> Column:
    """Python ``text.split()``: whitespace tokens, no empty strings."""
    return F.filter(F.split(ustrip(c), f"{WS_CLASS}+"), lambda t: t != F.lit(""))


def sql_str(s: str) -> str:
    """Quote a Python string as a SQL literal (standard SQL, no escapes)."""
    return "'" + s.replace("'", "''") + "'"
