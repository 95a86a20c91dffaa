"""DuckDB spellings of the library's text rules, for oracle SQL only.

Each helper mirrors a Spark expression in ``paracorpus.functions`` with the
same pattern strings, so a mismatch points at the operator, not at a dialect.
"""

from __future__ import annotations

from paracorpus.fixtures import NOT_WS
from paracorpus.functions.text import (
    ASCII_PUNCTUATION,
    CASE_FOLD_FROM,
    CASE_FOLD_TO,
    CODE_REGEX_RE2,
    SPECIAL_MARKERS,
    STRIP_PATTERN,
    WS_CLASS,
    sql_str,
)


def ustrip(e: str) -> str:
    return f"regexp_replace({e}, '{STRIP_PATTERN}', '', 'g')"


def is_blank(e: str) -> str:
    return f"({ustrip(e)} = '')"


def tokens(e: str) -> str:
    return f"regexp_extract_all({e}, '{NOT_WS}+')"


def word_count(e: str) -> str:
    return f"len({tokens(e)})"


def token_count(e: str, n_special: int = 2) -> str:
    return f"({word_count(e)} + {n_special})"


def contains_code(e: str) -> str:
    return f"regexp_matches(lower(translate({e}, '{CASE_FOLD_FROM}', '{CASE_FOLD_TO}')), '{CODE_REGEX_RE2}')"


def strip_punct(e: str) -> str:
    return ustrip(f"translate({e}, {sql_str(ASCII_PUNCTUATION)}, '')")


def clean_unk(e: str) -> str:
    return f"replace(replace({e}, ' <unk>', '-'), '<unk>', '')"


def clean_markers(e: str) -> str:
    out = e
    for m in SPECIAL_MARKERS:
        out = f"replace({out}, '{m}', '')"
    return ustrip(f"regexp_replace({out}, '{WS_CLASS}+', ' ', 'g')")


def extract_assistant(e: str) -> str:
    # text after the last marker, or the whole text when absent
    return f"(string_split({e}, '<|assistant|>'))[-1]"


def render_message(role: str, content: str, eos: str = "</s>") -> str:
    return (
        f"CASE WHEN {role} IN ('user', 'system', 'assistant') "
        f"THEN '<|' || {role} || '|>' || chr(10) || {content} || '{eos}' || chr(10) ELSE '' END"
    )
