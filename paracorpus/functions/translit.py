"""Arabic-script Darija to Latin script, as one native expression.

Rule: each mapped character is replaced by its Latin value; a character
followed by shadda is emitted twice (its mapped value twice) when it is
mapped, and once, unchanged, when it is not; the pair is consumed left to
right.  Unmapped characters are kept.

Native form: (1) every "char + shadda" pair, scanned left to right, gets its
shadda swapped for a private marker; (2) a mapped char before the marker is
doubled; (3) leftover markers are dropped; (4) multi-letter values are
replaced; (5) one ``translate`` handles the one-to-one and deleting values.
This is safe because no Latin output character is itself a key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHADDA = "ّ"
MARK = "\ue000"  # private-use marker, never produced by the map

# The transliteration map (Arabic character -> Latin), in the
# reference's order: letters, harakat, Darija letters, digits, punctuation.
AR_TO_LATIN = {
    "ا": "a", "أ": "a", "إ": "i", "آ": "a", "ب": "b", "ت": "t", "ث": "t",
    "ج": "j", "ح": "7", "خ": "kh", "د": "d", "ذ": "d", "ر": "r", "ز": "z",
    "س": "ss", "ش": "ch", "ص": "s", "ض": "d", "ط": "t", "ظ": "d", "ع": "3",
    "غ": "gh", "ف": "f", "ق": "9", "ك": "k", "ل": "l", "م": "m", "ن": "n",
    "ه": "h", "و": "w", "ي": "i", "ى": "a", "ة": "a",
    "َ": "a", "ُ": "u", "ِ": "i", "ّ": "", "ْ": "",
    "ً": "an", "ٌ": "un", "ٍ": "in",
    "ڭ": "g", "ڤ": "v", "پ": "p", "چ": "g", "ژ": "j",
    "٠": "0", "١": "1", "٢": "2", "٣": "3", "٤": "4",
    "٥": "5", "٦": "6", "٧": "7", "٨": "8", "٩": "9",
    "؟": "?", "،": ",", "؛": ";",
}

MAPPED_CLASS = "[" + "".join(AR_TO_LATIN) + "]"
MULTI = [(k, v) for k, v in AR_TO_LATIN.items() if len(v) > 1]
_single = [(k, v) for k, v in AR_TO_LATIN.items() if len(v) == 1]
_empty = [k for k, v in AR_TO_LATIN.items() if v == ""]
TR_FROM = "".join(k for k, _ in _single) + "".join(_empty)
TR_TO = "".join(v for _, v in _single)

PAIR_PATTERN = f"(?s)(.){SHADDA}"
DOUBLE_PATTERN = f"({MAPPED_CLASS}){MARK}"


def transliterate(c: Column) -> Column:
    out = F.regexp_replace(c, PAIR_PATTERN, "$1" + MARK)
    out = F.regexp_replace(out, DOUBLE_PATTERN, "$1$1")
    out = F.replace(out, F.lit(MARK), F.lit(""))
    for k, v in MULTI:
        out = F.replace(out, F.lit(k), F.lit(v))
    return F.translate(out, TR_FROM, TR_TO)


def transliterate_sql(expr: str) -> str:
    """The same rule as DuckDB SQL (oracle side)."""
    out = f"regexp_replace({expr}, '{PAIR_PATTERN}', '\\1{MARK}', 'g')"
    out = f"regexp_replace({out}, '{DOUBLE_PATTERN}', '\\1\\1', 'g')"
    out = f"replace({out}, '{MARK}', '')"
    for k, v in MULTI:
        out = f"replace({out}, '{k}', '{v}')"
    return f"translate({out}, '{TR_FROM}', '{TR_TO}')"
