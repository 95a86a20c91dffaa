"""Secret scans through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that
every match must hold: alternatives of conjunctions.  The index lists, for each
trigram of the rule set, the texts that contain it (without case).  A rule's
candidates are the texts in the intersection of the postings of one of its
conjunctions; only they are scanned with the expression itself.  Rules without
mandatory trigrams scan every text.

Texts are named by their 64-bit hash, so copies share postings, and a hash
collision only adds a candidate.  Everything is a DataFrame function; the
derivation of the queries runs on the driver over the rule set alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paracorpus.llm.common import spill

#: Alternatives that a part of an expression may spell out before it counts as open.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java and Python share; matches whose group
    ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The three base kinds, then further well-known token formats.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

# A query is a set of alternatives, each a set of trigrams that must all be there;
# the alternative without trigrams holds for every text.
Query = frozenset[frozenset[str]]
ANYTHING: Query = frozenset([frozenset()])


def _either(a: Query, b: Query) -> Query:
    both = a | b
    return ANYTHING if frozenset() in both else frozenset(x for x in both if not any(y < x for y in both))


def _all(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MAX_STRINGS:  # weaker, still implied
        return min(a, b, key=len)
    return frozenset(x | y for x in a for y in b)


def _of_strings(strings: frozenset[str]) -> Query:
    out: Query = frozenset()
    for s in strings:
        out = _either(out, frozenset([frozenset(s[i : i + 3] for i in range(len(s) - 2))]))
    return out or ANYTHING


def _walk(items) -> tuple[frozenset[str] | None, Query]:
    """(all strings it can match, lower-cased, if few; trigrams of every match) of a sequence."""
    query, run, closed = ANYTHING, frozenset([""]), True
    for op, arg in items:
        strings, needs = _part(op, arg)
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = frozenset(a + b for a, b in product(run, strings))
            continue
        query, closed = _all(_all(query, _of_strings(run)), needs), False
        run = strings if strings is not None else frozenset([""])
    query = _all(query, _of_strings(run))
    return (run if closed else None), query


def _part(op, arg) -> tuple[frozenset[str] | None, Query]:
    if op is sre.LITERAL:
        return frozenset([chr(arg).lower()]), ANYTHING
    if op is sre.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < MAX_STRINGS:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, ANYTHING
        return (frozenset(chars), ANYTHING) if len(chars) <= 8 else (None, ANYTHING)
    if op is sre.SUBPATTERN:
        return _walk(arg[-1])
    if op is sre.BRANCH:
        strings, query = frozenset(), frozenset()
        for branch in arg[1]:
            s, q = _walk(branch)
            query = _either(query, q) if query else q
            strings = None if strings is None or s is None else strings | s
        return strings, query
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, body = arg
        strings, query = _walk(body)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, ANYTHING
        if low == high and strings is not None and len(strings) ** low <= MAX_STRINGS:
            return frozenset("".join(x) for x in product(strings, repeat=low)), ANYTHING
        if not low:
            return None, ANYTHING
        return None, _all(query, _of_strings(strings)) if strings is not None else query
    if op is sre.AT:
        return frozenset([""]), ANYTHING
    return None, ANYTHING


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigram sets, one of which every match of ``pattern`` holds."""
    strings, query = _walk(_parser.parse(pattern))
    return _of_strings(strings) if strings is not None else query


def build_index(texts: DataFrame, grams: list[str]) -> DataFrame:
    """Postings (gram, key) of (key, text) for the given trigrams, without case."""
    low = texts.select("key", F.lower("text").alias("low"))
    present = F.array_compact(F.array(*[F.when(F.col("low").contains(g), F.lit(g)) for g in grams]))
    return low.select("key", F.explode(present).alias("gram")).distinct()


def candidates(spark: SparkSession, index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(key, kinds): texts in the intersection of the postings of a conjunction of each rule."""
    terms = [(k, n, g, len(c)) for k, q in queries.items() for n, c in enumerate(sorted(q, key=sorted)) for g in sorted(c)]
    clauses = spark.createDataFrame(terms, "kind string, clause int, gram string, need int")
    # as many rows as the rule set has trigrams
    matched = (
        index.join(F.broadcast(clauses), "gram")
        .groupBy("key", "kind", "clause")
        .agg(F.count(F.lit(1)).alias("found"), F.first("need").alias("need"))
        .filter("found = need")
    )
    return matched.groupBy("key").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of the leftmost non-overlapping matches: the texts between matches and
    the matches themselves, laid end to end, give the places."""
    gaps = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    steps = F.arrays_zip(gaps.alias("gap"), whole.alias("match"), checked.alias("value"))
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.coalesce(F.char_length(x["match"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        keep = F.char_length(x["value"]) >= max(rule.least, 1)  # null after the last match
        spans = F.when(keep, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.cast("bigint").alias("at"), spans.alias("spans"))

    return F.aggregate(steps, zero, step, lambda acc: acc["spans"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans): per row the array of (start, rank, kind, end) of all rules'
    matches, by start and rule order; code points, end exclusive.

    A null text is empty and has none; repeated rows get equal results; an empty
    table gives an empty result; other columns are ignored.  The work per row is
    linear in its text and, per kind, square in its kept matches only.
    """
    spark = docs.sparkSession
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if frozenset() not in q}
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    if indexed:
        grams = sorted({g for q in indexed.values() for c in q for g in c})
        index = spill(build_index(rows.select("key", "text"), grams), "secret_index")
        found = spill(candidates(spark, index, indexed), "secret_candidates")
        rows = rows.join(found, "key", "left")
    else:
        rows = rows.withColumn("kinds", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    each = []
    for order, rule in enumerate(rules):
        maybe = F.array_contains("kinds", rule.kind) if rule.kind in indexed else F.col("text").rlike(rule.pattern)
        each.append(F.when(maybe, _spans(F.col("text"), rule, order)).otherwise(none))
    return rows.select("doc_id", F.array_sort(F.flatten(F.array(*each))).alias("spans"))


def listing(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every match replaced by ``[kind]``, rule after rule."""
    text = F.col(text_col)
    for rule in rules:
        pattern = rule.pattern
        if rule.group and rule.least > 1:  # only matches that count
            pattern = pattern[: pattern.rindex("+)")] + "{%d,})" % rule.least
        text = F.regexp_replace(text, pattern, f"[{rule.kind}]")
    return docs.withColumn(text_col, text)


def op5_query(docs: DataFrame) -> DataFrame:
    n_base = len(BASE_RULES)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(docs).select(
        "doc_id",
        *[count(r.kind) for r in BASE_RULES],
        F.sha2(listing(F.filter("spans", lambda s: s["rank"] < n_base)).cast("binary"), 256).alias("base_sha256"),
        listing(F.col("spans")).alias("spans"),
    )
