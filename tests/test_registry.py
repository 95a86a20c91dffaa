"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402


#: A greedy search, which SQL can't express: tests/test_metrics.py holds it against a brute force.
WITHOUT_ORACLE = {"shift_edit_rate"}


def test_every_query_has_an_oracle_or_a_reason():
    missing = set(E.queries()) - set(E.oracle_sql()) - set(E.LLM_QUERIES)
    assert missing == WITHOUT_ORACLE


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and {"split", "english", "darija_Arab", "darija_tokens"} <= set(df.columns)


def test_queries_match_oracles(spark, sf001):
    from check_oracle import run_checks

    problems = run_checks(spark, sf001, log=lambda _: None)
    assert problems == []
