"""Registered queries of this subpackage: name -> callable, name -> oracle SQL."""

from __future__ import annotations

import corpus_pipeline
from paracorpus.llm import (
    chat_tree,
    decontaminate,
    hilbert,
    html_layout,
    licenses,
    line_quality,
    mixing,
    near_dup,
    periodic,
    secret_scan,
    simple8b,
    spelling,
    suffix_family,
)
from paracorpus.llm.common import table
from paracorpus.session import ensure_checkpoint_dir

QUERIES = {}
ORACLES = {}


def _query(name, fn, *tables, sql=None):
    def run(spark, sf_dir):
        ensure_checkpoint_dir(spark)
        return fn(*[table(spark, sf_dir, t) for t in tables])

    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = sql


_query("op1_hilbert_shards", hilbert.op1_query, "documents")
_query("op2_simple8b_tokens", simple8b.op2_query, "documents")
_query("op3_html_layout", html_layout.op3_query, "pages")
_query("op4_line_quality", line_quality.op4_query, "documents")
_query("op5_trigram_secrets", secret_scan.op5_query, "documents")
_query("op6_license_families", licenses.op6_query, "documents")
_query("op7_odd_sketch_dedup", near_dup.op7_query, "documents")
_query("op8_qgram_leaks", decontaminate.op8_query, "documents", "benchmark")
_query("op9_chat_tree", chat_tree.op9_query, "conversations")
_query("op10_entropy_mix", mixing.op10_query, "documents")
_query("op11_partenum_spelling", spelling.op11_query, "documents")
_query("op12_grammar_runs", periodic.op12_query, "documents")
_query("op13_suffix_family", suffix_family.op13_query, "documents")


def _pipeline(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = _pipeline
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
