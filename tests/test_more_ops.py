"""The service slot, the phrase table and the mergeable statistics."""

import asyncio
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from paracorpus.operators import chat, phrases, service, sketches
from paracorpus.operators.service import Service
from paracorpus.operators.template import TemplateError, compile_template


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_a_slow_service_runs_at_the_given_concurrency(spark):
    async def slow(text, target):
        await asyncio.sleep(0.1)
        return f"{target}:{text}"

    df = spark.createDataFrame([(i, f"t{i}", "fr" if i % 2 else "de") for i in range(200)], "row_id long, english string, lang string").coalesce(1)
    call = lambda n: service.call_service(df, "row_id", "english", Service("m", slow, in_flight=n), target_col="lang")
    call(200).collect()  # workers are up
    began = time.time()
    got = rows(call(50))
    took = time.time() - began
    assert [r[:2] for r in got] == [(i, "fr" if i % 2 else "de") for i in range(200)]  # order is kept
    assert all(r[3] == f"{r[1]}:t{r[0]}" and r[4] == "ok" and r[6] == 1 for r in got)
    assert 0.4 <= took < 5  # four rounds of 0.1 s; one by one it is 20 s


def test_the_bound_and_the_retries():
    live, most, calls = 0, 0, {}

    async def flaky(text, target):
        nonlocal live, most
        live += 1
        most = max(most, live)
        await asyncio.sleep(0.002)
        live -= 1
        calls[text] = calls.get(text, 0) + 1
        if text == "never" or calls[text] < int(text[-1] if text[-1].isdigit() else 1):
            raise OSError("down")
        return text.upper()

    s = Service("m", flaky, in_flight=3, tries=3, pause=0.001)
    got = asyncio.run(service._answers(s, service._Pace(None), ["a1", "b2", "c3", "d4", "never", *["x1"] * 20], ["t"] * 25))
    assert got[:5] == [("A1", "ok", None, 1), ("B2", "ok", None, 2), ("C3", "ok", None, 3), (None, "error", "OSError: down", 3), (None, "error", "OSError: down", 3)]
    assert most == 3


def test_the_rate_budget():
    async def at_once(text, target):
        return text

    began = time.time()
    asyncio.run(service._answers(Service("m", at_once), service._Pace(100), ["x"] * 41, ["t"] * 41))
    assert 0.4 <= time.time() - began < 2


def test_a_call_that_hangs_and_null_texts(spark):
    async def hangs(text, target):
        await asyncio.sleep(60 if text == "hang" else 0)
        return f"[{text}]"

    df = spark.createDataFrame([(1, "hang"), (2, None), (3, "x")], "row_id long, english string")
    got = {r[0]: r[2:5] for r in rows(service.call_service(df, "row_id", "english", Service("m", hangs, tries=2, pause=0.01, timeout=0.05, rate=500.0)))}
    assert got[1][1] == "error" and got[1][2].startswith("TimeoutError") and got[2] == ("[]", "ok", None) and got[3] == ("[x]", "ok", None)
    assert rows(service.call_service(df.limit(0), "row_id", "english", Service("m", hangs))) == []


def greedy(words, table):
    out, k = [], 0
    while k < len(words):
        n = max((m for m in range(1, len(words) - k + 1) if tuple(words[k : k + m]) in table), default=0)
        out.append(table[tuple(words[k : k + n])] if n else words[k])
        k += max(n, 1)
    return " ".join(out)


def test_phrases_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("abcd")
    table = {tuple(word() for _ in range(rng.randint(1, 4))): f"<{k}>" for k in range(14)}
    texts = [(i, " ".join(word() for _ in range(rng.randint(0, 30)))) for i in range(120)] + [(200, None), (201, "  "), (202, "zz  a\tb\nzz")]
    lexicon = spark.createDataFrame([(" ".join(k), v) for k, v in table.items()] + [(None, "x"), (" ", "y")], "phrase string, out string")
    got = dict(rows(phrases.phrase_translate(spark.createDataFrame(texts, "row_id long, english string"), "row_id", "english", lexicon)))
    assert got == {i: greedy((t or "").split(), table) for i, t in texts}
    none = phrases.phrase_translate(spark.createDataFrame(texts, "row_id long, english string"), "row_id", "english", lexicon.limit(0))
    assert dict(rows(none))[202] == "zz a b zz"


def test_phrases_beat_words(spark):
    lexicon = spark.createDataFrame([("new", "N"), ("new york", "NY"), ("new york city hall", "NYCH"), ("york", "Y")], "phrase string, out string")
    df = spark.createDataFrame([(1, "new york city new york city hall york new")], "row_id long, english string")
    assert rows(phrases.phrase_translate(df, "row_id", "english", lexicon)) == [(1, "NY city NYCH Y N")]


def test_sketches_merge_to_the_whole(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.integers(0, 50, 3000), rng.integers(0, 100_000, 5000), [10**12]]).tolist()
    df = spark.createDataFrame([(i % 7, int(v)) for i, v in enumerate(values)] + [(0, None), (9, None)], "part int, v long")
    states = sketches.state_of(df, "v", ["part"])
    kept = sketches.merged(states)
    assert rows(sketches.moments(kept))[0] == rows(sketches.moments(sketches.state_of(df, "v")))[0]
    n, total, mean, std, low, high = rows(sketches.moments(kept))[0]
    assert (n, total, low, high) == (len(values), sum(values), 0, 10**12) and abs(mean - np.mean(values)) < 1e-3 and abs(std - np.std(values)) < 1e-3 * std
    order = np.sort(values)
    for rank, value in rows(sketches.quantiles(kept, [0.0, 0.01, 0.2, 0.5, 0.8, 0.99, 1.0])):
        low_rank, high_rank = np.searchsorted(order, value, "left") / n, np.searchsorted(order, value, "right") / n
        assert low_rank - sketches.rank_error() <= rank <= high_rank + sketches.rank_error()
    most = df.filter("v < 1000000")
    bins = sketches.histogram(sketches.merged(sketches.state_of(most, "v", ["part"])), 10).orderBy("bin").collect()
    exact = np.histogram([v for v in values if v < 10**6], 10)[0]
    assert all(abs(b["count"] - e) <= 2 * sketches.rank_error() * n + 1 for b, e in zip(bins, exact, strict=True))
    assert rows(sketches.state_of(df.limit(0), "v", ["part"])) == [] and states.filter(F.col("part") == 9).count() == 0


MESSAGES = "row_id long, messages array<struct<role:string,content:string>>"


def test_the_given_template_renders_as_before(spark):
    df = spark.createDataFrame([
        (1, [("system", "s"), ("user", "u\n{{ x }}"), ("assistant", "a")]), (2, [("tool", "t"), ("user", "")]), (3, []), (4, [("user", None), ("user", "x")]),
    ], MESSAGES)
    render = compile_template(chat.DEFAULT_CHAT_TEMPLATE, eos_token="</s>")
    got = df.select("row_id", render(F.col("messages")).alias("text"))
    assert rows(got) == rows(chat.chat_render(df).select("row_id", "text"))
    asked = compile_template(chat.DEFAULT_CHAT_TEMPLATE, eos_token="</s>", add_generation_prompt=True)
    assert rows(df.filter("row_id = 1").select(asked(F.col("messages"))))[0][0].endswith("a</s>\n<|assistant|>\n")
    assert "PythonUDF" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("template", "want"), [
    ("{% for m in messages %}{{ loop.index }}{{ m.role | upper }};{% endfor %}", "1USER;2BOT;"),
    ("a\n  {% if flag %}\nb\n  {% else %}\nc\n{% endif %}\nd", "a\nb\nd"),
    ("{% if not flag or name == 'x' %}1{% elif name != \"y\" and flag %}2{% endif %}!", "2!"),
    ("{{ '{' + 'it\\'s' ~ \"\\t\" + ( name | trim ) }}{# no #}", "{it's\tz"),
    ("x {{- ' y ' -}}  z", "x y z"),
    ("{% for m in messages %}{% for n in messages %}{{ m.role + n['role'] }}{% if loop.last %}|{% endif %}{% endfor %}{% endfor %}", "useruseruserbot|botuserbotbot|"),
    ("{% if name in ['a', ' z '] %}in{% endif %}", "in"),
    ("", ""),
])
def test_templates(spark, template, want):
    df = spark.createDataFrame([(1, [("user", "u"), ("bot", "b")])], MESSAGES)
    assert rows(df.select(compile_template(template, flag=True, name=" z ")(F.col("messages")))) == [(want,)]


@pytest.mark.parametrize("template", ["{% set x = 1 %}", "{% for m in messages %}", "{{ }}", "{{ a b }}", "{{ unknown }}", "{{ 'x' | json }}", "{{ 1 $ 2 }}", "{% if 'a' == %}{% endif %}"])
def test_what_templates_lack(spark, template):
    with pytest.raises(TemplateError):
        compile_template(template)(F.col("messages"))
