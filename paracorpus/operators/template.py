"""Chat templates given as text, compiled to columns.

The subset of the template language that chat templates use: loops over messages,
if/elif/else, output of expressions, and the usual rule that a line break after a
block tag and blanks before one at the start of its line don't count.  Expressions
join strings, compare, combine conditions, look up a message's parts and the
loop's place, and trim or change case.  The result is one native expression over an
array of (role, content) structs: a template costs a projection, no Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_TAG = re.compile(r"\{%(?P<bl>-?)\s*(?P<block>.*?)\s*(?P<br>-?)%\}|\{\{(?P<ol>-?)\s*(?P<out>.*?)\s*(?P<or>-?)\}\}|\{#.*?#\}", re.S)
_WORD = re.compile(r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|[+~|().,\[\]]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}

Env = dict[str, object]
Part = Callable[[Env], Column]


class TemplateError(ValueError):
    """The template uses what the subset lacks, or is malformed."""


def _pieces(template: str) -> list[tuple[str, str]]:
    """(text | block | out, source), with the blanks around tags dropped that don't count."""
    out, at, strip, after_block = [], 0, False, False
    for m in [*_TAG.finditer(template), None]:
        text = template[at : m.start() if m else len(template)]
        if after_block and text.startswith("\n"):
            text = text[1:]
        if strip:
            text = text.lstrip()
        block = m is not None and m["block"] is not None
        if m and (m["bl"] or m["ol"]):
            text = text.rstrip()
        elif block:
            line = text.rstrip(" \t")
            text = line if line.endswith("\n") or not line and (at == 0 or after_block) else text
        if text:
            out.append(("text", text))
        if m is None:
            return out
        if block:
            out.append(("block", m["block"]))
        elif m["out"] is not None:
            out.append(("out", m["out"]))
        at, strip, after_block = m.end(), bool(m["br"] or m["or"]), block
    return out


class _Expression:
    """Recursive descent over one expression; the result maps names to a column."""

    def __init__(self, source: str):
        self.words, self.at = [], 0
        place = 0
        while source[place:].strip():
            m = _WORD.match(source, place)
            if not m:
                raise TemplateError(f"cannot read {source[place:]!r}")
            self.words.append((m.lastgroup, m[m.lastgroup]))
            place = m.end()
        self.source = source

    def next(self, *wanted: str) -> str | None:
        if self.at < len(self.words) and self.words[self.at][0] != "text" and self.words[self.at][1] in wanted:
            self.at += 1
            return self.words[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.next(wanted):
            raise TemplateError(f"{wanted!r} expected in {self.source!r}")

    def whole(self) -> Part:
        part = self.either()
        if self.at < len(self.words):
            raise TemplateError(f"cannot read {self.words[self.at][1]!r} in {self.source!r}")
        return part

    def either(self) -> Part:
        parts = [self.both()]
        while self.next("or"):
            parts.append(self.both())
        return parts[0] if len(parts) == 1 else lambda env: reduce(lambda a, b: a | b, [p(env) for p in parts])

    def both(self) -> Part:
        parts = [self.negated()]
        while self.next("and"):
            parts.append(self.negated())
        return parts[0] if len(parts) == 1 else lambda env: reduce(lambda a, b: a & b, [p(env) for p in parts])

    def negated(self) -> Part:
        if self.next("not"):
            part = self.negated()
            return lambda env: ~part(env)
        left = self.joined()
        if mark := self.next("==", "!="):
            right = self.joined()
            return lambda env: left(env).eqNullSafe(right(env)) if mark == "==" else ~left(env).eqNullSafe(right(env))
        if self.next("in"):
            self.need("[")
            among = [self.joined()]
            while self.next(","):
                among.append(self.joined())
            self.need("]")
            return lambda env: reduce(lambda a, b: a | b, [left(env).eqNullSafe(x(env)) for x in among])
        return left

    def joined(self) -> Part:
        parts = [self.filtered()]
        while self.next("+", "~"):
            parts.append(self.filtered())
        return parts[0] if len(parts) == 1 else lambda env: F.concat(*[p(env) for p in parts])

    def filtered(self) -> Part:
        part = self.atom()
        while self.next("|"):
            kind, name = self.words[self.at] if self.at < len(self.words) else ("", "")
            change = {"trim": lambda c: F.regexp_replace(c, r"^\s+|\s+$", ""), "upper": F.upper, "lower": F.lower}.get(name)
            if change is None:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            part = (lambda p, f: lambda env: f(p(env)))(part, change)
        return part

    def atom(self) -> Part:
        if self.next("("):
            part = self.either()
            self.need(")")
            return part
        if self.at == len(self.words):
            raise TemplateError(f"an expression is missing in {self.source!r}")
        kind, word = self.words[self.at]
        self.at += 1
        if kind == "text":
            text = re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S)
            return lambda env: F.lit(text)
        if kind == "number":
            return lambda env: F.lit(int(word))
        if kind != "name":
            raise TemplateError(f"cannot read {word!r} in {self.source!r}")
        path = [word]
        while mark := self.next(".", "["):
            path.append(self.words[self.at][1].strip("'\""))
            self.at += 1
            if mark == "[":
                self.need("]")
        return lambda env: _value(env, path)


def _value(env: Env, path: list[str]) -> Column:
    value: object = env.get(path[0])
    if path[0] not in env:
        raise TemplateError(f"no value for {path[0]!r}")
    for name in path[1:]:
        value = value[name]
    return value if isinstance(value, Column) else F.lit(value)


def _joined(parts: list[Part]) -> Part:
    return lambda env: F.concat(*[p(env) for p in parts]) if parts else F.lit("")


def _body(pieces: list[tuple[str, str]], ends: tuple[str, ...]) -> tuple[Part, str]:
    """The parts up to a block that begins with one of ``ends``, and that block."""
    parts: list[Part] = []
    while pieces:
        kind, source = pieces.pop(0)
        if kind == "text":
            parts.append(lambda env, text=source: F.lit(text))
        elif kind == "out":
            parts.append(_Expression(source).whole())
        elif source.split()[0] in ends:
            return _joined(parts), source
        elif m := re.fullmatch(r"for\s+(\w+)\s+in\s+(\w+)", source):
            inner, _ = _body(pieces, ("endfor",))
            parts.append(_loop(m[1], m[2], inner))
        elif source.startswith("if "):
            parts.append(_choice(source, pieces))
        else:
            raise TemplateError(f"no block {source!r}")
    if ends:
        raise TemplateError(f"{' or '.join(ends)} is missing")
    return _joined(parts), ""


def _loop(name: str, over: str, inner: Part) -> Part:
    def part(env: Env) -> Column:
        items = env[over]
        last = F.size(items) - 1

        def one(item: Column, k: Column) -> Column:
            loop = {"first": k == 0, "last": k == last, "index0": k, "index": k + 1}
            return inner({**env, name: item, "loop": loop})

        return F.array_join(F.transform(items, one), "")

    return part


def _choice(source: str, pieces: list[tuple[str, str]]) -> Part:
    cases: list[tuple[Part | None, Part]] = []
    while True:
        word, _, rest = source.partition(" ")
        condition = _Expression(rest).whole() if word != "else" else None
        body, source = _body(pieces, ("elif", "else", "endif"))
        cases.append((condition, body))
        if source == "endif":
            break

    def part(env: Env) -> Column:
        out = F.lit("")
        for condition, body in reversed(cases):
            out = body(env) if condition is None else F.when(condition(env), body(env)).otherwise(out)
        return out

    return part


def compile_template(template: str, **values: object) -> Callable[[Column], Column]:
    """A function from an array of (role, content) structs to the rendered text.

    ``values`` are the template's other names (``eos_token``, ``bos_token``,
    ``add_generation_prompt`` and so on), constants or columns.  A message whose
    output is null (null content) renders nothing; a null array gives null, or the
    text around the loop where there is some; an unknown construct or name raises.
    """
    body, _ = _body(_pieces(template), ())
    return lambda messages: body({"add_generation_prompt": False, **values, "messages": messages})
