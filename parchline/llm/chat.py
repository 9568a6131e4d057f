"""Chat formatting by a template compiler.

A small template language is parsed into a syntax tree, constant parts are folded, and every node
becomes a Python closure; nothing is evaluated as Python, and templates can only reach the values
they are given. Rendering yields pieces of text one by one, each marked as generated or not, so a
conversation is never held whole.

Language::

    {{ expression }}                      text of a value (null is empty)
    {% for name in expression %} ... {% endfor %}        with loop.first and loop.index
    {% if expression %} ... {% elif expression %} ... {% else %} ... {% endif %}
    {% set name = expression %}
    {% generation %} ... {% endgeneration %}             what the model is to learn
    expressions: 'text', "text", 12, true, false, none, name, value.field, value['field'], (..),
                 not, and, or, ==, !=, <, <=, >, >=, +, ~ (joins as text), value | filter
    filters: escape, trim, upper, lower, length

Control strings are ``<|start|>``, ``<|sep|>`` and ``<|end|>``. ``escape`` makes a text free of them and
can be undone: every ``<`` followed by any number of backslashes and a bar gets one more backslash.

Defined results: rows of a conversation are in the order of turn (nulls first), then role, then text;
equal rows stay, each is a turn. Null texts and roles are empty. Rows with a null id form a
conversation of their own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, SEP, END = "<|start|>", "<|sep|>", "<|end|>"

TEMPLATE = (
    "{% for message in messages %}"
    "{{ '<|start|>' }}{{ message.role | escape }}{{ '<|sep|>' }}"
    "{% if message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "{{ '<|end|>' }}{{ '\n' }}"
    "{% endfor %}"
)

_TO_ESCAPE = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


class TemplateError(ValueError):
    """A template that cannot be parsed or that reaches for something it may not have."""


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def as_text(value) -> str:
    if value is None:
        return ""
    return ("true" if value else "false") if isinstance(value, bool) else str(value)


FILTERS: dict[str, Callable] = {
    "escape": lambda v: escape(as_text(v)),
    "trim": lambda v: as_text(v).strip(),
    "upper": lambda v: as_text(v).upper(),
    "lower": lambda v: as_text(v).lower(),
    "length": lambda v: len(v) if isinstance(v, (list, tuple, dict)) else len(as_text(v)),
}

# --- syntax tree: tuples (kind, ...); expressions and statements alike

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~|.()\[\]<>]))", re.S)
_PLAIN = {"n": "\n", "t": "\t", "r": "\r"}
_CONSTANTS = {"true": True, "false": False, "none": None}


def _tokens(source: str) -> list[tuple[str, object]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        number, text, name, sign = m.groups()
        if number:
            out.append(("const", int(number)))
        elif text:
            out.append(("const", re.sub(r"\\(.)", lambda c: _PLAIN.get(c[1], c[1]), text[1:-1], flags=re.S)))
        elif name:
            out.append(("name", name))
        else:
            out.append(("sign", sign))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, self.at = _tokens(source), 0

    def parse(self):
        tree = self._or()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def _take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def _need(self, value: str) -> None:
        if not self._take(value):
            raise TemplateError(f"{value!r} expected")

    def _name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def _or(self):
        tree = self._and()
        while self._take("or"):
            tree = ("or", tree, self._and())
        return tree

    def _and(self):
        tree = self._not()
        while self._take("and"):
            tree = ("and", tree, self._not())
        return tree

    def _not(self):
        return ("not", self._not()) if self._take("not") else self._compared()

    def _compared(self):
        tree = self._sum()
        if sign := self._take("==", "!=", "<", "<=", ">", ">="):
            tree = ("compare", sign, tree, self._sum())
        return tree

    def _sum(self):
        tree = self._filtered()
        while sign := self._take("+", "~"):
            tree = ("add" if sign == "+" else "join", tree, self._filtered())
        return tree

    def _filtered(self):
        tree = self._value()
        while self._take("|"):
            name = self._name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def _value(self):
        if self._take("("):
            tree = self._or()
            self._need(")")
        elif self.at < len(self.tokens) and self.tokens[self.at][0] == "const":
            tree = self.tokens[self.at]
            self.at += 1
        else:
            name = self._name()
            tree = ("const", _CONSTANTS[name]) if name in _CONSTANTS else ("name", name)
        while sign := self._take(".", "["):
            if sign == ".":
                tree = ("field", tree, ("const", self._name()))
            else:
                tree = ("field", tree, self._or())
                self._need("]")
        return tree


def parse(source: str) -> list:
    """The statements of a template."""
    parts, at = [], 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at : m.start()]))
        parts.append(("print", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    body, rest = _body(parts, 0, ())
    if rest < len(parts):
        raise TemplateError(f"unexpected {parts[rest][1]!r}")
    return body


def _body(parts: list, at: int, ends: tuple[str, ...]) -> tuple[list, int]:
    out = []
    while at < len(parts):
        kind, source = parts[at]
        word, _, rest = source.partition(" ") if kind == "tag" else ("", "", "")
        if word in ends:
            return out, at
        at += 1
        if kind == "text":
            out.append(("print", ("const", source)))
        elif kind == "print":
            out.append(("print", _Expression(source).parse()))
        elif word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read {source!r}")
            body, at = _closed(parts, at, "endfor")
            out.append(("for", m[1], _Expression(m[2]).parse(), body))
        elif word == "if":
            node, at = _condition(parts, at, rest)
            out.append(node)
        elif word == "set":
            name, sign, value = rest.partition("=")
            if not sign or not re.fullmatch(r"\s*[A-Za-z_]\w*\s*", name):
                raise TemplateError(f"cannot read {source!r}")
            out.append(("set", name.strip(), _Expression(value).parse()))
        elif word == "generation":
            body, at = _closed(parts, at, "endgeneration")
            out.append(("generation", body))
        else:
            raise TemplateError(f"unknown tag {source!r}")
    if ends:
        raise TemplateError(f"{' or '.join(ends)} expected")
    return out, at


def _closed(parts: list, at: int, end: str) -> tuple[list, int]:
    body, at = _body(parts, at, (end,))
    return body, at + 1


def _condition(parts: list, at: int, source: str) -> tuple[tuple, int]:
    test = _Expression(source).parse()
    body, at = _body(parts, at, ("elif", "else", "endif"))
    word, _, rest = parts[at][1].partition(" ")
    if word == "elif":
        other, at = _condition(parts, at + 1, rest)
        return ("if", test, body, [other]), at
    other = []
    if word == "else":
        other, at = _body(parts, at + 1, ("endif",))
    return ("if", test, body, other), at + 1


# --- folding of constants

_COMPARE = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def fold(tree):
    """The same expression with constant parts worked out."""
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    tree = tuple(fold(x) if isinstance(x, tuple) else x for x in tree)
    inner = [x for x in tree if isinstance(x, tuple)]
    if all(x[0] == "const" for x in inner):
        return ("const", _closure(tree)({}))
    if kind in ("and", "or") and inner[0][0] == "const":
        return inner[1] if bool(inner[0][1]) == (kind == "and") else inner[0]
    return tree


def fold_body(body: list) -> list:
    """Statements with folded expressions, neighbouring constant texts joined, dead branches gone."""
    out: list = []
    for node in body:
        kind = node[0]
        if kind == "print":
            node = ("print", fold(node[1]))
            if node[1][0] == "const":
                text = as_text(node[1][1])
                if out and out[-1][0] == "print" and out[-1][1][0] == "const":
                    text = out.pop()[1][1] + text
                node = ("print", ("const", text))
            out.append(node)
        elif kind == "if":
            test = fold(node[1])
            if test[0] == "const":
                out += fold_body(node[2] if test[1] else node[3])
            else:
                out.append(("if", test, fold_body(node[2]), fold_body(node[3])))
        elif kind == "for":
            out.append(("for", node[1], fold(node[2]), fold_body(node[3])))
        elif kind == "generation":
            out.append(("generation", fold_body(node[1])))
        else:
            out.append(("set", node[1], fold(node[2])))
    return out


# --- closures

Piece = tuple[str, bool]


def _field(value, name):
    if isinstance(value, dict):
        return value.get(name)
    if isinstance(value, (list, tuple)) and isinstance(name, int):
        return value[name] if -len(value) <= name < len(value) else None
    raise TemplateError(f"no field {name!r}")


def _closure(tree) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda scope: value
    if kind == "name":
        name = tree[1]
        return lambda scope: scope.get(name)
    parts = [_closure(x) for x in tree if isinstance(x, tuple)]
    a, b = parts[0], parts[-1]
    if kind == "field":
        return lambda scope: _field(a(scope), b(scope))
    if kind == "filter":
        made = FILTERS[tree[1]]
        return lambda scope: made(a(scope))
    if kind == "compare":
        test = _COMPARE[tree[1]]
        return lambda scope: test(a(scope), b(scope))
    if kind == "not":
        return lambda scope: not a(scope)
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    if kind == "add":
        return lambda scope: a(scope) + b(scope)
    return lambda scope: as_text(a(scope)) + as_text(b(scope))


def _statements(body: list, marked: bool) -> Callable[[dict], Iterator[Piece]]:
    steps = [_statement(node, marked) for node in body]

    def run(scope: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return run


def _statement(node, marked: bool) -> Callable[[dict], Iterator[Piece]]:
    kind = node[0]
    if kind == "print":
        value = _closure(node[1])
        return lambda scope: iter(((as_text(value(scope)), marked),))
    if kind == "generation":
        return _statements(node[1], True)
    if kind == "set":
        name, value = node[1], _closure(node[2])

        def assign(scope: dict) -> Iterator[Piece]:
            scope[name] = value(scope)
            return iter(())

        return assign
    if kind == "if":
        test, yes, no = _closure(node[1]), _statements(node[2], marked), _statements(node[3], marked)
        return lambda scope: yes(scope) if test(scope) else no(scope)
    name, values, body = node[1], _closure(node[2]), _statements(node[3], marked)

    def loop(scope: dict) -> Iterator[Piece]:
        outer = scope.get("loop")
        for i, value in enumerate(values(scope) or ()):
            scope[name], scope["loop"] = value, {"first": i == 0, "index": i + 1}
            yield from body(scope)
        scope["loop"] = outer

    return loop


def compile_template(source: str) -> Callable[..., Iterator[Piece]]:
    """A function from named values to pieces (text, whether it is under the loss mask)."""
    run = _statements(fold_body(parse(source)), False)
    return lambda **values: run(dict(values))


# --- reading back


def read_back(pieces: Iterable[Piece]) -> Iterator[tuple[str | None, str, str, int]]:
    """(role, text, text under the loss mask, formatted length) of each turn, from the output alone.

    What follows the last turn comes with a null role.
    """
    held: list[str] = []
    learned: list[str] = []
    for text, marked in pieces:
        held.append(text)
        if marked:
            learned.append(text)
        if END in text:
            whole = "".join(held)
            head, _, rest = whole.partition(START)
            role, _, rest = rest.partition(SEP)
            body, _, after = rest.partition(END)
            yield unescape(role), unescape(body), unescape("".join(learned)), len(whole) - len(after)
            held, learned = [after], []
    if rest := "".join(held):
        yield None, "", "", len(rest)


def _ordered(conversations: DataFrame) -> DataFrame:
    """Conversations dealt out by id, their rows in order: tasks read them as a stream."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))


def formatted(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, piece (from 0), text, marked: the output of each conversation in pieces of one message.

    ``marked`` lists the parts of ``text`` under the loss mask as (start, end) in code points.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for conv, rows in groupby(_stream(batches), key=lambda r: r[0]):
            number, length, held, marks = 0, 0, [], []
            for text, marked in render(messages=({"role": r[1], "text": r[2]} for r in rows)):
                if marked and text:
                    marks.append({"start": length, "end": length + len(text)})
                held.append(text)
                length += len(text)
                if END in text:
                    yield _piece(conv, number, held, marks)
                    number, length, held, marks = number + 1, 0, [], []
            if length:
                yield _piece(conv, number, held, marks)

    schema = "conv_id bigint, piece bigint, text string, marked array<struct<start:bigint,end:bigint>>"
    return _ordered(conversations).mapInArrow(run, schema)


def _piece(conv, number, held, marks) -> pa.RecordBatch:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    columns = [pa.array([conv], pa.int64()), pa.array([number], pa.int64()), pa.array(["".join(held)], pa.string()), pa.array([marks], spans)]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "piece", "text", "marked"])


def digests(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """What comes back when the output of each conversation is read: counts and digests.

    Rows pass one by one; of a conversation a task holds one message and two running digests.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        out: list[tuple] = []
        for conv, rows in groupby(_stream(batches), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            count = learned = total = 0
            for role, text, part, size in read_back(render(messages=({"role": r[1], "text": r[2]} for r in rows))):
                total += size
                if role is None:  # what follows the last turn
                    continue
                count += 1
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                loss.update(part.encode("utf-8", "surrogatepass"))
                learned += len(part)
            out.append((conv, count, turns.hexdigest(), learned, loss.hexdigest(), total))
            if len(out) >= 1000:
                yield _rows(out, names)
                out = []
        yield _rows(out, names)

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return _ordered(conversations).mapInArrow(run, schema)


def _rows(out: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = list(zip(*out)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
