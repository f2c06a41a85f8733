"""Chat formatting: a small sandboxed template language, compiled to closures.

A template holds plain text and tags: ``{{ expression }}``, ``{% for x in list %}``
``{% endfor %}``, ``{% if %}`` ``{% elif %}`` ``{% else %}`` ``{% endif %}``,
``{% set name = expression %}``, and ``{% generation %}`` ``{% endgeneration %}``
around text that a model is trained to produce.  Expressions know text and number
literals, names, ``a.key`` and ``a['key']`` on mappings, ``+ ~ == != < <= > >= in and
or not``, brackets, and the filters in ``FILTERS``.  Nothing else can be reached from a template:
no attributes of Python objects, no calls, no imports.

A template is parsed to a tree; constant parts are folded; each node becomes a
closure.  Output comes piece by piece, so a conversation of any length is rendered
without being held in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ESCAPE = "\\"
# control strings of the default template, as they begin
CONTROL = ("<turn>", "</turn>", "###")

DEFAULT_TEMPLATE = (
    "{% for m in messages %}<turn>{{ m.role | escape_line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}"
)

# a part of a formatted conversation is cut once it has this many characters
PART_CHARS = 1 << 20

_ESCAPED = re.compile("|".join(map(re.escape, (ESCAPE, *CONTROL))))
_LINE_ESCAPED = re.compile("|".join(map(re.escape, (ESCAPE, *CONTROL, "\n"))))


class TemplateError(ValueError):
    """A template that cannot be compiled, or a value it cannot use."""


def escape(text: str) -> str:
    """The text with an escape character before control strings and before itself."""
    return _ESCAPED.sub(lambda m: ESCAPE + m[0], text)


def escape_line(text: str) -> str:
    """The same for a text that ends at a line's end."""
    return _LINE_ESCAPED.sub(lambda m: ESCAPE + m[0], text)


def unescape(text: str) -> str:
    """What ``escape`` or ``escape_line`` was given."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "escape": lambda x: escape(_text(x)),
    "escape_line": lambda x: escape_line(_text(x)),
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
    "length": lambda x: len(x),
}


def _text(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str | int | float):
        return str(value)
    raise TemplateError(f"a {type(value).__name__} is no text")


# --- tree -------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """An operator or filter on its arguments."""

    op: str
    args: tuple


@dataclass(frozen=True)
class Emit:
    value: Any


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Loop:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Branch:
    arms: tuple  # of (condition, body)


@dataclass(frozen=True)
class Generation:
    body: tuple


_OPS: dict[str, Callable] = {
    "+": lambda a, b: a + b,
    "~": lambda a, b: _text(a) + _text(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "not": lambda a: not a,
}

_TOKEN = re.compile(r"\s*(?:(\d+(?:\.\d+)?)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~<>.|()\[\]=]))")
_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_LITERALS = {"true": True, "false": False, "none": None}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            kind = m.lastindex
            self.tokens.append((kind, m[kind]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] > 2 else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, *wanted: str) -> str:
        found = self.take(*wanted)
        if found is None:
            raise TemplateError(f"one of {wanted} is missing")
        return found

    def whole(self) -> Any:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != 3:
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def either(self) -> Any:
        node = self.both()
        while self.take("or"):
            node = Apply("or", (node, self.both()))
        return node

    def both(self) -> Any:
        node = self.negated()
        while self.take("and"):
            node = Apply("and", (node, self.negated()))
        return node

    def negated(self) -> Any:
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        node = self.joined()
        while op := self.take("==", "!=", "<", "<=", ">", ">=", "in"):
            node = Apply(op, (node, self.joined()))
        return node

    def joined(self) -> Any:
        node = self.filtered()
        while op := self.take("+", "~"):
            node = Apply(op, (node, self.filtered()))
        return node

    def filtered(self) -> Any:
        node = self.item()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"there is no filter {name}")
            node = Apply(f"|{name}", (node,))
        return node

    def item(self) -> Any:
        node = self.atom()
        while op := self.take(".", "["):
            node = Item(node, Const(self.name()) if op == "." else self.either())
            if op == "[":
                self.need("]")
        return node

    def atom(self) -> Any:
        if self.take("("):
            node = self.either()
            self.need(")")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, token = self.tokens[self.at]
        if kind == 1:
            self.at += 1
            return Const(float(token) if "." in token else int(token))
        if kind == 2:
            self.at += 1
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.DOTALL))
        name = self.name()
        return Const(_LITERALS[name]) if name in _LITERALS else Name(name)


def parse(template: str) -> tuple:
    """The template's tree."""
    pieces, at = [], 0
    for m in _TAG.finditer(template):
        pieces += [("text", template[at : m.start()]), ("value", m[1]) if m[1] is not None else ("tag", m[2].strip())]
        at = m.end()
    pieces.append(("text", template[at:]))
    body, rest = _body(pieces, 0, ())
    if rest < len(pieces):
        raise TemplateError(f"unexpected {pieces[rest][1]!r}")
    return body


def _body(pieces: list, at: int, ends: tuple[str, ...]) -> tuple[tuple, int]:
    out = []
    while at < len(pieces):
        kind, source = pieces[at]
        at += 1
        if kind == "text":
            out += [Emit(Const(source))] * bool(source)
            continue
        if kind == "value":
            out.append(Emit(_Expression(source).whole()))
            continue
        word, _, rest = source.partition(" ")
        if word in ends:
            return tuple(out), at - 1
        if word == "set":
            name, equals, value = rest.partition("=")
            if not equals or not name.strip().isidentifier():
                raise TemplateError(f"set {rest!r}")
            out.append(Assign(name.strip(), _Expression(value).whole()))
        elif word == "generation":
            body, at = _body(pieces, at, ("endgeneration",))
            out.append(Generation(body))
            at += 1
        elif word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.DOTALL)
            if not m:
                raise TemplateError(f"for {rest!r}")
            body, at = _body(pieces, at, ("endfor",))
            out.append(Loop(m[1], _Expression(m[2]).whole(), body))
            at += 1
        elif word == "if":
            arms, condition = [], _Expression(rest).whole()
            while True:
                body, at = _body(pieces, at, ("elif", "else", "endif"))
                arms.append((condition, body))
                word, _, rest = pieces[at][1].partition(" ")
                at += 1
                if word == "endif":
                    break
                if isinstance(condition, Const) and condition.value is True and word == "else":
                    raise TemplateError("a second else")
                condition = _Expression(rest).whole() if word == "elif" else Const(True)
            out.append(Branch(tuple(arms)))
        else:
            raise TemplateError(f"unexpected {source!r}")
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return tuple(out), at


def fold(node: Any) -> Any:
    """The tree with constant expressions computed, joined and chosen."""
    if isinstance(node, tuple):
        out: list = []
        for x in map(fold, node):
            for y in x if isinstance(x, tuple) else (x,):
                if isinstance(y, Emit) and isinstance(y.value, Const) and out and isinstance(out[-1], Emit) and isinstance(out[-1].value, Const):
                    out[-1] = Emit(Const(_text(out[-1].value.value) + _text(y.value.value)))
                else:
                    out.append(y)
        return tuple(out)
    if isinstance(node, Apply):
        args = tuple(map(fold, node.args))
        if all(isinstance(a, Const) for a in args):
            return Const(_expression(Apply(node.op, args))({}))
        return Apply(node.op, args)
    if isinstance(node, Item):
        return Item(fold(node.of), fold(node.key))
    if isinstance(node, Emit):
        value = fold(node.value)
        return () if isinstance(value, Const) and not _text(value.value) else Emit(value)
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, Branch):
        arms = []
        for condition, body in node.arms:
            condition = fold(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            arms.append((condition, fold(body)))
            if isinstance(condition, Const):
                break
        if arms and isinstance(arms[0][0], Const):
            return arms[0][1]
        return Branch(tuple(arms)) if arms else ()
    return node


# --- closures ---------------------------------------------------------------

Piece = tuple[str, bool]  # text, and whether a model is to produce it


def _expression(node: Any) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name

        def named(scope: dict) -> Any:
            return scope.get(name)

        return named
    if isinstance(node, Item):
        of, key = _expression(node.of), _expression(node.key)

        def item(scope: dict) -> Any:
            holder, k = of(scope), key(scope)
            if isinstance(holder, Mapping):
                return holder.get(k)
            if isinstance(holder, list | tuple) and isinstance(k, int):
                return holder[k] if -len(holder) <= k < len(holder) else None
            raise TemplateError(f"a {type(holder).__name__} has no items")

        return item
    parts = [_expression(a) for a in node.args]
    if node.op == "and":
        return lambda scope: parts[0](scope) and parts[1](scope)
    if node.op == "or":
        return lambda scope: parts[0](scope) or parts[1](scope)
    call = FILTERS[node.op[1:]] if node.op[0] == "|" else _OPS[node.op]

    def apply(scope: dict) -> Any:
        try:
            return call(*(part(scope) for part in parts))
        except TypeError as error:
            raise TemplateError(f"{node.op}: {error}") from None

    return apply


def _statement(node: Any) -> Callable[[dict], Iterator[Piece]]:
    if isinstance(node, Emit):
        if isinstance(node.value, Const):
            fixed = ((_text(node.value.value), False),)
            return lambda scope: fixed
        value = _expression(node.value)
        return lambda scope: ((_text(value(scope)), False),)
    if isinstance(node, Assign):
        name, value = node.name, _expression(node.value)

        def assign(scope: dict) -> Iterator[Piece]:
            scope[name] = value(scope)
            return ()

        return assign
    if isinstance(node, Generation):
        inside = _statements(node.body)
        return lambda scope: ((text, True) for text, _ in inside(scope))
    if isinstance(node, Branch):
        arms = [(_expression(c), _statements(b)) for c, b in node.arms]

        def branch(scope: dict) -> Iterator[Piece]:
            for condition, body in arms:
                if condition(scope):
                    return body(scope)
            return ()

        return branch
    name, over, body = node.name, _expression(node.over), _statements(node.body)

    def loop(scope: dict) -> Iterator[Piece]:
        inner, rest = dict(scope), iter(over(scope) or ())
        # null items are items
        end = object()
        following = next(rest, end)
        index = 0
        while following is not end:
            inner[name], following = following, next(rest, end)
            index += 1
            inner["loop"] = {"index": index, "index0": index - 1, "first": index == 1, "last": following is end}
            yield from body(inner)

    return loop


def _statements(nodes: tuple) -> Callable[[dict], Iterator[Piece]]:
    calls = [_statement(n) for n in nodes]

    def run(scope: dict) -> Iterator[Piece]:
        for call in calls:
            yield from call(scope)

    return run


def compile_template(template: str) -> Callable[..., Iterator[Piece]]:
    """A function that renders the template for the variables it is given."""
    run = _statements(fold(parse(template)))
    return lambda **variables: run(dict(variables))


# --- Spark ------------------------------------------------------------------

FORMATTED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("formatted", T.StringType()),
        # starts and ends, in characters of this part, of what a model is to produce
        T.StructField("loss", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
)


def _turns(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)


def _parts(pieces: Iterable[Piece]) -> Iterator[tuple[str, list]]:
    """Pieces joined to parts of bounded length, each with its spans of loss.

    A part ends between turns or inside one; a span never goes over its end.
    """
    texts, spans, size = [], [], 0
    for text, produced in pieces:
        if produced and text:
            if spans and spans[-1][1] == size:
                spans[-1][1] = size + len(text)
            else:
                spans.append([size, size + len(text)])
        texts.append(text)
        size += len(text)
        if size >= PART_CHARS:
            yield "".join(texts), spans
            texts, spans, size = [], [], 0
    if texts or not size:
        yield "".join(texts), spans


def format_conversations(turns: DataFrame, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """Conversations as training text: ``conv_id, part, formatted, loss``.

    Turns are taken by ``turn``, then role and text; turns without a number come
    first, and rows without a conversation id are one conversation.  A null text or
    role is empty; repeated rows are repeated turns; further columns are left out.
    Conversations are shuffled by id and sorted outside memory; each is rendered as
    a stream, so that one of any length is never held whole.  Texts of more than
    ``PART_CHARS`` characters come in parts, in order.
    """
    compile_template(template)  # fail here, not in a task

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compile_template(template)
        schema = pa.schema(
            [("conv_id", pa.int64()), ("part", pa.int32()), ("formatted", pa.string()), ("loss", pa.list_(pa.list_(pa.int32())))]
        )
        rows, size = [], 0
        for conv_id, group in groupby(_turns(batches), key=lambda r: r[0]):
            messages = ({"role": r[1], "text": r[2]} for r in group)
            for part, (text, spans) in enumerate(_parts(run(messages=messages))):
                rows.append((conv_id, part, text, spans))
                size += len(text)
                if size >= PART_CHARS or len(rows) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        "turn",
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(render, FORMATTED)


_MARK = re.compile(r"\\.|<turn>|</turn>|\n", re.DOTALL)

DIGEST = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)


class _Reader:
    """Turns and trained-on text read back from a formatted conversation's parts."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.state = "between"  # or in a turn's "role" or "text"
        self.held = ""  # what may be the start of a mark that the next part ends
        self.loss_held = ""

    def add(self, text: str, spans: list) -> None:
        self.chars += len(text)
        for start, end in spans:
            self._loss(text[start:end])
        text, at = self.held + text, 0
        # a mark has at most 7 characters; one that begins near the end waits
        sure = len(text) - 7
        for m in _MARK.finditer(text):
            if m.start() > sure:
                break
            self._text(text[at : m.start()])
            at = m.end()
            self._mark(m[0])
        cut = max(at, min(len(text), sure + 1))
        self._text(text[at:cut])
        self.held = text[cut:]

    def _loss(self, text: str) -> None:
        text = self.loss_held + text
        # an escape character and what it protects may lie in two parts
        odd = (len(text) - len(text.rstrip(ESCAPE))) % 2
        self.loss_held = text[len(text) - odd :]
        plain = unescape(text[: len(text) - odd])
        self.loss_chars += len(plain)
        self.loss.update(plain.encode())

    def _text(self, text: str) -> None:
        if self.state != "between":
            self.turns.update(text.encode())

    def _mark(self, mark: str) -> None:
        if mark == "<turn>" and self.state == "between":
            self.state = "role"
        elif mark == "</turn>" and self.state == "text":
            self.turns.update(b"\n")
            self.n_turns += 1
            self.state = "between"
        elif self.state != "between":
            self.turns.update(mark[mark[0] == ESCAPE :].encode())
            if mark == "\n" and self.state == "role":
                self.state = "text"

    def row(self) -> tuple:
        text, at = self.held, 0
        for m in _MARK.finditer(text):
            self._text(text[at : m.start()])
            at = m.end()
            self._mark(m[0])
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(formatted: DataFrame) -> DataFrame:
    """What formatted conversations of the default template hold, as counts and digests.

    ``conv_id, n_turns, turns_sha256`` of role, line end, text, line end per turn,
    ``loss_chars, loss_sha256`` of the text to be produced, ``formatted_chars``.
    Needs the parts of a conversation in one partition and in order, as
    ``format_conversations`` gives them.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64())]
            + [("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
        )
        rows, reader = [], None
        for batch in batches:
            for conv_id, text, spans in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if reader is None or conv_id != reader.conv_id:
                    if reader is not None:
                        rows.append(reader.row())
                    reader = _Reader(conv_id)
                reader.add(text, spans)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows = []
        if reader is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(reader.row(), schema, strict=True)], schema=schema)

    return formatted.mapInArrow(digest, DIGEST)
