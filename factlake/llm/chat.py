"""Chat formatting with a compiled, sandboxed template language.

A template is parsed into a syntax tree, constants are folded, and the tree is
turned into Python closures that yield pieces of text with a flag that says
whether the piece is generated (under the loss mask). Templates reach nothing
but the names they are given, items of those, a few operators and the filters
listed here; there is no attribute access, call or import.

    {{ expression }}            output
    {% for x in name %} ... {% endfor %}        with loop.index0, loop.first
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}
    {# comment #}
    expressions: 'text', 12, true, false, none, name, name.item, name['item'],
                 ~ + == != not and or ( ), filters: | escape | escape_line | trim | upper | lower | length

Rendering takes an iterator of turns and yields pieces, so a conversation of any
length needs the memory of its longest turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import ship, stored

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for message in messages %}" + START + "{{ message.role | escape_line }}\n"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}" + END + "\n{% endfor %}"
)
LEARNED_ROLE = "assistant"
ROW_CHARS = 1 << 20


def escape(text: str) -> str:
    """Afterwards the text has no "<|": control strings begin with it. Undone by ``unescape``."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "escape": lambda v: escape(_text(v)),
    "escape_line": lambda v: escape_line(_text(v)),
    "trim": lambda v: _text(v).strip(),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "length": len,
}


def _text(v: Any) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v)


class TemplateError(ValueError):
    pass


# --- syntax tree -----------------------------------------------------------


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
class Op:
    kind: str
    args: tuple


@dataclass(frozen=True)
class Out:
    value: Any


@dataclass(frozen=True)
class For:
    var: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<num>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[~+|().\[\]]))")
_WORDS = {"true": True, "false": False, "none": None}
_OPERATORS: dict[str, Callable[..., Any]] = {
    "~": lambda a, b: _text(a) + _text(b),
    "+": lambda a, b: a + b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "not": lambda a: not a,
}


class _Expression:
    """Recursive descent: or, and, not, comparison, ~ and +, filters, items."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while at < len(source.rstrip()):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup or "", m[m.lastgroup or 0]))
            at = m.end()
        self.at = 0

    def peek(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        return "" if kind == "str" else value

    def take(self, value: str = "") -> tuple[str, str]:
        if self.at >= len(self.tokens) or value and self.peek() != value:
            raise TemplateError(f"expected {value or 'an expression'}")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self) -> Any:
        out = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()!r}")
        return out

    def _chain(self, below: Callable[[], Any], words: tuple[str, ...]) -> Any:
        out = below()
        while self.peek() in words and self.peek():
            out = Op(self.take()[1], (out, below()))
        return out

    def either(self) -> Any:
        return self._chain(lambda: self._chain(self.negated, ("and",)), ("or",))

    def negated(self) -> Any:
        if self.peek() == "not":
            self.take()
            return Op("not", (self.negated(),))
        return self._chain(lambda: self._chain(self.filtered, ("~", "+")), ("==", "!="))

    def filtered(self) -> Any:
        out = self.item()
        while self.peek() == "|":
            self.take()
            name = self.take()[1]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            out = Op("|" + name, (out,))
        return out

    def item(self) -> Any:
        kind, value = self.take()
        if kind == "str":
            out: Any = Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1]))
        elif kind == "num":
            out = Const(int(value))
        elif kind == "name":
            out = Const(_WORDS[value]) if value in _WORDS else Name(value)
        elif value == "(":
            out = self.either()
            self.take(")")
        else:
            raise TemplateError(f"unexpected {value!r}")
        while self.peek() in (".", "["):
            if self.take()[1] == ".":
                out = Item(out, Const(self.take()[1]))
            else:
                out = Item(out, self.either())
                self.take("]")
        return out


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.DOTALL)


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(source):
        parts.append(("text", source[at : m.start()]))
        if m[1] is not None:
            parts.append(("out", m[1]))
        elif m[2] is not None:
            parts.append(("tag", m[2].strip()))
        at = m.end()
    parts.append(("text", source[at:]))
    where = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal where
        nodes: list[Any] = []
        while where < len(parts):
            kind, body = parts[where]
            where += 1
            if kind == "text":
                nodes.append(Out(Const(body)))
            elif kind == "out":
                nodes.append(Out(_Expression(body).whole()))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return tuple(nodes), body
                nodes.append(tag(word, rest.strip()))
        if ends:
            raise TemplateError(f"no {' or '.join(ends)}")
        return tuple(nodes), ""

    def tag(word: str, rest: str) -> Any:
        if word == "for":
            m = re.fullmatch(r"(\w+)\s+in\s+(.+)", rest, re.DOTALL)
            if not m:
                raise TemplateError(f"can't read for {rest}")
            return For(m[1], _Expression(m[2]).whole(), block("endfor")[0])
        if word == "generation":
            return Generation(block("endgeneration")[0])
        if word == "if":
            return branch(rest)
        raise TemplateError(f"no tag {word!r}")

    def branch(test: str) -> If:
        then, end = block("elif", "else", "endif")
        other: tuple = ()
        if end.startswith("elif"):
            other = (branch(end[4:]),)
        elif end == "else":
            other = block("endif")[0]
        return If(_Expression(test).whole(), then, other)

    return block()[0]


def fold(node: Any) -> Any:
    """The tree with constant parts computed, dead branches gone and neighbouring texts joined."""
    if isinstance(node, tuple):
        out: list[Any] = []
        for x in map(fold, node):
            for y in x if isinstance(x, tuple) else (x,):
                if isinstance(y, Out) and isinstance(y.value, Const):
                    y = Out(Const(_text(y.value.value)))
                    if not y.value.value:
                        continue
                    if out and isinstance(out[-1], Out) and isinstance(out[-1].value, Const):
                        y = Out(Const(out.pop().value.value + y.value.value))
                out.append(y)
        return tuple(out)
    if isinstance(node, Op):
        args = tuple(map(fold, node.args))
        if node.kind in ("and", "or"):
            if isinstance(args[0], Const):
                return args[1] if bool(args[0].value) == (node.kind == "and") else args[0]
            return Op(node.kind, args)
        if all(isinstance(a, Const) for a in args):
            return Const(_operator(node.kind)(*(a.value for a in args)))
        return Op(node.kind, args)
    if isinstance(node, Item):
        return Item(fold(node.of), fold(node.key))
    if isinstance(node, Out):
        return Out(fold(node.value))
    if isinstance(node, For):
        return For(node.var, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, If):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other)
        return If(test, fold(node.then), fold(node.other))
    return node


def _operator(kind: str) -> Callable[..., Any]:
    return FILTERS[kind[1:]] if kind[0] == "|" else _OPERATORS[kind]


# --- closures --------------------------------------------------------------


def _value(node: Any) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        v = node.value
        return lambda env: v
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    if isinstance(node, Item):
        of, key = _value(node.of), _value(node.key)

        def item(env: dict) -> Any:
            holder = of(env)
            return holder.get(key(env)) if isinstance(holder, dict) else None

        return item
    args = [_value(a) for a in node.args]
    if node.kind == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.kind == "or":
        return lambda env: args[0](env) or args[1](env)
    f = _operator(node.kind)
    if len(args) == 1:
        a = args[0]
        return lambda env: f(a(env))
    a, b = args
    return lambda env: f(a(env), b(env))


Piece = tuple[str, bool]


def _pieces(nodes: tuple, generated: bool) -> Callable[[dict], Iterator[Piece]]:
    steps = [_step(n, generated) for n in nodes]

    def run(env: dict) -> Iterator[Piece]:
        for s in steps:
            yield from s(env)

    return run


def _step(node: Any, generated: bool) -> Callable[[dict], Iterator[Piece]]:
    if isinstance(node, Out):
        value = _value(node.value)
        return lambda env: iter(((_text(value(env)), generated),))
    if isinstance(node, Generation):
        return _pieces(node.body, True)
    if isinstance(node, If):
        test, then, other = _value(node.test), _pieces(node.then, generated), _pieces(node.other, generated)
        return lambda env: then(env) if test(env) else other(env)
    over, body, var = _value(node.over), _pieces(node.body, generated), node.var

    def loop(env: dict) -> Iterator[Piece]:
        for i, x in enumerate(over(env) or ()):
            yield from body({**env, var: x, "loop": {"index0": i, "first": i == 0}})

    return loop


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from turns to pieces (text, generated)."""
    run = _pieces(fold(parse(source)), False)
    return lambda messages: run({"messages": messages})


# --- tables ----------------------------------------------------------------


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[Any, Iterator[dict]]]:
    """Runs of rows with one conversation id, as iterators; rows come sorted by it."""
    from itertools import groupby

    rows = (dict(zip(names, r, strict=True)) for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    yield from groupby(rows, key=lambda r: r["conv_id"])


def _renderer(template: str, row_chars: int):
    schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for conv, turns in _grouped(batches, ["conv_id", "turn", "role", "text"]):
            texts: list[str] = []
            spans: list[int] = []
            done: list[pa.RecordBatch] = []
            size = seq = 0

            def flush() -> None:
                nonlocal texts, spans, size, seq
                done.append(pa.RecordBatch.from_pylist([{"conv_id": conv, "seq": seq, "formatted": "".join(texts), "spans": spans}], schema=schema))
                texts, spans, size, seq = [], [], 0, seq + 1

            def source() -> Iterator[dict]:
                for t in turns:
                    if size >= row_chars:  # rows end where a turn ends
                        flush()
                    yield {"role": t["role"] or "", "text": t["text"] or ""}

            for text, generated in render(source()):
                if generated and text:
                    spans += [size, size + len(text)]
                texts.append(text)
                size += len(text)
                while done:
                    yield done.pop(0)
            flush()
            yield from done

    return run


def formatted(conversations: DataFrame, template: str = TEMPLATE, row_chars: int = ROW_CHARS) -> DataFrame:
    """conv_id, seq, formatted, spans: rendered conversations.

    A conversation is one row, or several (seq 0, 1, ...) once ``row_chars``
    are reached; ``spans`` are starts and ends of the generated text in the
    row, in code points. Turns are in order of turn, role, text (rows that
    repeat are turns of their own); null role and text are empty; rows without
    conv_id are one conversation.
    """
    ship(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_renderer(template, row_chars), "conv_id long, seq long, formatted string, spans array<long>")


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted row."""
    for part in text.split(START)[1:]:
        role, _, rest = part.partition("\n")
        body, end, _ = rest.rpartition(END)
        if not end:
            raise ValueError("a turn without an end")
        yield unescape_line(role), unescape(body)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    for conv, rows in _grouped(batches, ["conv_id", "seq", "formatted", "spans"]):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n = chars = learned = 0
        for r in rows:
            text, spans = r["formatted"], r["spans"]
            chars += len(text)
            for role, body in read_turns(text):
                turns.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                n += 1
            for a, b in zip(spans[::2], spans[1::2], strict=True):
                body = unescape(text[a:b])
                loss.update(body.encode("utf-8", "surrogatepass"))
                learned += len(body)
        values = [conv, n, turns.hexdigest(), learned, loss.hexdigest(), chars]
        yield pa.record_batch([pa.array([v], k) for v, (_, k) in zip(values, kinds, strict=True)], names=[name for name, _ in kinds])


def chat_digests(rendered: DataFrame) -> DataFrame:
    """Per conversation, read back from ``formatted`` rows: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    rows = rendered.select("conv_id", "seq", "formatted", "spans").repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.mapInArrow(_digests, schema)


def chat_table(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Format, store, read back and digest."""
    return chat_digests(stored(formatted(conversations, template), "chat"))
