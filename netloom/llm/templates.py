"""A sandboxed template language for conversations, compiled to Python closures.

    {{ expression }}   {% if e %}..{% elif e %}..{% else %}..{% endif %}   {% for name in e %}..{% endfor %}
    {% set name = e %}   {% generation %}..{% endgeneration %}   {# comment #}   a dash inside a mark trims white space

Expressions know literals, names, keys of records (``a.b``, ``a["b"]``), ``not and or``, comparisons, ``in``, ``+ - * ~``, ``if else`` and filters
after a bar. There are no calls, no attributes of Python objects and no names with a leading underscore. What a ``generation``
block writes is marked.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Any

_BARRED = re.compile(r"<(\\*)\|")
_UNBARRED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left, so no control string can be read in the text: a backslash goes before every such bar."""
    return _BARRED.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _UNBARRED.sub(r"<\1|", text)


def escape_name(text: str) -> str:
    """Like ``escape``, and on one line."""
    return escape(text).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_name(text: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text))


FILTERS: dict[str, Callable[[Any], Any]] = {
    "escape": escape, "escape_name": escape_name, "trim": lambda v: str(v).strip(), "upper": lambda v: str(v).upper(),
    "lower": lambda v: str(v).lower(), "length": len, "string": str,
}
_OPERATIONS: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "not in": lambda a, b: a not in b, "+": lambda a, b: a + b,
    "-": lambda a, b: a - b, "*": lambda a, b: a * b, "~": lambda a, b: f"{a}{b}",
}


class TemplateError(ValueError):
    pass


# --- syntax tree ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Constant:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: Any
    key: Any


@dataclass(frozen=True)
class Filter:
    of: Any
    name: str


@dataclass(frozen=True)
class Not:
    of: Any


@dataclass(frozen=True)
class Operation:
    sign: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Choice:
    test: Any
    then: Any
    other: Any


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


_MARK = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?)(.*?)(-?)#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<string>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<number>\d+)|(?P<name>[A-Za-z]\w*)|(?P<sign>==|!=|<=|>=|[<>+\-*~|.\[\]()=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over the tokens of one mark."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" else None

    def accept(self, *values: str) -> str | None:
        if self.peek() in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def expect(self, value: str) -> None:
        if not self.accept(value):
            raise TemplateError(f"{value!r} expected")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name is expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def whole(self):
        value = self.choice()
        self.end()
        return value

    def choice(self):
        value = self.either()
        if self.accept("if"):
            test = self.either()
            other = self.choice() if self.accept("else") else Constant("")
            return Choice(test, value, other)
        return value

    def either(self):
        value = self.both()
        while self.accept("or"):
            value = Choice(value, value, self.both())
        return value

    def both(self):
        value = self.negation()
        while self.accept("and"):
            value = Choice(value, self.negation(), value)
        return value

    def negation(self):
        return Not(self.negation()) if self.accept("not") else self.comparison()

    def comparison(self):
        value = self.sum()
        while True:
            sign = self.accept("==", "!=", "<", ">", "<=", ">=", "in")
            if not sign and self.peek() == "not" and self.tokens[self.at + 1 : self.at + 2] == [("name", "in")]:
                self.at += 2
                sign = "not in"
            if not sign:
                return value
            value = Operation(sign, value, self.sum())

    def sum(self):
        value = self.product()
        while sign := self.accept("+", "-", "~"):
            value = Operation(sign, value, self.product())
        return value

    def product(self):
        value = self.filtered()
        while sign := self.accept("*"):
            value = Operation(sign, value, self.filtered())
        return value

    def filtered(self):
        value = self.postfix()
        while self.accept("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            value = Filter(value, name)
        return value

    def postfix(self):
        value = self.atom()
        while True:
            if self.accept("."):
                value = Key(value, Constant(self.name()))
            elif self.accept("["):
                value = Key(value, self.choice())
                self.expect("]")
            else:
                return value

    def atom(self):
        if self.accept("("):
            value = self.choice()
            self.expect(")")
            return value
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is expected")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return Constant(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            return Constant(int(text))
        if kind == "name" and text not in ("if", "else", "and", "or", "in", "not"):
            words = {"true": True, "false": False, "none": None}
            return Constant(words[text]) if text in words else Name(text)
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str) -> tuple:
    """Syntax tree of a template."""
    parts: list[tuple[str, str]] = []
    at, trim = 0, False
    for mark in _MARK.finditer(source):
        kind = "expression" if mark[2] is not None else "statement" if mark[5] is not None else "comment"
        left = mark[1] or mark[4] or mark[7]
        text = source[at : mark.start()]
        text = text.lstrip() if trim else text
        parts.append(("text", text.rstrip() if left else text))
        parts.append((kind, mark[2] if kind == "expression" else mark[5] or ""))
        at, trim = mark.end(), bool(mark[3] or mark[6] or mark[9])
    parts.append(("text", source[at:].lstrip() if trim else source[at:]))
    position = 0

    def block(ends: tuple[str, ...]) -> tuple[tuple, str, _Expression | None]:
        """Nodes up to one of the statements ``ends``, which one it was, and what follows its word."""
        nonlocal position
        nodes: list = []
        while position < len(parts):
            kind, text = parts[position]
            position += 1
            if kind == "text":
                nodes.append(Output(Constant(text)))
            elif kind == "expression":
                nodes.append(Output(_Expression(text).whole()))
            elif kind == "statement":
                reader = _Expression(text)
                word = reader.name()
                if word in ends:
                    return tuple(nodes), word, reader
                nodes.append(statement(word, reader))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return tuple(nodes), "", None

    def statement(word: str, reader: _Expression):
        if word == "if":
            test = reader.whole()
            then, end, following = block(("elif", "else", "endif"))
            if end == "elif":
                return If(test, then, (statement("if", following),))
            return If(test, then, block(("endif",))[0] if end == "else" else ())
        if word == "for":
            name = reader.name()
            reader.expect("in")
            return For(name, reader.whole(), block(("endfor",))[0])
        if word == "set":
            name = reader.name()
            reader.expect("=")
            return Set(name, reader.whole())
        if word == "generation":
            reader.end()
            return Generation(block(("endgeneration",))[0])
        raise TemplateError(f"unknown statement {word!r}")

    return block(())[0]


# --- constant folding -------------------------------------------------------------------------------


def fold(node):
    """The same tree with everything that is known beforehand worked out."""
    if isinstance(node, tuple):
        out: list = []
        for item in map(fold, node):
            for piece in item if isinstance(item, tuple) else (item,):
                text = isinstance(piece, Output) and isinstance(piece.value, Constant)
                if text and out and isinstance(out[-1], Output) and isinstance(out[-1].value, Constant):
                    out[-1] = Output(Constant(_text(out[-1].value.value) + _text(piece.value.value)))
                elif not (text and not _text(piece.value.value)):
                    out.append(piece)
        return tuple(out)
    if isinstance(node, If):
        test = fold(node.test)
        if isinstance(test, Constant):
            return fold(node.then if test.value else node.other)
        return If(test, fold(node.then), fold(node.other))
    if isinstance(node, Choice):
        test = fold(node.test)
        if isinstance(test, Constant):
            return fold(node.then if test.value else node.other)
        return Choice(test, fold(node.then), fold(node.other))
    if isinstance(node, (Constant, Name)):
        return node
    node = replace(node, **{f: fold(getattr(node, f)) for f in node.__dataclass_fields__ if f not in ("name", "sign")})
    if isinstance(node, Filter) and isinstance(node.of, Constant):
        return Constant(FILTERS[node.name](node.of.value))
    if isinstance(node, Not) and isinstance(node.of, Constant):
        return Constant(not node.of.value)
    if isinstance(node, Operation) and isinstance(node.left, Constant) and isinstance(node.right, Constant):
        return Constant(_OPERATIONS[node.sign](node.left.value, node.right.value))
    return node


def names_in(node) -> set[str]:
    """Free and bound names that occur in a tree."""
    if isinstance(node, tuple):
        return set().union(*map(names_in, node)) if node else set()
    if isinstance(node, Name):
        return {node.name}
    if hasattr(node, "__dataclass_fields__") and not isinstance(node, Constant):
        inner = [names_in(getattr(node, f)) for f in node.__dataclass_fields__ if not isinstance(getattr(node, f), str)]
        return set().union(*inner)
    return set()


# --- closures ---------------------------------------------------------------------------------------


class Sink:
    """What a template writes, and which stretches of it are generated."""

    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.marks: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def value_of(node) -> Callable[[dict], Any]:
    """Closure that works an expression out for the names it is given."""
    if isinstance(node, Constant):
        return lambda names, v=node.value: v
    if isinstance(node, Name):
        return lambda names, n=node.name: names.get(n)
    if isinstance(node, Key):
        of, key = value_of(node.of), value_of(node.key)

        def look(names):
            record, at = of(names), key(names)
            if isinstance(record, dict):
                return record.get(at)
            if isinstance(record, (list, tuple, str)) and isinstance(at, int):
                return record[at] if -len(record) <= at < len(record) else None
            return None

        return look
    if isinstance(node, Filter):
        of, apply = value_of(node.of), FILTERS[node.name]
        return lambda names: apply(_none_as_empty(of(names)))
    if isinstance(node, Not):
        of = value_of(node.of)
        return lambda names: not of(names)
    if isinstance(node, Choice):
        test, then, other = value_of(node.test), value_of(node.then), value_of(node.other)
        return lambda names: then(names) if test(names) else other(names)
    left, right, apply = value_of(node.left), value_of(node.right), _OPERATIONS[node.sign]
    return lambda names: apply(left(names), right(names))


def _none_as_empty(value: Any) -> Any:
    return "" if value is None else value


def writer_of(node) -> Callable[[dict, Sink], None]:
    """Closure that writes a tree to a sink."""
    if isinstance(node, tuple):
        steps = [writer_of(n) for n in node]

        def run(names, sink):
            for step in steps:
                step(names, sink)

        return run
    if isinstance(node, Output):
        if isinstance(node.value, Constant):
            return lambda names, sink, t=_text(node.value.value): sink.write(t)
        value = value_of(node.value)
        return lambda names, sink: sink.write(_text(value(names)))
    if isinstance(node, If):
        test, then, other = value_of(node.test), writer_of(node.then), writer_of(node.other)
        return lambda names, sink: then(names, sink) if test(names) else other(names, sink)
    if isinstance(node, Set):
        value, name = value_of(node.value), node.name

        def assign(names, sink):
            names[name] = value(names)

        return assign
    if isinstance(node, Generation):
        body = writer_of(node.body)

        def generate(names, sink):
            start = sink.length
            body(names, sink)
            if sink.length > start:
                sink.marks.append((start, sink.length))

        return generate
    over, body, name = value_of(node.over), writer_of(node.body), node.name

    def loop(names, sink):
        items = list(over(names) or ())
        for n, item in enumerate(items):
            body({**names, name: item, "loop": loop_record(n, n == len(items) - 1)}, sink)

    return loop


def loop_record(n: int, last: bool) -> dict:
    return {"index0": n, "index": n + 1, "first": n == 0, "last": last}


class Template:
    """A compiled template. ``per_turn``: its one loop over the messages can be run for each message on its own."""

    def __init__(self, source: str, messages: str = "messages"):
        self.tree = fold(parse(source))
        self.write = writer_of(self.tree)
        self.messages = messages
        loops = [n for n, node in enumerate(self.tree) if isinstance(node, For) and node.over == Name(messages)]
        self.per_turn = False
        if len(loops) == 1:
            head, loop, tail = self.tree[: loops[0]], self.tree[loops[0]], self.tree[loops[0] + 1 :]
            outside = (*head, *tail)
            self.per_turn = messages not in names_in((*outside, *loop.body)) and not any(isinstance(n, Set) for n in outside)
            self.head, self.body, self.tail, self.item = writer_of(head), writer_of(loop.body), writer_of(tail), loop.name
            # Whether a turn's text depends on its place.
            self.placed = bool(outside) or "loop" in names_in(loop.body)

    def render(self, messages: list[dict], **names: Any) -> tuple[str, list[tuple[int, int]]]:
        """Text of a whole conversation and the stretches of it that are generated."""
        sink = Sink()
        self.write({**names, self.messages: messages}, sink)
        return "".join(sink.parts), sink.marks

    def render_turn(self, message: dict, n: int = 0, last: bool = False) -> tuple[str, list[tuple[int, int]]]:
        """What the n-th message adds to the text of its conversation, and the generated stretches in that."""
        sink = Sink()
        if n == 0:
            self.head({}, sink)
        self.body({self.item: message, "loop": loop_record(n, last)}, sink)
        if last:
            self.tail({}, sink)
        return "".join(sink.parts), sink.marks
