"""A small sandboxed template language, compiled to Python closures.

A template is text with ``{{ expression }}`` and ``{% statement %}``: ``for x in list`` / ``endfor`` (with ``loop.index``,
``index0``, ``first``, ``last``), ``if`` / ``elif`` / ``else`` / ``endif``, ``set name = expression``, and ``generation`` /
``endgeneration``, whose output is marked as written by the model. Expressions know strings, integers, ``true``, ``false``,
``none``, names, ``.key`` and ``['key']``, ``+ - * % ~``, comparisons, ``in``, ``and``, ``or``, ``not``, ``a if c else b``
and filters. There are no calls, no attributes of Python objects and no names but the given ones, so a template can read
its input and nothing else. ``{%-`` and ``-%}`` trim white space next to them.

Source goes to a syntax tree, constants are folded in the tree (operations on constants, branches on constant conditions,
neighbouring text), and the tree becomes closures.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

MARKUP = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
TOKEN = re.compile(r"""\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+*%~<>().\[\]|,]))""", re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}


class TemplateError(ValueError):
    """A template that cannot be read, or reaches for what it may not."""


# --- syntax tree --------------------------------------------------------------------------------------------------------


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
    sign: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- values -------------------------------------------------------------------------------------------------------------


def text_of(value: Any) -> str:
    return "" if value is None else {True: "true", False: "false"}[value] if isinstance(value, bool) else str(value)


def _number(sign: str, f: Callable[[Any, Any], Any]) -> Callable[[Any, Any], Any]:
    def run(a, b):
        if not all(isinstance(x, int) for x in (a, b)) and not (sign == "+" and isinstance(a, str) and isinstance(b, str)):
            raise TemplateError(f"{sign} of {type(a).__name__} and {type(b).__name__}")
        return f(a, b)

    return run


OPERATIONS: dict[str, Callable] = {
    "+": _number("+", lambda a, b: a + b), "-": _number("-", lambda a, b: a - b), "*": _number("*", lambda a, b: a * b), "%": _number("%", lambda a, b: a % b),
    "~": lambda a, b: text_of(a) + text_of(b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "not": lambda a: not a,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda v: text_of(v).strip(), "upper": lambda v: text_of(v).upper(), "lower": lambda v: text_of(v).lower(), "length": len,
    "default": lambda v, d: d if v is None else v, "string": text_of,
}


# --- parsing ------------------------------------------------------------------------------------------------------------


class _Expression:
    def __init__(self, source: str):
        self.source, self.tokens, at = source, [], 0
        source = source.strip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            number, string, name, sign = m.groups()
            if number:
                self.tokens.append(("value", int(number)))
            elif string:
                self.tokens.append(("value", re.sub(r"\\(.)", lambda e: ESCAPES.get(e[1], e[0]), string[1:-1], flags=re.S)))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
            at = m.end()
        self.at = 0

    def peek(self, *words: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "value" and self.tokens[self.at][1] in words

    def take(self, *words: str) -> bool:
        found = self.peek(*words)
        self.at += found
        return found

    def need(self, kind: str, word: str | None = None) -> Any:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind or word not in (None, self.tokens[self.at][1]):
            raise TemplateError(f"expected {word or kind} in {self.source!r}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> Any:
        node = self.choice()
        if self.at != len(self.tokens):
            raise TemplateError(f"too much in {self.source!r}")
        return node

    def choice(self) -> Any:
        node = self.either()
        if self.take("if"):
            test = self.either()
            self.need("name", "else")
            return Op("if", (test, node, self.choice()))
        return node

    def either(self) -> Any:
        node = self.both()
        while self.take("or"):
            node = Op("or", (node, self.both()))
        return node

    def both(self) -> Any:
        node = self.negation()
        while self.take("and"):
            node = Op("and", (node, self.negation()))
        return node

    def negation(self) -> Any:
        return Op("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self) -> Any:
        node = self.sum()
        while self.peek("==", "!=", "<", ">", "<=", ">=", "in", "not"):
            if self.take("not"):
                self.need("name", "in")
                node = Op("not", (Op("in", (node, self.sum())),))
            else:
                sign = self.tokens[self.at][1]
                self.at += 1
                node = Op(sign, (node, self.sum()))
        return node

    def sum(self) -> Any:
        node = self.product()
        while self.peek("+", "-", "~"):
            sign = self.tokens[self.at][1]
            self.at += 1
            node = Op(sign, (node, self.product()))
        return node

    def product(self) -> Any:
        node = self.filtered()
        while self.peek("*", "%"):
            sign = self.tokens[self.at][1]
            self.at += 1
            node = Op(sign, (node, self.filtered()))
        return node

    def filtered(self) -> Any:
        node = self.single()
        while self.take("|"):
            name, args = self.need("name"), [node]
            if self.take("("):
                args.append(self.choice())
                while self.take(","):
                    args.append(self.choice())
                self.need("sign", ")")
            node = Filter(name, tuple(args))
        return node

    def single(self) -> Any:
        if self.take("("):
            node = self.choice()
            self.need("sign", ")")
        elif self.at < len(self.tokens) and self.tokens[self.at][0] == "value":
            node = Const(self.need("value"))
        else:
            name = self.need("name")
            node = Const({"true": True, "false": False, "none": None}[name]) if name in ("true", "false", "none") else Name(name)
        while self.peek(".", "["):
            if self.take("."):
                node = Item(node, Const(self.need("name")))
            else:
                self.take("[")
                node = Item(node, self.choice())
                self.need("sign", "]")
        return node


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts: list[tuple[str, str]] = []
    at, trim = 0, False
    for m in MARKUP.finditer(source):
        text = source[at : m.start()]
        text = text.lstrip() if trim else text
        parts.append(("text", text.rstrip() if m[0][2] == "-" else text))
        trim = m[0][-3] == "-"
        if m[1] is not None:
            parts.append(("out", m[1]))
        elif m[2] is not None:
            parts.append(("do", m[2].strip()))
        at = m.end()
    parts.append(("text", source[at:].lstrip() if trim else source[at:]))
    place = 0

    def body(*ends: str) -> tuple[tuple, str]:
        nonlocal place
        nodes: list = []
        while place < len(parts):
            kind, text = parts[place]
            place += 1
            if kind == "text":
                nodes.append(Output(Const(text)))
            elif kind == "out":
                nodes.append(Output(_Expression(text).whole()))
            else:
                word, _, rest = text.partition(" ")
                if word in ends:
                    return tuple(nodes), text
                nodes.append(statement(word, rest))
        if ends:
            raise TemplateError(f"no {' or '.join(ends)}")
        return tuple(nodes), ""

    def statement(word: str, rest: str) -> Any:
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"can't read for {rest!r}")
            return For(m[1], _Expression(m[2]).whole(), body("endfor")[0])
        if word == "if":
            test = _Expression(rest).whole()
            then, end = body("elif", "else", "endif")
            if end.startswith("elif"):
                return If(test, then, (statement("if", end[4:]),))
            return If(test, then, body("endif")[0] if end == "else" else ())
        if word == "set":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"can't read set {rest!r}")
            return Set(m[1], _Expression(m[2]).whole())
        if word == "generation":
            return Generation(body("endgeneration")[0])
        raise TemplateError(f"unknown statement {word!r}")

    return body()[0]


# --- constant folding ---------------------------------------------------------------------------------------------------


def fold(node: Any, filters: dict[str, Callable]) -> Any:
    """The node with everything worked out that does not depend on the input."""
    if isinstance(node, Op):
        args = tuple(fold(a, filters) for a in node.args)
        if node.sign == "if" and isinstance(args[0], Const):
            return args[1] if args[0].value else args[2]
        if node.sign in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.sign == "and") else args[0]
        if node.sign in OPERATIONS and all(isinstance(a, Const) for a in args):
            return Const(OPERATIONS[node.sign](*(a.value for a in args)))
        return Op(node.sign, args)
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"unknown filter {node.name!r}")
        args = tuple(fold(a, filters) for a in node.args)
        return Const(filters[node.name](*(a.value for a in args))) if all(isinstance(a, Const) for a in args) else Filter(node.name, args)
    if isinstance(node, Item):
        return Item(fold(node.of, filters), fold(node.key, filters))
    if isinstance(node, Output):
        value = fold(node.value, filters)
        return Output(Const(text_of(value.value)) if isinstance(value, Const) else value)
    if isinstance(node, Set):
        return Set(node.name, fold(node.value, filters))
    if isinstance(node, For):
        return For(node.name, fold(node.over, filters), fold_all(node.body, filters))
    if isinstance(node, Generation):
        return Generation(fold_all(node.body, filters))
    if isinstance(node, If):
        return If(fold(node.test, filters), fold_all(node.then, filters), fold_all(node.other, filters))
    return node


def fold_all(nodes: Iterable, filters: dict[str, Callable]) -> tuple:
    out: list = []

    def add(node: Any) -> None:
        if isinstance(node, If) and isinstance(node.test, Const):
            for n in node.then if node.test.value else node.other:
                add(n)
        elif isinstance(node, Output) and isinstance(node.value, Const):
            if node.value.value and out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                out[-1] = Output(Const(out[-1].value.value + node.value.value))
            elif node.value.value:
                out.append(node)
        else:
            out.append(node)

    for n in nodes:
        add(fold(n, filters))
    return tuple(out)


# --- closures -----------------------------------------------------------------------------------------------------------

Env = dict[str, Any]
Piece = tuple[str, bool]  # output, and whether it is the model's


def value_closure(node: Any, filters: dict[str, Callable]) -> Callable[[Env], Any]:
    if isinstance(node, Const):
        value = node.value
        return lambda env: value
    if isinstance(node, Name):
        name = node.name

        def lookup(env):
            if name not in env:
                raise TemplateError(f"unknown name {name!r}")
            return env[name]

        return lookup
    if isinstance(node, Item):
        of, key = value_closure(node.of, filters), value_closure(node.key, filters)

        def item(env):
            whole, k = of(env), key(env)
            if isinstance(whole, dict):
                return whole.get(k)
            if isinstance(whole, (list, tuple)) and isinstance(k, int) and not isinstance(k, bool):
                return whole[k]
            raise TemplateError(f"no item {k!r} of {type(whole).__name__}")

        return item
    args = [value_closure(a, filters) for a in node.args]
    if isinstance(node, Filter):
        apply = filters[node.name]
        if len(args) == 1:
            only = args[0]
            return lambda env: apply(only(env))
        return lambda env: apply(*(a(env) for a in args))
    if node.sign == "if":
        test, then, other = args
        return lambda env: then(env) if test(env) else other(env)
    if node.sign == "and":
        a, b = args
        return lambda env: a(env) and b(env)
    if node.sign == "or":
        a, b = args
        return lambda env: a(env) or b(env)
    apply = OPERATIONS[node.sign]
    if len(args) == 1:
        a = args[0]
        return lambda env: apply(a(env))
    a, b = args
    return lambda env: apply(a(env), b(env))


def closure(nodes: tuple, filters: dict[str, Callable], marked: bool = False) -> Callable[[Env, list[Piece]], None]:
    steps = [_step(n, filters, marked) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(env, out):
        for s in steps:
            s(env, out)

    return run


def _step(node: Any, filters: dict[str, Callable], marked: bool) -> Callable[[Env, list[Piece]], None]:
    if isinstance(node, Output):
        if isinstance(node.value, Const):
            piece = (node.value.value, marked)
            return lambda env, out: out.append(piece)
        value = value_closure(node.value, filters)
        return lambda env, out: out.append((text_of(value(env)), marked))
    if isinstance(node, Generation):
        return closure(node.body, filters, True)
    if isinstance(node, If):
        test, then, other = value_closure(node.test, filters), closure(node.then, filters, marked), closure(node.other, filters, marked)
        return lambda env, out: then(env, out) if test(env) else other(env, out)
    value = value_closure(node.value if isinstance(node, Set) else node.over, filters)
    name = node.name
    if isinstance(node, Set):

        def assign(env, out):
            env[name] = value(env)

        return assign
    body = closure(node.body, filters, marked)

    def loop(env, out):
        rows = value(env)
        if not isinstance(rows, (list, tuple)):
            raise TemplateError("for needs a list")
        for i, row in enumerate(rows):
            body({**env, name: row, "loop": loop_facts(i, i == len(rows) - 1)}, out)

    return loop


def loop_facts(i: int, last: bool) -> dict[str, Any]:
    return {"index0": i, "index": i + 1, "first": i == 0, "last": last}


class Template:
    """A compiled template. ``names`` are the values it may read besides ``messages``."""

    def __init__(self, source: str, filters: dict[str, Callable] | None = None, names: Env | None = None):
        self.filters, self.names = {**FILTERS, **(filters or {})}, dict(names or {})
        self.tree = fold_all(parse(source), self.filters)
        self.run = closure(self.tree, self.filters)
        self._by_turn()

    def _by_turn(self) -> None:
        """What comes before, for and after each message, if the template is one loop over ``messages`` that reads nothing
        but the message at hand; else ``turn`` is None."""
        self.turn = None
        loops = [i for i, n in enumerate(self.tree) if isinstance(n, For) and n.over == Name("messages")]
        if len(loops) == 1 and not _names(tuple(n for i, n in enumerate(self.tree) if i != loops[0]) + self.tree[loops[0]].body) & {"messages"}:
            at = loops[0]
            if not any(isinstance(n, Set) for n in self.tree):
                self.name = self.tree[at].name
                self.head, self.turn, self.tail = (closure(t, self.filters) for t in (self.tree[:at], self.tree[at].body, self.tree[at + 1 :]))

    def render(self, messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        """The text and the stretches of it that the model wrote."""
        out: list[Piece] = []
        self.run({**self.names, "messages": messages}, out)
        return join(out)

    def render_turn(self, message: dict, index: int, last: bool) -> list[Piece]:
        """The pieces of one message in its place, with what stands before the first and after the last one."""
        if self.turn is None:
            raise TemplateError("the template is not a single loop over the messages")
        out: list[Piece] = []
        if index == 0:
            self.head(dict(self.names), out)
        self.turn({**self.names, self.name: message, "loop": loop_facts(index, last)}, out)
        if last:
            self.tail(dict(self.names), out)
        return out


def _names(nodes: Any) -> set[str]:
    if isinstance(nodes, Name):
        return {nodes.name}
    if isinstance(nodes, tuple):
        return set().union(*(_names(n) for n in nodes)) if nodes else set()
    return _names(tuple(vars(nodes).values())) if hasattr(nodes, "__dataclass_fields__") else set()


def join(pieces: Iterable[Piece]) -> tuple[str, list[tuple[int, int]]]:
    """Pieces to a text and its marked stretches; an empty marked piece is a stretch too, so every message keeps its own."""
    texts, spans, at = [], [], 0
    for text, marked in pieces:
        if marked:
            spans.append((at, at + len(text)))
        texts.append(text)
        at += len(text)
    return "".join(texts), spans


