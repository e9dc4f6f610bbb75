"""A small sandboxed template language, compiled to Python closures.

`{{ expression }}` prints; `{% for x in e %} .. {% endfor %}`,
`{% if e %} .. {% elif e %} .. {% else %} .. {% endif %}`, `{% set x = e %}` and
`{% generation %} .. {% endgeneration %}` (text under the loss mask) are the
statements.  Expressions have literals, names, `a.b` and `a[b]` on mappings,
lists and texts, filters (`x | escape`), `not`, `and`, `or`, comparisons, `in`,
`+`, `-`, `~`.  There are no calls and no Python attributes: a template reaches
only what it is given.

A template is parsed to a syntax tree, constants are folded (neighbouring
texts join, branches on constants go), and each node becomes a generator closure.
Loops take any iterator one item at a time, so a conversation of any length is
rendered in bounded memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Node:
    kind: str
    value: Any = None
    parts: tuple = ()


_BLOCKS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
_TOKENS = re.compile(r"""\s*(?:(?P<str>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<int>\d+)"""
                     r"""|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~|.\[\]()<>]))""", re.S)
_WORDS = {"and", "or", "not", "in", "true", "false", "none"}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}

# -- parsing ------------------------------------------------------------------------------------


class _Expression:
    """Recursive descent over one expression's tokens; lowest precedence first."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:at + 20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def whole(self) -> Node:
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def take(self, *texts: str) -> str | None:
        if self.at < len(self.tokens):
            kind, text = self.tokens[self.at]
            if text in texts and kind in ("op", "name"):
                self.at += 1
                return text
        return None

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def binary(self, below: Callable[[], Node], *ops: str) -> Node:
        node = below()
        while op := self.take(*ops):
            node = Node("binary", op, (node, below()))
        return node

    def either(self) -> Node:
        return self.binary(self.both, "or")

    def both(self) -> Node:
        return self.binary(self.negated, "and")

    def negated(self) -> Node:
        return Node("not", None, (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Node:
        return self.binary(self.summed, "==", "!=", "<=", ">=", "<", ">", "in")

    def summed(self) -> Node:
        return self.binary(self.filtered, "+", "-", "~")

    def filtered(self) -> Node:
        node = self.reached()
        while self.take("|"):
            node = Node("filter", self.name(), (node,))
        return node

    def reached(self) -> Node:
        node = self.atom()
        while op := self.take(".", "["):
            if op == ".":
                node = Node("item", None, (node, Node("const", self.name())))
            else:
                node = Node("item", None, (node, self.either()))
                self.need("]")
        return node

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} is missing")

    def atom(self) -> Node:
        if self.take("("):
            node = self.either()
            self.need(")")
            return node
        if self.at == len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return Node("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "int":
            return Node("const", int(text))
        if kind == "name" and text not in _WORDS:
            return Node("name", text)
        if text in ("true", "false", "none"):
            return Node("const", {"true": True, "false": False, "none": None}[text])
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str) -> Node:
    """The syntax tree of a template."""
    pieces = [p for p in _BLOCKS.split(source) if p]
    node, at, _ = _body(pieces, 0, ())
    return node


def _body(pieces: list[str], at: int, until: tuple[str, ...]) -> tuple[Node, int, str]:
    """Nodes up to a statement that starts with a word of ``until``: (node, place behind it, statement)."""
    out = []
    while at < len(pieces):
        piece = pieces[at]
        at += 1
        if piece.startswith("{{"):
            out.append(Node("print", None, (_Expression(piece[2:-2]).whole(),)))
        elif piece.startswith("{%"):
            inner = piece[2:-2].strip().strip("-").strip()
            word, _, rest = inner.partition(" ")
            if word in until:
                return Node("body", None, tuple(out)), at, inner
            node, at = _statement(word, rest, pieces, at)
            out.append(node)
        else:
            out.append(Node("text", piece))
    if until:
        raise TemplateError(f"{until[-1]} is missing")
    return Node("body", None, tuple(out)), at, ""


def _statement(word: str, rest: str, pieces: list[str], at: int) -> tuple[Node, int]:
    if word == "for":
        name, _, source = rest.partition(" in ")
        if not name.strip().isidentifier():
            raise TemplateError(f"can't loop over {rest!r}")
        body, at, _ = _body(pieces, at, ("endfor",))
        return Node("for", name.strip(), (_Expression(source).whole(), body)), at
    if word == "if":
        body, at, end = _body(pieces, at, ("elif", "else", "endif"))
        other = Node("body")
        if end.startswith("elif"):
            other, at = _statement("if", end[4:], pieces, at)
        elif end == "else":
            other, at, _ = _body(pieces, at, ("endif",))
        return Node("if", None, (_Expression(rest).whole(), body, other)), at
    if word == "set":
        name, eq, source = rest.partition("=")
        if not eq or not name.strip().isidentifier():
            raise TemplateError(f"can't set {rest!r}")
        return Node("set", name.strip(), (_Expression(source).whole(),)), at
    if word == "generation":
        body, at, _ = _body(pieces, at, ("endgeneration",))
        return Node("generation", None, (body,)), at
    raise TemplateError(f"unknown statement {word!r}")


# -- folding ------------------------------------------------------------------------------------


def fold(node: Node) -> Node:
    """The same template with constants computed."""
    parts = tuple(fold(p) for p in node.parts)
    node = Node(node.kind, node.value, parts)
    if node.kind in ("binary", "not", "item") and all(p.kind == "const" for p in parts):
        return Node("const", _value(node)({}, {}))
    if node.kind == "binary" and node.value in ("and", "or") and parts[0].kind == "const":
        return parts[0] if bool(parts[0].value) == (node.value == "or") else parts[1]
    if node.kind == "print" and parts[0].kind == "const":
        return Node("text", _shown(parts[0].value))
    if node.kind == "if" and parts[0].kind == "const":
        return parts[1] if parts[0].value else parts[2]
    if node.kind == "body":
        out: list[Node] = []
        for p in (q for p in parts for q in (p.parts if p.kind == "body" else (p,))):
            if p.kind == "text" and out and out[-1].kind == "text":
                out[-1] = Node("text", out[-1].value + p.value)
            elif p.kind != "text" or p.value:
                out.append(p)
        return Node("body", None, tuple(out))
    return node


# -- closures -----------------------------------------------------------------------------------

Piece = tuple[str, bool]        # text, and whether it is under the loss mask


def _shown(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _item(value, key):
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, (list, tuple, str)) and isinstance(key, int) and not isinstance(key, bool):
        return value[key] if -len(value) <= key < len(value) else None
    raise TemplateError(f"no {key!r} in a {type(value).__name__}")


_BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
    "+": lambda a, b: a + b, "-": lambda a, b: a - b, "~": lambda a, b: _shown(a) + _shown(b),
}
FILTERS: dict[str, Callable] = {
    "trim": lambda x: _shown(x).strip(), "upper": lambda x: _shown(x).upper(),
    "lower": lambda x: _shown(x).lower(), "length": len,
}


def _value(node: Node) -> Callable[[dict, dict], Any]:
    """An expression as a closure of (names, filters)."""
    if node.kind == "const":
        constant = node.value
        return lambda names, filters: constant
    if node.kind == "name":
        key = node.value
        return lambda names, filters: names.get(key)
    inner = [_value(p) for p in node.parts]
    if node.kind == "not":
        return lambda names, filters: not inner[0](names, filters)
    if node.kind == "item":
        return lambda names, filters: _item(inner[0](names, filters), inner[1](names, filters))
    if node.kind == "filter":
        name = node.value
        return lambda names, filters: filters[name](inner[0](names, filters))
    left, right = inner
    if node.value == "and":
        return lambda names, filters: left(names, filters) and right(names, filters)
    if node.value == "or":
        return lambda names, filters: left(names, filters) or right(names, filters)
    op = _BINARY[node.value]
    return lambda names, filters: op(left(names, filters), right(names, filters))


def _pieces(node: Node, loss: bool) -> Callable[[dict, dict], Iterator[Piece]]:
    """A statement as a closure that generates pieces."""
    if node.kind == "text":
        piece = (node.value, loss)

        def run(names, filters):
            yield piece
    elif node.kind == "print":
        value = _value(node.parts[0])

        def run(names, filters):
            yield _shown(value(names, filters)), loss
    elif node.kind == "set":
        value = _value(node.parts[0])

        def run(names, filters):
            names[node.value] = value(names, filters)
            return
            yield
    elif node.kind == "generation":
        return _pieces(node.parts[0], True)
    elif node.kind == "if":
        test, yes, no = _value(node.parts[0]), _pieces(node.parts[1], loss), _pieces(node.parts[2], loss)

        def run(names, filters):
            yield from (yes if test(names, filters) else no)(names, filters)
    elif node.kind == "for":
        source, body = _value(node.parts[0]), _pieces(node.parts[1], loss)

        def run(names, filters):
            items = iter(source(names, filters) or ())
            item, index = next(items, _END), 0
            while item is not _END:
                following = next(items, _END)
                loop = {"index": index + 1, "index0": index, "first": index == 0, "last": following is _END}
                inner = {**names, node.value: item, "loop": loop}
                yield from body(inner, filters)
                item, index = following, index + 1
    else:
        steps = [_pieces(p, loss) for p in node.parts]

        def run(names, filters):
            for step in steps:
                yield from step(names, filters)
    return run


_END = object()


def _filters_of(node: Node) -> set[str]:
    return ({node.value} if node.kind == "filter" else set()).union(*map(_filters_of, node.parts))


class Template:
    """A compiled template; filters besides the standard ones are given."""

    def __init__(self, source: str, filters: dict[str, Callable] | None = None):
        self.tree = fold(parse(source))
        self.filters = FILTERS | (filters or {})
        if unknown := _filters_of(self.tree) - set(self.filters):
            raise TemplateError(f"unknown filters {sorted(unknown)}")
        self.run = _pieces(self.tree, False)

    def stream(self, **names) -> Iterator[Piece]:
        """Pieces of the output in order, as the loops go on."""
        return self.run(dict(names), self.filters)

    def render(self, **names) -> tuple[str, list[tuple[int, int]]]:
        """The output, and its spans under the loss mask (code points)."""
        out, spans, at = [], [], 0
        for text, loss in self.stream(**names):
            if loss and text:
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + len(text))
                else:
                    spans.append((at, at + len(text)))
            out.append(text)
            at += len(text)
        return "".join(out), spans
