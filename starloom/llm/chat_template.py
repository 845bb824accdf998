"""A small template language for conversations: parsed to a tree, folded, compiled to Python closures.

Text stands for itself.  ``{{ expr }}`` writes a value; ``{% for m in messages %} .. {% endfor %}`` runs
over the turns; ``{% if e %} .. {% elif e %} .. {% else %} .. {% endif %}`` chooses;
``{% generation %} .. {% endgeneration %}`` marks what a model is trained to write.  A dash inside a
tag (``{%-``, ``-%}``) strips white space on that side.  Expressions know strings, whole numbers, true,
false, the loop's variable with ``.role`` and ``.text``, ``loop.index``, ``loop.index0``, ``loop.first``,
``loop.last``, constants given to ``compile_template``, ``+ == != in not and or``, brackets and the
filters ``escape trim upper lower length``.

Nothing else can be named: there are no calls, no attributes of Python objects and no other variables,
and a fault shows when the template is compiled.  There is one loop, at the top, so a conversation is
rendered turn by turn and never held whole.

``Escape`` keeps control strings out of texts: behind the first character of a control string, and of
one that is already escaped, one more backslash is put, which ``undo`` takes away.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any


class TemplateError(ValueError):
    """A template that this language does not have."""


class Escape:
    """A reversible escape of control strings.

    No control string may hold the first character of any but at its own beginning, so that they cannot
    overlap and none can arise where a text meets the template.
    """

    def __init__(self, controls: Iterable[str]) -> None:
        self.controls = tuple(controls)
        first = {c[:1] for c in self.controls}
        if not self.controls or any(len(c) < 2 or c[1] == "\\" or c[0] == "\\" or first & set(c[1:]) for c in self.controls):
            raise TemplateError("control strings need two characters or more, and a first one that no other place of any holds")
        by_first: dict[str, list[str]] = {}
        for c in sorted(self.controls, key=len, reverse=True):
            by_first.setdefault(c[0], []).append(re.escape(c[1:]))
        shape = lambda marks: re.compile("|".join(rf"(?<={re.escape(a)}){marks}(?={'|'.join(rest)})" for a, rest in by_first.items()))
        self._bare, self._marked = shape(r"\\*"), shape(r"\\+")
        self.find = re.compile("|".join(map(re.escape, sorted(self.controls, key=len, reverse=True)))).finditer

    def apply(self, text: str) -> str:
        return self._bare.sub(lambda m: m[0] + "\\", text)

    def undo(self, text: str) -> str:
        return self._marked.sub(lambda m: m[0][1:], text)


# The tree.


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Field:
    """``m.role`` or ``loop.first``."""

    of: str
    name: str


@dataclass(frozen=True)
class Op:
    """An operator or filter on one or two operands."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Put:
    value: Any


@dataclass(frozen=True)
class Choice:
    """The first branch whose condition holds."""

    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class Marked:
    body: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    body: tuple


TURN_FIELDS = ("role", "text")
LOOP_FIELDS = ("index", "index0", "first", "last")
FILTERS = ("escape", "trim", "upper", "lower", "length")

_TAG = re.compile(r"(\{\{-?|\{%-?)(.*?)(-?\}\}|-?%\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[()|+.\[\]]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t"}


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at, source = [], 0, source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str, turn: str | None, constants: dict[str, Any]) -> None:
        self.tokens, self.at, self.turn, self.constants = _tokens(source), 0, turn, constants

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing")

    def whole(self) -> Any:
        got = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return got

    def either(self) -> Any:
        left = self.both()
        while self.take("or"):
            left = Op("or", (left, self.both()))
        return left

    def both(self) -> Any:
        left = self.negated()
        while self.take("and"):
            left = Op("and", (left, self.negated()))
        return left

    def negated(self) -> Any:
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        left = self.added()
        while sign := self.take("==", "!=", "in"):
            left = Op(sign, (left, self.added()))
        return left

    def added(self) -> Any:
        left = self.filtered()
        while self.take("+"):
            left = Op("+", (left, self.filtered()))
        return left

    def filtered(self) -> Any:
        got = self.atom()
        while self.take("|"):
            name = self.peek()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            got = Op(name, (got,))
        return got

    def atom(self) -> Any:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(value))
        if value == "(":
            got = self.either()
            self.need(")")
            return got
        if value in ("true", "false"):
            return Const(value == "true")
        if value in self.constants:
            return Const(self.constants[value])
        if kind == "name" and value in (self.turn, "loop") and self.turn:
            if self.take("["):
                field_kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
                self.at += 1
                self.need("]")
                name = name[1:-1] if field_kind == "string" else ""
            else:
                self.need(".")
                name = self.peek() or ""
                self.at += 1
            if name not in (LOOP_FIELDS if value == "loop" else TURN_FIELDS):
                raise TemplateError(f"no field {value}.{name}")
            return Field("loop" if value == "loop" else "turn", name)
        raise TemplateError(f"nothing is named {value!r} here")


def parse(source: str, constants: dict[str, Any] | None = None) -> tuple:
    """The tree of a template."""
    pieces, at, strip = [], 0, False
    for m in _TAG.finditer(source):
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        pieces.append(("text", text.rstrip() if m[1].endswith("-") else text))
        if (m[1][:2] == "{{") != (m[3][-2:] == "}}"):
            raise TemplateError(f"tag closed wrongly: {m[0]!r}")
        pieces.append(("put" if m[1][:2] == "{{" else "do", m[2].strip()))
        strip, at = m[3].startswith("-"), m.end()
    pieces.append(("text", source[at:].lstrip() if strip else source[at:]))
    if any(k == "text" and re.search(r"\{\{|\{%", v) for k, v in pieces):
        raise TemplateError("a tag is not closed")
    tree, rest = _block(pieces, 0, (), None, constants or {}, 0)
    assert rest == len(pieces)
    if sum(isinstance(n, Loop) for n in tree) > 1:
        raise TemplateError("only one loop over messages: turns pass once")
    return tree


def _block(pieces: list, at: int, ends: tuple[str, ...], turn: str | None, constants: dict, depth: int) -> tuple[tuple, int]:
    """Nodes up to one of the closing words, and the place of the tag that holds it."""
    out: list = []
    expression = lambda s: _Expression(s, turn, constants).whole()
    while at < len(pieces):
        kind, value = pieces[at]
        if kind == "text":
            out += [Put(Const(value))] if value else []
        elif kind == "put":
            out.append(Put(expression(value)))
        else:
            word, _, tail = value.partition(" ")
            if word in ends:
                return tuple(out), at
            if word == "generation" and not tail:
                body, at = _block(pieces, at + 1, ("endgeneration",), turn, constants, depth + 1)
                if any(isinstance(n, Marked) for n in _nodes(body)):
                    raise TemplateError("generation inside generation")
                out.append(Marked(body))
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", tail.strip())
                if not m or turn or depth or m[1] in ("loop", "messages", "true", "false", *constants):
                    raise TemplateError(f"loops run over messages, at the top: {value!r}")
                body, at = _block(pieces, at + 1, ("endfor",), m[1], constants, depth + 1)
                out.append(Loop(m[1], body))
            elif word == "if":
                branches, condition = [], expression(tail)
                while True:
                    body, at = _block(pieces, at + 1, ("elif", "else", "endif"), turn, constants, depth + 1)
                    branches.append((condition, body))
                    word, _, tail = pieces[at][1].partition(" ")
                    if word == "endif":
                        break
                    if branches[-1][0] is _ELSE:
                        raise TemplateError("nothing follows else but endif")
                    condition = expression(tail) if word == "elif" else _ELSE
                out.append(Choice(tuple(branches)))
            else:
                raise TemplateError(f"no such tag: {value!r}")
        at += 1
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return tuple(out), at


_ELSE = Const(True)


def _nodes(body: tuple) -> Iterator:
    for n in body:
        yield n
        if isinstance(n, (Marked, Loop)):
            yield from _nodes(n.body)
        elif isinstance(n, Choice):
            for _, b in n.branches:
                yield from _nodes(b)


def _written(v: Any) -> str:
    return v if isinstance(v, str) else ("true" if v else "false") if isinstance(v, bool) else str(v)


def _functions(escape: Escape | None) -> dict[str, Callable]:
    def escaped(v: Any) -> str:
        if escape is None:
            raise TemplateError("escape needs control strings")
        return escape.apply(_written(v))

    return {
        "not": lambda a: not a, "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: _written(a) in _written(b),
        "+": lambda a, b: a + b if type(a) is type(b) is int else _written(a) + _written(b),
        "escape": escaped, "trim": lambda a: _written(a).strip(), "upper": lambda a: _written(a).upper(), "lower": lambda a: _written(a).lower(), "length": lambda a: len(_written(a)),
    }


def fold(node: Any, functions: dict[str, Callable]) -> Any:
    """The expression with all that does not depend on a turn worked out."""
    if not isinstance(node, Op):
        return node
    args = tuple(fold(a, functions) for a in node.args)
    if node.name in ("and", "or"):
        if isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.name == "and") else args[0]
    elif all(isinstance(a, Const) for a in args):
        return Const(functions[node.name](*(a.value for a in args)))
    return Op(node.name, args)


def fold_body(body: tuple, functions: dict[str, Callable]) -> tuple:
    """The nodes with constant branches chosen and neighbouring texts joined."""
    out: list = []

    def put(n: Any) -> None:
        if isinstance(n, Put) and isinstance(n.value, Const):
            text = _written(n.value.value)
            if out and isinstance(out[-1], Put) and isinstance(out[-1].value, Const):
                text = out.pop().value.value + text
            n = Put(Const(text))
            if not text:
                return
        out.append(n)

    for n in body:
        if isinstance(n, Put):
            put(Put(fold(n.value, functions)))
        elif isinstance(n, Marked):
            put(Marked(fold_body(n.body, functions)))
        elif isinstance(n, Loop):
            put(Loop(n.name, fold_body(n.body, functions)))
        else:
            left = []
            for condition, inner in n.branches:
                condition = fold(condition, functions)
                if isinstance(condition, Const) and not condition.value:
                    continue
                left.append((condition, fold_body(inner, functions)))
                if isinstance(condition, Const):
                    break
            if left and isinstance(left[0][0], Const):
                for inner in left[0][1]:
                    put(inner)
            elif left:
                put(Choice(tuple(left)))
    return tuple(out)


@dataclass
class Output:
    """Written text, and the spans in code points that lie inside generation marks."""

    texts: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def put(self, text: str) -> None:
        self.texts.append(text)
        self.size += len(text)


@dataclass
class Turn:
    """A turn with its place; ``last`` is known when the next one is."""

    role: str
    text: str
    index0: int = 0
    last: bool = False


def _value(node: Any, functions: dict[str, Callable]) -> Callable[[Turn], Any]:
    """An expression as a closure of the turn."""
    if isinstance(node, Const):
        return lambda t, v=node.value: v
    if isinstance(node, Field):
        return {
            "role": lambda t: t.role, "text": lambda t: t.text, "index": lambda t: t.index0 + 1,
            "index0": lambda t: t.index0, "first": lambda t: t.index0 == 0, "last": lambda t: t.last,
        }[node.name]
    args = [_value(a, functions) for a in node.args]
    if node.name == "and":
        return lambda t, a=args[0], b=args[1]: a(t) and b(t)
    if node.name == "or":
        return lambda t, a=args[0], b=args[1]: a(t) or b(t)
    if len(args) == 1:
        return lambda t, f=functions[node.name], a=args[0]: f(a(t))
    return lambda t, f=functions[node.name], a=args[0], b=args[1]: f(a(t), b(t))


def _body(body: tuple, functions: dict[str, Callable]) -> Callable[[Turn, Output], None]:
    """Nodes as a closure that writes a turn."""
    steps: list[Callable[[Turn, Output], None]] = []
    for n in body:
        if isinstance(n, Put) and isinstance(n.value, Const):
            steps.append(lambda t, out, s=n.value.value: out.put(s))
        elif isinstance(n, Put):
            steps.append(lambda t, out, v=_value(n.value, functions): out.put(_written(v(t))))
        elif isinstance(n, Marked):

            def marked(t: Turn, out: Output, inner: Callable = _body(n.body, functions)) -> None:
                at = out.size
                inner(t, out)
                out.spans.append((at, out.size))

            steps.append(marked)
        else:

            def choose(t: Turn, out: Output, branches: tuple = tuple((_value(c, functions), _body(b, functions)) for c, b in n.branches)) -> None:
                for condition, inner in branches:
                    if condition(t):
                        inner(t, out)
                        return

            steps.append(choose)
    if len(steps) == 1:
        return steps[0]

    def all_of(t: Turn, out: Output) -> None:
        for s in steps:
            s(t, out)

    return all_of


@dataclass(frozen=True)
class Template:
    """Closures for what stands before the turns, a turn, and what stands after them; and the folded tree."""

    before: Callable[[Turn, Output], None]
    turn: Callable[[Turn, Output], None]
    after: Callable[[Turn, Output], None]
    tree: tuple
    escape: Escape | None


def compile_template(source: str, controls: Iterable[str] = (), constants: dict[str, Any] | None = None) -> Template:
    """Parse, fold and compile; constants are the names that a template may use besides its turns."""
    controls = tuple(controls)
    escape = Escape(controls) if controls else None
    functions = _functions(escape)
    tree = fold_body(parse(source, constants), functions)
    at = next((i for i, n in enumerate(tree) if isinstance(n, Loop)), len(tree))
    loop = tree[at].body if at < len(tree) else ()
    return Template(_body(tree[:at], functions), _body(loop, functions), _body(tree[at + 1 :], functions), tree, escape)


def render(template: Template, turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(text, spans of generation) of one short conversation."""
    out, nobody, held = Output(), Turn("", ""), None
    template.before(nobody, out)
    for i, (role, text) in enumerate(turns):
        if held:
            template.turn(held, out)
        held = Turn(role, text, i)
    if held:
        held.last = True
        template.turn(held, out)
    template.after(nobody, out)
    return "".join(out.texts), out.spans
