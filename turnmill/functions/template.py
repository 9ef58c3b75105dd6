"""Chat templates as models publish them, compiled to one Column.

A template is read once, on the driver; what comes out is an expression over the messages that runs
in the JVM. Supported: text, comments, ``{{ }}``, ``for`` over messages (with ``if``, ``loop.index``,
``index0``, ``first``, ``last``), ``if``/``elif``/``else``, ``set``, whitespace control, strings,
numbers, ``+ - % ~``, comparisons, ``in``, ``and``/``or``/``not``, ``a if c else b``, fields, indexes
and slices of messages, ``strip``/``lstrip``/``rstrip``/``upper``/``lower``/``startswith``/``endswith``/
``split``, the filters ``trim``/``upper``/``lower``/``length``, the tests ``defined``/``none`` and
``raise_exception``. Anything else is a ``TemplateError``, raised before a job starts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, functions as F

from turnmill.functions.text import WHITESPACE


class TemplateError(ValueError):
    """A template uses something that cannot be compiled."""


class _Undefined:
    def __bool__(self) -> bool:
        return False


UNDEFINED = _Undefined()


@dataclass(frozen=True)
class Typed:
    """A value known only per row: text, number, bool, message, messages or texts."""

    kind: str
    column: Column


# A value is a Typed, or a constant: str, int, bool, None, UNDEFINED, or a list of constants.
Value = Any
Scope = dict[str, Value]
Expression = Callable[[Scope], Value]
Node = tuple

_TAG = re.compile(r"""\{#.*?#\}|\{([{%])([-+]?)((?:'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|[^'"])*?)([-+]?)[%}]\}""", re.S)
_TOKEN = re.compile(r"""\s*(?:('(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+%~<>|.,:()\[\]=]))""", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)
_ESCAPED = {"n": "\n", "t": "\t", "r": "\r"}
_ORDER = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


# --- cutting the template into text and tags ---------------------------------------------------


def _pieces(template: str) -> list[tuple[str, str]]:
    """(kind, body) of each piece: text, ``{`` for output and ``%`` for a statement.

    As models' templates expect it, a statement alone takes its line's indentation and line break with
    it, and the last line break of the template is dropped.
    """
    template = template.removesuffix("\n")
    out, at, eat = [], 0, ""
    for tag in _TAG.finditer(template):
        text = template[at : tag.start()]
        kind, before, body, after = tag[1] or "#", tag[2] or "", tag[3] or "", tag[4] or ""
        if tag[1] is None:
            before, after = tag[0][2], tag[0][-3]
        elif tag[0][-2:] != ("}}" if kind == "{" else "%}"):
            raise TemplateError(f"tag is not closed: {tag[0]}")
        text = _after(text, eat)
        if before == "-":
            text = text.rstrip()
        elif kind != "{" and before != "+" and (at == 0 or "\n" in template[at : tag.start()]):
            text = re.sub(r"(^|\n)[ \t]+\Z", r"\1", text)
        out += [("text", text), (kind, body.strip())]
        eat = "-" if after == "-" else ("" if kind == "{" or after == "+" else "\n")
        at = tag.end()
    rest = template[at:]
    if re.search(r"\{[{%#]", rest):
        raise TemplateError(f"tag is not closed: {rest[:40]}")
    out.append(("text", _after(rest, eat)))
    return [(k, b) for k, b in out if k != "#" and (k != "text" or b)]


def _after(text: str, eat: str) -> str:
    return text.lstrip() if eat == "-" else text.removeprefix(eat)


# --- statements --------------------------------------------------------------------------------


def _block(pieces: list[tuple[str, str]], at: int, ends: Sequence[str]) -> tuple[list[Node], int]:
    """Statements up to one of some closing words, and the place of that."""
    nodes: list[Node] = []
    while at < len(pieces):
        kind, body = pieces[at]
        if kind == "text":
            nodes.append(("text", body))
        elif kind == "{":
            nodes.append(("out", _Reader(body).whole()))
        else:
            word = re.match(r"\w*", body)[0]
            if word in ends:
                return nodes, at
            rest = body[len(word) :]
            if word == "set":
                name = re.match(r"\s*(\w+)\s*=(?!=)", rest)
                if not name:
                    raise TemplateError(f"cannot set: {body}")
                nodes.append(("set", name[1], _Reader(rest[name.end() :]).whole()))
            elif word == "if":
                branches, otherwise, closed = [], [], ""
                while closed != "endif":
                    if closed == "else":
                        otherwise, at = _block(pieces, at + 1, ["endif"])
                    else:
                        test = _Reader(rest).whole()
                        held, at = _block(pieces, at + 1, ["elif", "else", "endif"])
                        branches.append((test, held))
                    closed = re.match(r"\w+", pieces[at][1])[0]
                    rest = pieces[at][1][len(closed) :]
                nodes.append(("if", branches, otherwise))
            elif word == "for":
                head = re.match(r"\s*(\w+)\s+in\b(.*)", rest, re.S)
                if not head:
                    raise TemplateError(f"cannot loop: {body}")
                reader = _Reader(head[2])
                over = reader.either()
                where = reader.either() if reader.take("if") else None
                reader.end()
                held, at = _block(pieces, at + 1, ["endfor"])
                nodes.append(("for", head[1], over, where, held))
            else:
                raise TemplateError(f"unknown statement: {body}")
        at += 1
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return nodes, at


def _run(nodes: list[Node], scope: Scope) -> list[Value]:
    """What some statements print, piece by piece; names that they set go to ``scope``."""
    out: list[Value] = []
    for node in nodes:
        if node[0] == "text":
            out.append(node[1])
        elif node[0] == "out":
            out.append(_printed(node[1](scope)))
        elif node[0] == "set":
            scope[node[1]] = node[2](scope)
        elif node[0] == "if":
            out.append(_branch(node[1], node[2], scope))
        else:
            out.append(_loop(*node[1:], scope))
    return out


def _branch(branches: list, otherwise: list[Node], scope: Scope) -> Value:
    if not branches:
        return _joined(_run(otherwise, scope))
    (test, held), rest = branches[0], branches[1:]
    holds = _truth(test(scope))
    if holds is True:
        return _joined(_run(held, scope))
    if holds is False:
        return _branch(rest, otherwise, scope)
    one, other = dict(scope), dict(scope)
    text = _chosen(holds, _joined(_run(held, one)), _branch(rest, otherwise, other))
    for name in one.keys() | other.keys():
        a, b = one.get(name, UNDEFINED), other.get(name, UNDEFINED)
        if a is not b:
            scope[name] = _chosen(holds, a, b)
    return text


def _loop(name: str, over: Expression, where: Expression | None, held: list[Node], scope: Scope) -> Value:
    rows = over(scope)
    if not isinstance(rows, Typed) or rows.kind != "messages":
        raise TemplateError("loops run over messages")
    column = rows.column
    if where is not None:
        column = F.filter(column, lambda m: _column(_truth(where(scope | {name: Typed("message", m)}))))

    def turn(m: Column, i: Column) -> Column:
        loop = {"index0": Typed("number", i), "index": Typed("number", i + 1), "length": Typed("number", F.size(column))}
        loop |= {"first": Typed("bool", i == 0), "last": Typed("bool", i == F.size(column) - 1)}
        # What a turn sets is gone with it.
        return _column(_joined(_run(held, scope | {name: Typed("message", m), "loop": loop})))

    return Typed("text", F.array_join(F.transform(column, turn), ""))


# --- values ------------------------------------------------------------------------------------


def _column(value: Value) -> Column:
    return value.column if isinstance(value, Typed) else F.lit(value)


def _kind(value: Value) -> str:
    if isinstance(value, Typed):
        return value.kind
    return {str: "text", bool: "bool", int: "number", list: "list"}.get(type(value), "none")


def _truth(value: Value) -> Value:
    """True, False, or a Typed bool that is never null."""
    if not isinstance(value, Typed):
        return bool(value)
    c = value.column
    if value.kind == "message":
        return Typed("bool", c.isNotNull())
    held = {"text": F.length(c) > 0, "number": c != 0, "bool": c}.get(value.kind)
    return Typed("bool", F.coalesce(F.size(c) > 0 if held is None else held, F.lit(False)))


def _printed(value: Value) -> Value:
    """Text of a value; a null one prints nothing."""
    kind = _kind(value)
    if kind not in ("text", "number"):
        raise TemplateError(f"cannot print a value of kind {kind}")
    if not isinstance(value, Typed):
        return str(value)
    return Typed("text", F.coalesce(value.column.cast("string"), F.lit("")))


def _joined(parts: list[Value]) -> Value:
    if all(isinstance(p, str) for p in parts):
        return "".join(parts)
    return Typed("text", F.concat(*[_column(p) for p in parts]))


def _chosen(holds: Typed, a: Value, b: Value) -> Value:
    """``a`` where ``holds``, else ``b``; false, none and undefined beside another kind become null."""
    if not isinstance(a, Typed) and not isinstance(b, Typed) and type(a) is type(b) and a == b:
        return a
    absent = [x is None or x is False or x is UNDEFINED for x in (a, b)]
    kinds = {_kind(x) for x, gone in zip((a, b), absent, strict=True) if not gone}
    if not kinds:
        return None
    if len(kinds) > 1 or not kinds <= {"text", "number", "bool", "message", "messages", "texts"}:
        raise TemplateError("branches give values of different kinds")
    (kind,) = kinds
    nothing = F.lit(False if kind == "bool" else None)
    one, other = (nothing if gone else _column(x) for x, gone in zip((a, b), absent, strict=True))
    return Typed(kind, F.when(holds.column, one).otherwise(other))


def _equal(a: Value, b: Value) -> Value:
    if not isinstance(a, Typed) and not isinstance(b, Typed):
        return a == b
    if not isinstance(a, Typed):
        a, b = b, a
    if b is None or b is False and a.kind != "bool":
        return Typed("bool", a.column.isNull())
    if a.kind != _kind(b):
        return False
    return Typed("bool", a.column.eqNullSafe(_column(b)))


def _not(value: Value) -> Value:
    holds = _truth(value)
    return Typed("bool", ~holds.column) if isinstance(holds, Typed) else not holds


def _both(a: Value, b: Callable[[], Value], stop: bool) -> Value:
    """``and`` (stop at False) or ``or`` (stop at True) as a condition."""
    left = _truth(a)
    if left is stop:
        return stop
    right = _truth(b())
    if left is not stop and not isinstance(left, Typed):
        return right
    if not isinstance(right, Typed):
        return right if right is stop else left
    return Typed("bool", left.column | right.column if stop else left.column & right.column)


def _within(a: Value, b: Value) -> Value:
    if isinstance(b, list):
        found: Value = False
        for item in b:
            found = _both(found, lambda item=item: _equal(a, item), True)
        return found
    if _kind(a) != "text" or _kind(b) != "text":
        raise TemplateError("in looks for text in text or for a value in a list")
    if not isinstance(a, Typed) and not isinstance(b, Typed):
        return a in b
    return Typed("bool", F.coalesce(F.contains(_column(b), _column(a)), F.lit(False)))


def _arithmetic(sign: str, a: Value, b: Value) -> Value:
    kinds = {_kind(a), _kind(b)}
    if sign == "~" or sign == "+" and kinds == {"text"}:
        return _joined([_printed(a), _printed(b)])
    if kinds != {"number"}:
        raise TemplateError(f"cannot apply {sign} to {_kind(a)} and {_kind(b)}")
    const = not isinstance(a, Typed) and not isinstance(b, Typed)
    x, y = (a, b) if const else (_column(a), _column(b))
    if sign == "%":
        return x % y if const else Typed("number", F.pmod(x, y))
    out = x + y if sign == "+" else x - y
    return out if const else Typed("number", out)


def _field(value: Value, name: str) -> Value:
    if isinstance(value, dict):
        if name not in value:
            raise TemplateError(f"unknown field {name}")
        return value[name]
    if _kind(value) != "message":
        raise TemplateError(f"no field {name} in a value of kind {_kind(value)}")
    return Typed("text", value.column[name]) if name in ("role", "content") else UNDEFINED


def _item(value: Value, at: Value) -> Value:
    if isinstance(at, str):
        return _field(value, at)
    of = {"messages": "message", "texts": "text"}.get(_kind(value))
    if of is None or _kind(at) != "number":
        raise TemplateError(f"no items in a value of kind {_kind(value)}")
    c, i = value.column, _column(at)
    place = i + F.when(i < 0, F.size(c)).otherwise(0) if isinstance(at, Typed) else (i if at >= 0 else F.size(c) + at)
    return Typed(of, F.get(c, place))


def _sliced(value: Value, low: Value, high: Value) -> Value:
    if _kind(value) != "messages" or not all(x is None or type(x) is int for x in (low, high)):
        raise TemplateError("slices take messages between fixed numbers")
    c, n = value.column, F.size(value.column)

    def bound(x: int | None, default: Column) -> Column:
        return default if x is None else F.least(F.lit(x), n) if x >= 0 else F.greatest(n + x, F.lit(0))

    first = bound(low, F.lit(0))
    return Typed("messages", F.slice(c, first + 1, F.greatest(bound(high, n) - first, F.lit(0))))


def _stripped(c: Column, chars: str | None, left: bool, right: bool) -> Column:
    some = F.lit(WHITESPACE if chars is None else chars)
    return F.btrim(c, some) if left and right else (F.ltrim(c, some) if left else F.rtrim(c, some))


def _method(value: Value, name: str, given: list[Value]) -> Value:
    if _kind(value) != "text" or any(not isinstance(x, str) for x in given) or len(given) > 1:
        raise TemplateError(f"cannot call {name} here")
    arg = given[0] if given else None
    c = _column(value)
    if name in ("strip", "lstrip", "rstrip", "trim"):
        return Typed("text", _stripped(c, arg, name != "rstrip", name != "lstrip"))
    if name in ("upper", "lower") and arg is None:
        return Typed("text", F.upper(c) if name == "upper" else F.lower(c))
    if arg is not None and name in ("startswith", "endswith"):
        found = F.startswith(c, F.lit(arg)) if name == "startswith" else F.endswith(c, F.lit(arg))
        return Typed("bool", F.coalesce(found, F.lit(False)))
    if arg and name == "split":
        return Typed("texts", F.split(c, re.escape(arg), -1))
    raise TemplateError(f"unknown method or filter {name}")


def _length(value: Value) -> Value:
    if _kind(value) == "text":
        return Typed("number", F.length(_column(value))) if isinstance(value, Typed) else len(value)
    if _kind(value) not in ("messages", "texts"):
        raise TemplateError(f"no length of a value of kind {_kind(value)}")
    return Typed("number", F.size(value.column))


def _defined(value: Value) -> Value:
    if isinstance(value, Typed):
        return Typed("bool", value.column.isNotNull())
    return value is not UNDEFINED


# --- expressions -------------------------------------------------------------------------------


class _Reader:
    """Reads one expression into a function of the names in scope."""

    def __init__(self, body: str):
        self.tokens: list[tuple[str, str]] = []
        self.body, self.at, place = body, 0, 0
        body = body.rstrip()
        while place < len(body):
            token = _TOKEN.match(body, place)
            if not token:
                raise TemplateError(f"cannot read: {body[place:]}")
            kind = next(k for k, x in zip(("text", "number", "name", "sign"), token.groups(), strict=True) if x is not None)
            self.tokens.append((kind, token[token.lastindex]))
            place = token.end()

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *words: str) -> str | None:
        """The next token if it is one of some signs or words."""
        kind, word = self.peek()
        if kind in ("sign", "name") and word in words:
            self.at += 1
            return word
        return None

    def need(self, sign: str) -> None:
        if not self.take(sign):
            raise TemplateError(f"expected {sign} in: {self.body}")

    def end(self) -> None:
        if self.peek()[0] != "end":
            raise TemplateError(f"cannot read {self.peek()[1]} in: {self.body}")

    def whole(self) -> Expression:
        value = self.choice()
        self.end()
        return value

    def choice(self) -> Expression:
        value = self.either()
        while self.take("if"):
            test = self.either()
            other = self.choice() if self.take("else") else lambda s: UNDEFINED
            value = lambda s, a=value, t=test, b=other: _conditional(_truth(t(s)), a, b, s)
        return value

    def either(self) -> Expression:
        value = self.both()
        while self.take("or"):
            value = lambda s, a=value, b=self.both(): _both(a(s), lambda: b(s), True)
        return value

    def both(self) -> Expression:
        value = self.negated()
        while self.take("and"):
            value = lambda s, a=value, b=self.negated(): _both(a(s), lambda: b(s), False)
        return value

    def negated(self) -> Expression:
        if self.take("not"):
            value = self.negated()
            return lambda s: _not(value(s))
        return self.compared()

    def compared(self) -> Expression:
        value = self.added()
        while True:
            sign = self.take("==", "!=", "<", "<=", ">", ">=", "in")
            if not sign and self.peek() == ("name", "not") and self.tokens[self.at + 1 : self.at + 2] == [("name", "in")]:
                self.at += 2
                sign = "not in"
            if not sign:
                return value
            value = lambda s, a=value, b=self.added(), sign=sign: _compare(sign, a(s), b(s))

    def added(self) -> Expression:
        value = self.tied()
        while sign := self.take("+", "-"):
            value = lambda s, a=value, b=self.tied(), sign=sign: _arithmetic(sign, a(s), b(s))
        return value

    def tied(self) -> Expression:
        value = self.rest()
        while self.take("~"):
            value = lambda s, a=value, b=self.rest(): _arithmetic("~", a(s), b(s))
        return value

    def rest(self) -> Expression:
        value = self.unary()
        while self.take("%"):
            value = lambda s, a=value, b=self.unary(): _arithmetic("%", a(s), b(s))
        return value

    def unary(self) -> Expression:
        if self.take("-"):
            value = self.unary()
            return lambda s: _arithmetic("-", 0, value(s))
        return self.tail(self.primary())

    def primary(self) -> Expression:
        kind, word = self.peek()
        self.at += 1
        if kind == "text":
            text = _ESCAPE.sub(lambda m: _ESCAPED.get(m[1], m[1]), word[1:-1])
            return lambda s: text
        if kind == "number":
            return lambda s: int(word)
        if word == "(":
            value = self.choice()
            self.need(")")
            return value
        if word == "[":
            items = self.items("]")
            return lambda s: [x(s) for x in items]
        if kind != "name":
            raise TemplateError(f"cannot read: {self.body}")
        fixed = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}
        if word in fixed:
            return lambda s: fixed[word]
        if word == "raise_exception" and self.take("("):
            (reason,) = self.items(")")
            return lambda s: Typed("text", F.raise_error(_column(reason(s))).cast("string"))
        return lambda s: s.get(word, UNDEFINED)

    def items(self, close: str) -> list[Expression]:
        out = []
        while not self.take(close):
            out.append(self.choice())
            if not self.take(","):
                self.need(close)
                break
        return out

    def tail(self, value: Expression) -> Expression:
        while True:
            if self.take("."):
                name = self.word()
                if self.take("("):
                    value = lambda s, v=value, g=self.items(")"), n=name: _method(v(s), n, [x(s) for x in g])
                else:
                    value = lambda s, v=value, n=name: _field(v(s), n)
            elif self.take("["):
                value = self.subscript(value)
            elif self.take("|"):
                name = self.word()
                if name == "length":
                    value = lambda s, v=value: _length(v(s))
                elif name in ("trim", "upper", "lower"):
                    value = lambda s, v=value, n=name: _method(v(s), n, [])
                else:
                    raise TemplateError(f"unknown filter {name}")
            elif self.take("is"):
                negated, name = bool(self.take("not")), self.word()
                tests = {"defined": _defined, "undefined": lambda v: _not(_defined(v)), "none": lambda v: _equal(v, None)}
                if name not in tests:
                    raise TemplateError(f"unknown test {name}")
                test = tests[name]
                value = lambda s, v=value, t=test, n=negated: _not(t(v(s))) if n else t(v(s))
            else:
                return value

    def word(self) -> str:
        kind, word = self.peek()
        if kind != "name":
            raise TemplateError(f"expected a name in: {self.body}")
        self.at += 1
        return word

    def subscript(self, value: Expression) -> Expression:
        nothing = lambda s: None
        low = nothing if self.peek() == ("sign", ":") else self.choice()
        if self.take(":"):
            high = nothing if self.peek() == ("sign", "]") else self.choice()
            self.need("]")
            return lambda s: _sliced(value(s), low(s), high(s))
        self.need("]")
        return lambda s: _item(value(s), low(s))


def _conditional(holds: Value, a: Expression, b: Expression, scope: Scope) -> Value:
    return _chosen(holds, a(scope), b(scope)) if isinstance(holds, Typed) else (a if holds else b)(scope)


def _compare(sign: str, a: Value, b: Value) -> Value:
    if sign in ("==", "!="):
        same = _equal(a, b)
        return same if sign == "==" else _not(same)
    if sign in ("in", "not in"):
        found = _within(a, b)
        return found if sign == "in" else _not(found)
    if {_kind(a), _kind(b)} != {"number"}:
        raise TemplateError(f"{sign} compares numbers")
    if not isinstance(a, Typed) and not isinstance(b, Typed):
        return _ORDER[sign](a, b)
    return Typed("bool", _ORDER[sign](_column(a), _column(b)))


def compile_template(template: str) -> Callable[..., Column]:
    """A function ``(messages, generation_prompt=False, **variables)`` to the rendered text.

    ``variables`` are constants such as ``bos_token``; a name that is not given is undefined, which is
    false in a condition and an error where it is printed. Branches decided by constants are dropped when
    the column is built. A null role or content prints nothing; null messages give null, empty ones
    what the template prints around its loop. ``raise_exception`` fails the job on the row that meets it.
    """
    nodes, _ = _block(_pieces(template), 0, [])

    def render(messages: Column, generation_prompt: bool = False, **variables: Value) -> Column:
        scope: Scope = {"messages": Typed("messages", messages), "add_generation_prompt": generation_prompt, **variables}
        text = _column(_joined(_run(nodes, scope)))
        return F.when(messages.isNotNull(), text)

    return render
