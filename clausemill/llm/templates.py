"""A sandboxed template language for conversations, compiled to Python closures.

Source is read into a syntax tree, constants are folded, and the tree becomes closures that write text
and note which stretches of it stand inside ``{% generation %}``. The language:

    {{ expression }}            {# remark #}            a "-" inside a tag's bracket trims white space there
    {% for name in expression %} ... {% endfor %}       loop.first, loop.last, loop.index (from 1)
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% set name = expression %}
    {% generation %} ... {% endgeneration %}

Expressions: strings, whole numbers, true, false, none; names; x.field and x["field"] of mappings;
x[0], x[-1] of lists; ==, !=, <, <=, >, >=, in, and, or, not; + - * % and ~ (joins as text); filters
after |: escape, trim, upper, lower, length, default("..."). Nothing else exists: no calls, no
attributes of Python objects, no imports; reading a field of anything but a mapping fails. Loops are
over the lists that the caller gives, so a rendering ends. Whatever can't be worked out is a TemplateError, as is a bracket that isn't closed.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any


class TemplateError(ValueError):
    """The template, or what it reads, is not in the language."""


_STRING = r""""(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'"""
_INSIDE = rf"""((?:{_STRING}|[^"'])*?)"""  # a bracket's end inside a string ends nothing
_TAG = re.compile(rf"\{{\{{(-?){_INSIDE}(-?)\}}\}}|\{{%(-?){_INSIDE}(-?)%\}}|\{{#(-?).*?(-?)#\}}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<num>\d+)|(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+*%~<>|.,()\[\]=]))""")
_UNESCAPED = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"and", "or", "not", "in", "true", "false", "none"}
FILTERS = {"escape", "trim", "upper", "lower", "length", "default"}


def _tokens(source: str) -> list[tuple[str, Any]]:
    out, at = [], 0
    while source[at:].strip():
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"can't read {source[at:]!r}")
        at, kind = m.end(), m.lastgroup
        value: Any = m[kind]
        if kind == "num":
            value = int(value)
        elif kind == "str":
            value = re.sub(r"\\(.)", lambda e: _UNESCAPED.get(e[1], e[1]), value[1:-1], flags=re.S)
        elif kind == "name" and value in _WORDS:
            kind = "word"
        out.append((kind, value))
    return out


class _Expr:
    """Recursive descent; nodes are tuples headed by their kind."""

    def __init__(self, source: str):
        self.t, self.i = _tokens(source), 0

    def peek(self, *values) -> bool:
        return self.i < len(self.t) and self.t[self.i][0] in ("op", "word") and self.t[self.i][1] in values

    def take(self, *values):
        if not self.peek(*values):
            raise TemplateError(f"expected one of {values} at {self.t[self.i :][:1]}")
        self.i += 1
        return self.t[self.i - 1][1]

    def name(self) -> str:
        if self.i >= len(self.t) or self.t[self.i][0] != "name":
            raise TemplateError("expected a name")
        self.i += 1
        return self.t[self.i - 1][1]

    def end(self, node):
        if self.i != len(self.t):
            raise TemplateError(f"unread: {self.t[self.i :]}")
        return node

    def parse(self):
        node = self.both()
        while self.peek("or"):
            self.i += 1
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.peek("and"):
            self.i += 1
            node = ("and", node, self.negated())
        return node

    def negated(self):
        if self.peek("not"):
            self.i += 1
            return ("not", self.negated())
        return self.compared()

    def compared(self):
        node = self.sum()
        while self.peek("==", "!=", "<", "<=", ">", ">=", "in"):
            node = ("bin", self.take("==", "!=", "<", "<=", ">", ">=", "in"), node, self.sum())
        return node

    def sum(self):
        node = self.product()
        while self.peek("+", "-", "~"):
            node = ("bin", self.take("+", "-", "~"), node, self.product())
        return node

    def product(self):
        node = self.filtered()
        while self.peek("*", "%"):
            node = ("bin", self.take("*", "%"), node, self.filtered())
        return node

    def filtered(self):
        node = self.reached()
        while self.peek("|"):
            self.i += 1
            name, args = self.name(), []
            if name not in FILTERS:
                raise TemplateError(f"no filter {name}")
            if self.peek("("):
                self.i += 1
                args.append(self.parse())
                self.take(")")
            if len(args) != (name == "default"):
                raise TemplateError(f"{name} takes {int(name == 'default')} arguments")
            node = ("filter", name, node, *args)
        return node

    def reached(self):
        node = self.atom()
        while self.peek(".", "["):
            if self.take(".", "[") == ".":
                node = ("get", node, ("const", self.name()))
            else:
                node = ("get", node, self.parse())
                self.take("]")
        return node

    def atom(self):
        if self.i >= len(self.t):
            raise TemplateError("the expression ends early")
        kind, value = self.t[self.i]
        if kind in ("num", "str"):
            self.i += 1
            return ("const", value)
        if kind == "name":
            self.i += 1
            return ("name", value)
        if self.peek("true", "false", "none"):
            return ("const", {"true": True, "false": False, "none": None}[self.take("true", "false", "none")])
        if self.peek("-"):
            self.i += 1
            return ("bin", "-", ("const", 0), self.reached())
        self.take("(")
        node = self.parse()
        self.take(")")
        return node


def _pieces(source: str) -> list[tuple[str, str]]:
    """("text" | "out" | "tag", content), white space trimmed where a bracket asks for it."""
    out, at, strip = [], 0, False
    for m in _TAG.finditer(source):
        text = source[at : m.start()]
        before, after = any(m[g] for g in (1, 4, 7)), any(m[g] for g in (3, 6, 8))
        text = text.lstrip() if strip else text
        out.append(("text", text.rstrip() if before else text))
        if m[2] is not None:
            out.append(("out", m[2]))
        elif m[5] is not None:
            out.append(("tag", m[5].strip()))
        at, strip = m.end(), after
    out.append(("text", source[at:].lstrip() if strip else source[at:]))
    for kind, text in out:
        if kind == "text" and re.search(r"\{[{%#]", text):
            raise TemplateError(f"a bracket isn't closed in {text!r}")
    return out


def parse(source: str) -> list:
    """The syntax tree: a list of ("text", s), ("out", e), ("for", name, e, body), ("if", [(e, body)...]), ("set", name, e), ("gen", body)."""
    pieces, at = _pieces(source), 0

    def body(*stops: str) -> tuple[list, str]:
        nonlocal at
        nodes: list = []
        while at < len(pieces):
            kind, content = pieces[at]
            at += 1
            if kind == "text":
                nodes += [("text", content)] if content else []
                continue
            if kind == "out":
                e = _Expr(content)
                nodes.append(("out", e.end(e.parse())))
                continue
            word, _, rest = content.partition(" ")
            if word in stops:
                return nodes, content
            if word == "for":
                e = _Expr(rest)
                name = e.name()
                e.take("in")
                over = e.end(e.parse())
                nodes.append(("for", name, over, body("endfor")[0]))
            elif word == "if":
                arms, test = [], rest
                while True:
                    e = _Expr(test)
                    cond = e.end(e.parse()) if test else ("const", True)
                    inner, stop = body("elif", "else", "endif")
                    arms.append((cond, inner))
                    if stop == "endif":
                        break
                    test = stop.partition(" ")[2]
                nodes.append(("if", arms))
            elif word == "set":
                e = _Expr(rest)
                name = e.name()
                e.take("=")
                nodes.append(("set", name, e.end(e.parse())))
            elif word == "generation":
                nodes.append(("gen", body("endgeneration")[0]))
            else:
                raise TemplateError(f"no tag {content!r} here")
        if stops:
            raise TemplateError(f"{stops[-1]} is missing")
        return nodes, ""

    return body()[0]


_OPS: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b, "+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: _number(a) * _number(b), "%": lambda a, b: _number(a) % _number(b), "~": lambda a, b: _said(a) + _said(b),
}


def _number(x):
    if not isinstance(x, int):
        raise TemplateError(f"{x!r} is no number")
    return x


def _said(x) -> str:
    return "" if x is None else x if isinstance(x, str) else str(x)


def _get(x, key):
    if isinstance(x, dict):
        return x.get(key)
    if isinstance(x, list) and isinstance(key, int) and not isinstance(key, bool):
        return x[key] if -len(x) <= key < len(x) else None
    raise TemplateError(f"nothing to read at {key!r}")


def _filter(name: str, x, escape: Callable[[str], str], *args):
    if name == "default":
        return args[0] if x is None else x
    if name == "length":
        return len(x) if isinstance(x, str | list) else 0
    x = _said(x)
    return {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}[name](x)


def fold(node, escape: Callable[[str], str]):
    """The expression with every part that reads no name worked out."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    parts = [fold(x, escape) if isinstance(x, tuple) else x for x in node]
    if all(x[0] == "const" for x in parts if isinstance(x, tuple)):
        return ("const", _closure(tuple(parts), escape)({}))
    if kind in ("and", "or") and parts[1][0] == "const":
        return parts[2] if bool(parts[1][1]) == (kind == "and") else parts[1]
    return tuple(parts)


def fold_body(nodes: list, escape: Callable[[str], str]) -> list:
    """The tree with constant expressions folded, constant branches chosen and neighbouring text joined."""
    out: list = []
    for node in nodes:
        kind = node[0]
        if kind == "out":
            e = fold(node[1], escape)
            new = [("text", _said(e[1]))] if e[0] == "const" else [("out", e)]
        elif kind == "for":
            new = [("for", node[1], fold(node[2], escape), fold_body(node[3], escape))]
        elif kind == "gen":
            new = [("gen", fold_body(node[1], escape))]
        elif kind == "set":
            new = [("set", node[1], fold(node[2], escape))]
        elif kind == "if":
            arms = []
            for cond, inner in node[1]:
                cond = fold(cond, escape)
                if cond[0] == "const" and not cond[1]:
                    continue
                arms.append((cond, fold_body(inner, escape)))
                if cond[0] == "const":
                    break
            new = arms[0][1] if arms and arms[0][0][0] == "const" else [("if", arms)] if arms else []
        else:
            new = [node]
        for x in new:
            if x[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + x[1])
            elif x[0] != "text" or x[1]:
                out.append(x)
    return out


def _closure(node, escape) -> Callable[[dict], Any]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    if kind == "not":
        one = _closure(node[1], escape)
        return lambda env: not one(env)
    if kind in ("and", "or"):
        a, b = _closure(node[1], escape), _closure(node[2], escape)
        return (lambda env: a(env) and b(env)) if kind == "and" else (lambda env: a(env) or b(env))
    if kind == "get":
        a, b = _closure(node[1], escape), _closure(node[2], escape)
        return lambda env: _get(a(env), b(env))
    if kind == "filter":
        name, a, more = node[1], _closure(node[2], escape), [_closure(x, escape) for x in node[3:]]
        return lambda env: _filter(name, a(env), escape, *[f(env) for f in more])
    sign, a, b = node[1], _closure(node[2], escape), _closure(node[3], escape)
    op = _OPS[sign]

    def both(env):
        x, y = a(env), b(env)
        try:
            return op(x, y)
        except (TypeError, ZeroDivisionError) as e:
            raise TemplateError(f"no {sign} of {x!r} and {y!r}") from e

    return both


class _Sink:
    def __init__(self):
        self.parts: list[str] = []
        self.at, self.spans = 0, []

    def put(self, s: str) -> None:
        self.parts.append(s)
        self.at += len(s)


def _writer(nodes: list, escape) -> Callable[[dict, _Sink], None]:
    steps: list[Callable[[dict, _Sink], None]] = []
    for node in nodes:
        kind = node[0]
        if kind == "text":
            steps.append(lambda env, out, s=node[1]: out.put(s))
        elif kind == "out":
            steps.append(lambda env, out, f=_closure(node[1], escape): out.put(_said(f(env))))
        elif kind == "set":
            steps.append(lambda env, out, name=node[1], f=_closure(node[2], escape): env.__setitem__(name, f(env)))
        elif kind == "gen":

            def gen(env, out, inner=_writer(node[1], escape)):
                start = out.at
                inner(env, out)
                out.spans.append((start, out.at))

            steps.append(gen)
        elif kind == "for":

            def loop(env, out, name=node[1], over=_closure(node[2], escape), inner=_writer(node[3], escape)):
                items = over(env)
                if not isinstance(items, list):
                    raise TemplateError("only lists can be looped over")
                held = {k: env.get(k) for k in (name, "loop")}
                for i, item in enumerate(items):
                    env[name], env["loop"] = item, {"first": i == 0, "last": i + 1 == len(items), "index": i + 1}
                    inner(env, out)
                env.update(held)

            steps.append(loop)
        else:
            arms = [(_closure(c, escape), _writer(b, escape)) for c, b in node[1]]

            def branch(env, out, arms=arms):
                for cond, inner in arms:
                    if cond(env):
                        return inner(env, out)

            steps.append(branch)

    def write(env, out):
        for step in steps:
            step(env, out)

    return write


def compile_template(source: str, escape: Callable[[str], str] = lambda s: s) -> Callable[..., tuple[str, list[tuple[int, int]]]]:
    """A function of the template's names: render(messages=[...]) -> (text, generation stretches in code points)."""
    try:
        write = _writer(fold_body(parse(source), escape), escape)
    except RecursionError as e:
        raise TemplateError("the template is nested too deeply") from e

    def render(**names):
        out = _Sink()
        write(dict(names), out)
        return "".join(out.parts), out.spans

    return render
