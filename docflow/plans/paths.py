"""Path grammar and the trie that merges all paths of a spec into one raw schema.

Supported paths (relative to the current node): ``.`` (the node's own text),
``@a`` (attribute), ``a`` / ``a/b/...`` (child elements, all matches in document
order), ``a/b/@c``, and

* conditions on a step: ``line[2]``, ``line[last()]``, ``line[last()-1]``,
  ``line[position()<=3]`` count among the parent's children of that name;
  ``line[@n]``, ``line[price]``, ``line[@n='2']``, ``line[price>10]``, ``line[.='x']``
  compare an attribute, a child's text (any child's) or the node's own text with a text or
  a number (``=  !=  <  <=  >  >=``); ``and``, ``or`` and ``not(...)`` combine them;
  several conditions apply one after the other, as in XPath;
* ``//name`` (also after a step): the elements of that name below the node, wherever
  the spec's own paths, or its list of ``elements``, declare an element that could hold
  one. Matches come place by place, in document order within each place.

Everything else (axes, functions, wildcards) is rejected with the field name, and can
go through ``engine="xpath"`` instead.

The raw schema given to ``from_xml`` keeps every match: each element is an
``array<struct>``; attributes are ``@name`` and element text is ``#text``
(names no XML element can have, so they never collide with element names).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

from .spec import ArrayOf, FieldSpec, MapOf, Record, SpecError

ATTR = "@"
TEXT = "#text"
XML_OPTIONS = {"attributePrefix": ATTR, "valueTag": TEXT, "ignoreSurroundingSpaces": "false"}

_LETTERS = r"[^\W\d][\w.\-·]*(?::[^\W\d][\w.\-·]*)?"  # letters of any script
_NAME = re.compile(_LETTERS)


@dataclass(frozen=True)
class Position:
    """The k-th node of its parent (1 first), from the end if ``last``; with ``op``, those
    whose number compares so with ``k``."""

    k: int
    last: bool = False
    op: str = "="


@dataclass(frozen=True)
class Compare:
    """``operand`` (``@a``, ``.`` or a child's name) against a text or number, or its mere existence."""

    operand: str
    op: str | None = None
    value: str | float | None = None


@dataclass(frozen=True)
class Logic:
    """``and`` / ``or`` / ``not`` of conditions."""

    kind: str
    parts: tuple


@dataclass(frozen=True)
class Step:
    name: str
    attr: bool = False
    tests: tuple = ()
    descend: bool = False


_TOKEN = re.compile(rf"""\s*(?:(last\(\)|position\(\))|(not)\s*\(|(<=|>=|!=|[=<>()\-])|'([^']*)'|"([^"]*)"|(\d+(?:\.\d+)?)|(@{_LETTERS}|{_LETTERS}|\.))""")
_FLIP = {"=": "=", "!=": "!=", "<": ">", "<=": ">=", ">": "<", ">=": "<="}


def _tokens(text: str) -> list[tuple[str, str]]:
    kinds, out, at = ("call", "not", "op", "text", "text", "number", "operand"), [], 0
    while text[at:].strip():
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"cannot read {text[at:]!r}")
        i = m.lastindex
        out.append((kinds[i - 1], m.group(i)))
        at = m.end()
    return out


class _Condition:
    """Reads one condition: ``or`` of ``and`` of comparisons."""

    def __init__(self, text: str):
        self.rest = _tokens(text)

    def read(self):
        out = self.joined("or", lambda: self.joined("and", self.single))
        if self.rest:
            raise ValueError(f"{self.rest[0][1]!r} not expected")
        return out

    def joined(self, word: str, part):
        parts = [part()]
        while self.rest and self.rest[0] == ("operand", word):
            self.rest.pop(0)
            parts.append(part())
        return parts[0] if len(parts) == 1 else Logic(word, tuple(parts))

    def take(self, kind: str | None = None, value: str | None = None) -> tuple[str, str]:
        if not self.rest or (kind and self.rest[0][0] != kind) or (value and self.rest[0][1] != value):
            raise ValueError(f"{value or kind or 'more'} expected")
        return self.rest.pop(0)

    def single(self):
        kind, value = self.take()
        if kind == "not" or (kind, value) == ("op", "("):
            inner = self.joined("or", lambda: self.joined("and", self.single))
            self.take("op", ")")
            return Logic("not", (inner,)) if kind == "not" else inner
        if (kind, value) == ("call", "last()"):
            back = 0
            if self.rest and self.rest[0] == ("op", "-"):
                self.take()
                back = self.whole(self.take("number")[1])
            return Position(back + 1, last=True)
        op = None
        if self.rest and self.rest[0][0] == "op" and self.rest[0][1] in _FLIP:
            op = self.take()[1]
        if (kind, value) == ("call", "position()"):
            if op is None:
                raise ValueError("position() without a comparison")
            return Position(self.whole(self.take("number")[1]), op=op)
        if kind == "number" and op is None:
            return Position(self.whole(value))
        if kind == "operand":
            return Compare(value) if op is None else Compare(value, op, self.literal(*self.take()))
        if op is not None and kind in ("text", "number"):  # literal first
            return Compare(self.take("operand")[1], _FLIP[op], self.literal(kind, value))
        raise ValueError(f"{value!r} not expected")

    def literal(self, kind: str, value: str) -> str | float:
        if kind not in ("text", "number"):
            raise ValueError(f"a text or a number expected, not {value!r}")
        return float(value) if kind == "number" else value

    def whole(self, value: str) -> int:
        if "." in value:
            raise ValueError("positions are whole numbers")
        return int(value)


def _parts(path: str) -> list[str]:
    """``path`` cut at the slashes outside conditions and quotes; an empty part stands before ``//``."""
    out, depth, quote = [""], 0, ""
    for c in path:
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"" and depth:
            quote = c
        elif c == "[":
            depth += 1
        elif c == "]":
            depth -= 1
        if c == "/" and not depth:
            out.append("")
        else:
            out[-1] += c
    if depth or quote:
        raise ValueError("a condition is not closed")
    return out


_CONDITION = re.compile(r"""\[((?:[^\[\]'"]|'[^']*'|"[^"]*")*)\]""")


def _step(part: str, last: bool, descend: bool) -> Step:
    attr = part.startswith("@")
    m = re.match(r"@?([^\[]*)", part)
    name, rest, tests = m.group(1).strip(), part[m.end() :].strip(), []
    while rest:
        c = _CONDITION.match(rest)
        if not c:
            raise ValueError(f"cannot read the condition {rest!r}")
        tests.append(_Condition(c.group(1)).read())
        rest = rest[c.end() :].strip()
    if not _NAME.fullmatch(name) or (attr and (not last or tests or descend)):
        raise ValueError(f"no step: {part!r}")
    return Step(name, attr, tuple(tests), descend)


def parse_path(path: str, field_name: str = "?") -> list[Step]:
    """``'a/b/@c'`` → ``[Step(a), Step(b), Step(c, attr=True)]``; ``'.'`` → ``[]``."""
    p = path.strip()
    if p.startswith(".//"):
        p = p[1:]
    elif p.startswith("./"):
        p = p[2:]
    if p in (".", ""):
        if p == "":
            raise SpecError(f"field {field_name!r}: empty path")
        return []
    try:
        parts = _parts(p)
        if parts[0] == "" and parts[1:2] == [""]:
            parts = parts[1:]  # a leading //
        elif parts[0] == "":
            raise ValueError("an absolute path")
        steps, descend = [], False
        for i, part in enumerate(parts):
            if part == "" and not descend and i < len(parts) - 1:
                descend = True
                continue
            steps.append(_step(part.strip(), i == len(parts) - 1, descend))
            descend = False
    except ValueError as e:
        raise SpecError(
            f"field {field_name!r}: unsupported path {path!r} ({e}); the path compiler accepts '.', '@a', 'a', 'a/b/...', 'a/b/@c', "
            "conditions and '//a' (use engine='xpath' for other XPath expressions)"
        ) from None
    return steps


@dataclass
class Node:
    attrs: set = field(default_factory=set)
    text: bool = False
    children: dict = field(default_factory=dict)
    #: per name asked for by ``//name`` from here: the paths (of names) of the elements that could hold it
    places: dict = field(default_factory=dict)

    def child(self, name: str) -> "Node":
        return self.children.setdefault(name, Node())

    def walk(self, steps: list[Step]) -> "Node":
        """The node that ``steps`` end at, with what their conditions read."""
        node = self
        for s in steps:
            node = node.below(s.name) if s.descend else node.child(s.name)
            for t in s.tests:
                node.read(t)
        return node

    def read(self, test) -> None:
        if isinstance(test, Logic):
            for part in test.parts:
                self.read(part)
        elif isinstance(test, Compare):
            if test.operand == ".":
                self.text = True
            elif test.operand.startswith("@"):
                self.attrs.add(test.operand[1:])
            else:
                self.child(test.operand).text = True

    def below(self, name: str) -> "Node":
        """One node for all elements ``name`` that the elements declared here and below
        could hold (not those inside another of that name)."""
        if name not in self.places:
            self.places[name] = list(self.paths(name))
            shared = Node()
            for path in self.places[name]:
                holder = self
                for n in path:
                    holder = holder.children[n]
                shared.merge(holder.children.get(name))
                holder.children[name] = shared
        holder = self
        for n in self.places[name][0]:
            holder = holder.children[n]
        return holder.children[name]

    def paths(self, name: str):
        yield ()
        for n, c in list(self.children.items()):
            if n != name:
                for rest in c.paths(name):
                    yield (n, *rest)

    def merge(self, other: "Node | None") -> None:
        if other is None or other is self:
            return
        self.attrs |= other.attrs
        self.text |= other.text
        self.places |= other.places
        for n, c in other.children.items():
            if n in self.children:
                self.children[n].merge(c)
            else:
                self.children[n] = c

    def struct(self) -> T.StructType:
        fields = [T.StructField(ATTR + a, T.StringType()) for a in sorted(self.attrs)]
        if self.text or not (self.attrs or self.children):
            fields.append(T.StructField(TEXT, T.ArrayType(T.StringType())))  # every run of its own text
        fields += [T.StructField(n, T.ArrayType(c.struct())) for n, c in self.children.items()]
        return T.StructType(fields)

    def array_type(self) -> T.ArrayType:
        return T.ArrayType(self.struct())


def add_fields(node: Node, fields, descending: bool) -> None:
    """Register the paths of ``fields`` (relative to ``node``) in the trie: those without
    ``//`` first (they declare the elements that a ``//`` looks into), then the others."""
    for f in fields:
        if f.engine == "xpath":
            continue  # evaluated on the document text, not on the raw struct
        steps = parse_path(f.path, f.name)
        if any(s.descend for s in steps) and not descending:
            continue
        t = f.type.element if isinstance(f.type, ArrayOf) else f.type.value if isinstance(f.type, MapOf) else f.type
        if isinstance(f.type, MapOf):
            if not steps or steps[-1].attr:
                raise SpecError(f"field {f.name!r}: a map's path must select elements, not {f.path!r}")
            entry, key = node.walk(steps), parse_path(f.type.key, f.name)
            if key and key[-1].attr:
                entry.walk(key[:-1]).attrs.add(key[-1].name)
            else:
                entry.walk(key).text = True
        if isinstance(t, Record):
            if steps and steps[-1].attr:
                raise SpecError(f"field {f.name!r}: a record path must select elements, not {f.path!r}")
            add_fields(node.walk(steps), t.fields, descending)
        elif steps and steps[-1].attr:
            node.walk(steps[:-1]).attrs.add(steps[-1].name)
        else:
            node.walk(steps).text = True


def case_clashes(schema: T.StructType) -> list[tuple[str, str]]:
    """Sibling names of a raw schema that differ only in case."""
    seen: dict[str, str] = {}
    out = []
    for f in schema.fields:
        other = seen.setdefault(f.name.lower(), f.name)
        if other != f.name:
            out.append((other, f.name))
        t = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if isinstance(t, T.StructType):
            out += case_clashes(t)
    return out


def build_trie(fields: tuple[FieldSpec, ...], elements: tuple[str, ...] = ()) -> Node:
    """The trie of all paths; ``elements``: paths of further elements that ``//`` looks into."""
    root = Node()
    for path in elements:
        root.walk(parse_path(path, "elements"))
    add_fields(root, fields, False)
    add_fields(root, fields, True)
    return root
