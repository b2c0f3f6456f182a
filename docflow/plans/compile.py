"""Compile a :class:`MappingSpec` into Spark ``Column`` expressions.

The document is parsed once by ``from_xml`` into a raw struct (see
:mod:`docflow.plans.paths`); every field is then a pure expression over that
struct, evaluated in the JVM by a generated projection (higher-order functions
such as ``transform`` run interpreted inside it); no Python runs per row:

* scalar field: first non-empty match, converted (null if none);
* record: first matching node as a struct of its own fields (null if none);
* array of primitive: all non-empty matches, converted; **null** if none;
* array of records: all matching nodes; **empty array** if none;
* nested paths are relative to the node their record selected.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import registry
from ..functions.convert import STRICT, convert, convert_array
from .paths import ATTR, TEXT, Compare, Logic, Node, Position, Step, build_trie, parse_path
from .spec import ArrayOf, FieldSpec, MapOf, MappingSpec, Record, Scalar, SpecError


PYTHON = "__docflow_python"


def _empty_strings() -> Column:
    return F.array().cast(T.ArrayType(T.StringType()))


@dataclass
class Options:
    mode: str = STRICT  # conversion errors and missing required fields: raise ("strict") or null
    doc: Column | None = None  # document text, for xpath-evaluated fields
    # Values that several expressions read (first matches, first nodes) are
    # collected here and computed once in a projection of their own; the typed
    # projection then reads them as plain columns. None: compute in place.
    stage: list | None = None
    # Calls of Python field functions: (function, matches, type, one per record of an
    # array?); their results are the fields of one struct column.
    python: list = field(default_factory=list)

    def called(self, fn, matches: Column, kind: T.DataType, many: bool) -> Column:
        self.python.append((fn, matches, kind, many))
        return F.col(PYTHON).getField(f"f{len(self.python) - 1}")

    def staged(self, value: Column) -> Column:
        if self.stage is None:
            return value
        name = f"__docflow_v{len(self.stage)}"
        self.stage.append(value.alias(name))
        return F.col(name)


def _text_value(node: Column) -> Column:
    return F.coalesce(F.array_join(node.getField(TEXT), ""), F.lit(""))


_OPS = {"=": "__eq__", "!=": "__ne__", "<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__"}


def _holds(value: Column, test: Compare) -> Column:
    if test.op is None:
        return value.isNotNull()
    if isinstance(test.value, float) or test.op not in ("=", "!="):  # as numbers; what is none compares with nothing
        value, literal = F.trim(value).try_cast("double"), F.lit(test.value).try_cast("double")
    else:
        literal = F.lit(test.value)
    return F.coalesce(getattr(value, _OPS[test.op])(literal), F.lit(False))


def _condition(node: Column, number: Column, size: Column, test) -> Column:
    """Whether ``node``, the ``number``-th of ``size``, meets ``test``."""
    if isinstance(test, Logic):
        parts = [_condition(node, number, size, t) for t in test.parts]
        if test.kind == "not":
            return ~parts[0]
        return functools.reduce(lambda a, b: a & b if test.kind == "and" else a | b, parts)
    if isinstance(test, Position):
        return number == size + 1 - test.k if test.last else getattr(number, _OPS[test.op])(F.lit(test.k))
    if test.operand == ".":
        return _holds(_text_value(node), test)
    if test.operand.startswith("@"):
        return _holds(node.getField(ATTR + test.operand[1:]), test)
    return F.coalesce(F.exists(node.getField(test.operand), lambda c: _holds(_text_value(c), test)), F.lit(False))


def _tested(nodes: Column, tests: tuple) -> Column:
    """The nodes of one parent that meet all ``tests``, applied one after the other."""
    for t in tests:
        if isinstance(t, Position) and t.last:
            nodes = F.slice(nodes, -t.k, 1)
        elif isinstance(t, Position) and t.op == "=":
            nodes = F.slice(nodes, t.k, 1) if t.k > 0 else F.slice(nodes, 1, 0)
        else:
            # the parent's nodes are bound once: a condition may ask for their number
            nodes = F.get(F.transform(F.array(nodes), _filter_by(t)), 0)
    return nodes


def _filter_by(test):
    return lambda nodes: F.filter(nodes, lambda x, i: _condition(x, i + 1, F.size(nodes), test))


def _down(nodes: Column, single: bool, name: str, tests: tuple = ()) -> Column:
    """The children ``name`` of one node, or of all nodes of an array, that meet ``tests``."""
    if single:
        return _tested(nodes.getField(name), tests)
    children = F.array_compact(nodes.getField(name))
    if tests:
        children = F.transform(children, lambda a: _tested(a, tests))
    return F.flatten(children)


def select_nodes(ctx: Column, steps: list[Step], node: Node, single: bool = True) -> Column:
    """All element nodes selected by ``steps`` (one at least) from ``ctx``, which is a
    struct or, not ``single``, an array of them: ``array<struct>`` or null."""
    nodes = ctx
    for s in steps:
        if not s.descend:
            nodes, node = _down(nodes, single, s.name, s.tests), node.children[s.name]
        else:
            found = []
            for path in node.places[s.name]:
                holder, one = nodes, single
                for n in path:
                    holder, one = _down(holder, one, n), False
                found.append(_down(holder, one, s.name, s.tests))
            node = node.below(s.name)
            if len(found) > 1:
                empty = F.array().cast(node.array_type())
                found = [F.concat(*[F.coalesce(f, empty) for f in found])]
            nodes = found[0]
        single = False
    return nodes


def node_matches(ctx: Column, steps: list[Step], node: Node) -> Column:
    """All element nodes selected by ``steps`` from ``ctx``: ``array<struct>`` or null."""
    return select_nodes(ctx, steps, node) if steps else F.array(ctx)


def _run(runs: Column, which: str) -> Column:
    """One text run of a node: its first or its last, null if it has none."""
    return F.get(runs, 0) if which == "first" else F.try_element_at(runs, F.lit(-1))


def value_matches(ctx: Column, steps: list[Step], node: Node, text: str = "first") -> Column:
    """Non-empty text / attribute values selected by ``steps``: ``array<string>`` or null."""
    if steps and steps[-1].attr:
        key, elems = ATTR + steps[-1].name, steps[:-1]
        if not elems:
            return F.array_compact(F.array(ctx.getField(key)))
        return F.array_compact(node_matches(ctx, elems, node).getField(key))
    if not steps:
        return F.array_compact(F.array(_run(ctx.getField(TEXT), text)))
    runs = F.array_compact(node_matches(ctx, steps, node).getField(TEXT))
    return F.transform(runs, lambda r: _run(r, text))


def first_node(ctx: Column, steps: list[Step], node: Node) -> Column:
    """First element node selected by ``steps`` (a struct, or null)."""
    return F.get(select_nodes(ctx, steps, node), 0) if steps else ctx


def first_value(ctx: Column, steps: list[Step], node: Node, text: str = "first") -> tuple[Column, bool]:
    """First non-empty value selected by ``steps``, and whether it is a plain field read."""
    if not steps:
        return _run(ctx.getField(TEXT), text), True
    if steps[-1].attr and len(steps) == 1:
        return ctx.getField(ATTR + steps[-1].name), True
    key, elems = (ATTR + steps[-1].name, steps[:-1]) if steps[-1].attr else (TEXT, steps)
    values = select_nodes(ctx, elems, node).getField(key)
    pick = (lambda v: v) if steps[-1].attr else (lambda v: _run(v, text))
    # the first match usually has a value; look further only when it does not
    return F.coalesce(pick(F.get(values, 0)), pick(F.get(F.array_compact(values), 0))), False


def first_string_value(ctx: Column, steps: list[Step], node: Node) -> Column:
    """Own text of the first selected node, all runs joined, or its attribute value ('' when none)."""
    if steps and steps[-1].attr:
        v = F.get(value_matches(ctx, steps, node), 0)
    else:
        v = F.array_join(first_node(ctx, steps, node).getField(TEXT), "")
    return F.coalesce(v, F.lit(""))


def _required(col: Column, f: FieldSpec, opts: Options, where: str) -> Column:
    if f.nullable or opts.mode != STRICT:
        return col
    return F.coalesce(col, F.raise_error(F.lit(f"missing required field {where}{f.name} (path {f.path!r})")))


def _xpath_values(f: FieldSpec, opts: Options) -> Column:
    if opts.doc is None:
        raise SpecError(f"field {f.name!r}: xpath evaluation needs the document column")
    values = F.xpath(opts.doc, F.lit(f.path))  # element nodes come back as null: use .../text()
    if "@" in f.path:
        return F.filter(values, lambda x: x.isNotNull())
    return F.filter(values, lambda x: x.isNotNull() & (x != ""))


def _python(f: FieldSpec):
    """The Python function of a field, if it has one."""
    fn = registry.lookup(f.function) if f.function else None
    return fn.fn if isinstance(fn, registry.PythonFunction) else None


def _python_input(f: FieldSpec, ctx: Column, node: Node) -> Column:
    """What a Python field function gets: the matches' texts and the first one's string value."""
    steps = parse_path(f.path, f.name)
    values = F.coalesce(value_matches(ctx, steps, node, f.text), _empty_strings())
    return F.when(ctx.isNotNull(), F.struct(values.alias("values"), first_string_value(ctx, steps, node).alias("string")))


def compile_field(f: FieldSpec, ctx: Column, node: Node, opts: Options, where: str = "", in_lambda: bool = False) -> Column:
    t = f.type
    what = f"field {where}{f.name}"
    python = _python(f)
    if python:
        if in_lambda or f.engine == "xpath":
            raise SpecError(f"{what}: a Python field function stands at the top level, in records, or directly in an array of records of those")
        return _required(opts.called(python, _python_input(f, ctx, node), t.spark_type(), False), f, opts, where)
    if f.engine == "xpath":
        if where:
            raise SpecError(f"field {where}{f.name}: xpath evaluation is for top-level fields only")
        if isinstance(t, Record) or (isinstance(t, ArrayOf) and isinstance(t.element, Record)):
            raise SpecError(f"field {f.name!r}: xpath evaluation gives text values, not records")
        values = _xpath_values(f, opts)
        # XPath string value of the first node: all of its descendant text
        string_value = F.xpath_string(opts.doc, F.lit(f.path))
        out = _typed_values(f, values, string_value, opts, what)
        return _required(out, f, opts, where)

    steps = parse_path(f.path, f.name)
    if isinstance(t, MapOf):
        return _required(_map(f, ctx, steps, node, opts, where), f, opts, where)
    if isinstance(t, Record) or (isinstance(t, ArrayOf) and isinstance(t.element, Record)):
        rec = t if isinstance(t, Record) else t.element
        sub = node.walk(steps)
        if isinstance(t, Record):
            first = first_node(ctx, steps, node)
            if steps and not in_lambda:
                first = opts.staged(first)
            body = _record(rec, first, sub, opts, f"{where}{f.name}.", in_lambda)
            out = F.when(first.isNotNull(), body)
        else:
            nodes = F.coalesce(node_matches(ctx, steps, node), F.array().cast(sub.array_type()))
            calls = {}
            for c in rec.fields:
                if _python(c) and not in_lambda and c.engine == "path":
                    given = F.transform(nodes, _inputs_of(c, sub))
                    calls[c.name] = opts.called(_python(c), given, c.type.spark_type(), True)
            inner = f"{where}{f.name}[]."
            if calls:
                out = F.transform(nodes, lambda x, i: _record(rec, x, sub, opts, inner, True, {n: F.get(v, i) for n, v in calls.items()}))
            else:
                out = F.transform(nodes, lambda x: _record(rec, x, sub, opts, inner, True))
        return _required(out, f, opts, where)

    if isinstance(t, Scalar) and not f.function:
        first, plain = first_value(ctx, steps, node, f.text)
        if plain or (t.kind in ("string", "boolean", "bytes") and not t.symbols and t.size is None):  # read once by the converter
            out = convert(first, t, opts.mode, what)
        elif not in_lambda:  # computed once in the staging projection
            out = convert(opts.staged(first), t, opts.mode, what)
        else:  # inside a lambda: bind the first match once
            out = F.get(F.transform(F.array(first), lambda x: convert(x, t, opts.mode, what)), 0)
        return _required(out, f, opts, where)
    values = value_matches(ctx, steps, node, f.text)
    string_value = first_string_value(ctx, steps, node) if f.function else None
    return _required(_typed_values(f, values, string_value, opts, what), f, opts, where)


def _map(f: FieldSpec, ctx: Column, steps: list[Step], node: Node, opts: Options, where: str) -> Column:
    """The selected nodes as a map, empty if there are none; of equal keys the first."""
    t, sub = f.type, node.walk(steps)
    nodes = F.coalesce(node_matches(ctx, steps, node), F.array().cast(sub.array_type()))
    inner = f"{where}{f.name}{{}}."
    value = FieldSpec("value", t.value, ".")

    def entry(x: Column) -> Column:
        key = first_value(x, parse_path(t.key, f.name), sub)[0]
        held = _record(t.value, x, sub, opts, inner, True) if isinstance(t.value, Record) else compile_field(value, x, sub, opts, inner, True)
        return F.struct(key.alias("key"), held.alias("value"))

    def unique(entries: Column) -> Column:
        keys = entries.getField("key")
        return F.filter(entries, lambda e, i: F.array_position(keys, e.getField("key")) == i + 1)

    entries = F.filter(F.transform(nodes, entry), lambda e: e.getField("key").isNotNull())
    return F.when(ctx.isNotNull(), F.map_from_entries(F.get(F.transform(F.array(entries), unique), 0)))


def _inputs_of(f: FieldSpec, node: Node):
    return lambda x: _python_input(f, x, node)


def _typed_values(f: FieldSpec, values: Column, string_value: Column | None, opts: Options, what: str) -> Column:
    t = f.type
    if f.function:
        fn = registry.lookup(f.function)
        m = registry.Matches(values=F.coalesce(values, _empty_strings()), string_value=string_value)
        return fn(m).try_cast(t.spark_type())
    if isinstance(t, ArrayOf):
        return F.when(F.size(values) > 0, convert_array(values, t.element, opts.mode, what))
    assert isinstance(t, Scalar)
    return convert(F.get(values, 0), t, opts.mode, what)


def _record(rec: Record, ctx: Column, node: Node, opts: Options, where: str, in_lambda: bool, given: dict | None = None) -> Column:
    given = given or {}
    values = [_required(given[c.name], c, opts, where) if c.name in given else compile_field(c, ctx, node, opts, where, in_lambda) for c in rec.fields]
    return F.struct(*[v.alias(c.name) for v, c in zip(values, rec.fields, strict=True)])


def raw_schema(s: MappingSpec) -> T.StructType:
    """The ``from_xml`` schema that keeps every match the spec needs, and nothing else."""
    return build_trie(s.fields, s.elements).struct()


def needs_document_text(s: MappingSpec) -> bool:
    return any(f.engine == "xpath" for f in s.fields)


def compile_spec(s: MappingSpec, raw: Column, opts: Options | None = None) -> list[Column]:
    """One aliased ``Column`` per top-level field of ``s``, over the raw struct ``raw``."""
    opts = opts or Options()
    trie = build_trie(s.fields, s.elements)
    return [compile_field(f, raw, trie, opts).alias(f.name) for f in s.fields]
