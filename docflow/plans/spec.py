"""Mapping specification: which value of a document lands in which typed column.

A spec is a tree of :class:`FieldSpec`. Every field has a name, a type and a
path. It is built in Python or loaded from a JSON record schema whose fields
carry an ``xpath`` property (and optionally ``class`` for a field function).
The spec lives on the driver only; :mod:`docflow.plans.compile` turns it into
Spark ``Column`` expressions.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any, Union

from pyspark.sql import types as T

SCALARS = ("string", "int", "long", "float", "double", "boolean", "bytes", "date", "timestamp", "decimal")


class SpecError(ValueError):
    """A mapping spec that cannot be compiled (raised on the driver)."""


@dataclass(frozen=True)
class Scalar:
    kind: str
    precision: int = 38
    scale: int = 9
    unit: str = "millis"  # unit of epoch numbers in the text of a timestamp field
    symbols: tuple[str, ...] = ()  # a string field's only values (an enum)
    size: int | None = None  # a bytes field's exact length (a fixed)

    def __post_init__(self):
        if self.kind not in SCALARS:
            raise SpecError(f"unsupported scalar type {self.kind!r}; supported: {', '.join(SCALARS)}")
        if self.kind == "timestamp" and self.unit not in ("millis", "micros"):
            raise SpecError(f"timestamp unit must be 'millis' or 'micros', not {self.unit!r}")
        if self.kind == "decimal" and not (0 <= self.scale <= self.precision <= 38):
            raise SpecError(f"bad decimal({self.precision},{self.scale})")

    def spark_type(self) -> T.DataType:
        return {
            "string": T.StringType(),
            "int": T.IntegerType(),
            "long": T.LongType(),
            "float": T.FloatType(),
            "double": T.DoubleType(),
            "boolean": T.BooleanType(),
            "bytes": T.BinaryType(),
            "date": T.DateType(),
            "timestamp": T.TimestampType(),
        }.get(self.kind) or T.DecimalType(self.precision, self.scale)


@dataclass(frozen=True)
class Record:
    fields: tuple["FieldSpec", ...]
    name: str | None = None

    def spark_type(self) -> T.StructType:
        return T.StructType([f.struct_field() for f in self.fields])


@dataclass(frozen=True)
class ArrayOf:
    element: Union[Scalar, Record]

    def spark_type(self) -> T.ArrayType:
        return T.ArrayType(self.element.spark_type(), containsNull=True)


@dataclass(frozen=True)
class MapOf:
    """The selected nodes as a map: ``key`` is the path of a node's key, relative to it; a
    scalar ``value`` is the node's own text. Nodes without key are left out; of equal keys
    the first stays."""

    value: Union[Scalar, Record]
    key: str = "@key"

    def spark_type(self) -> T.MapType:
        return T.MapType(T.StringType(), self.value.spark_type(), True)


FieldType = Union[Scalar, Record, ArrayOf, MapOf]


@dataclass(frozen=True)
class FieldSpec:
    """One output column (or nested field).

    ``path`` is relative to the node selected by the enclosing record (the root
    element at the top level). ``function`` names a registered field function
    (see :mod:`docflow.functions.registry`). ``engine="xpath"`` evaluates an
    absolute XPath 1.0 expression with Spark's ``xpath`` function instead of the
    single-parse path compiler (top-level scalar and primitive-array fields only).
    ``text="first"`` takes the first text run of mixed content (also via xpath).
    """

    name: str
    type: FieldType
    path: str
    nullable: bool = True
    function: str | None = None
    engine: str = "path"
    text: str = "first"

    def __post_init__(self):
        if not self.name:
            raise SpecError("field without a name")
        if self.path is None:
            raise SpecError(f"field {self.name!r} has no path (xpath property missing)")
        if self.engine not in ("path", "xpath"):
            raise SpecError(f"field {self.name!r}: engine must be 'path' or 'xpath'")
        if self.text not in ("last", "first"):
            raise SpecError(f"field {self.name!r}: text must be 'last' or 'first'")
        if self.function is not None and not isinstance(self.type, Scalar):
            raise SpecError(f"field {self.name!r}: a field function needs a scalar type")

    def struct_field(self) -> T.StructField:
        return T.StructField(self.name, self.type.spark_type(), self.nullable)


@dataclass(frozen=True)
class MappingSpec:
    """Top-level record of a mapping. ``root`` is the root element name; it is
    the row tag of document files and the first step of ``engine="xpath"`` paths.
    ``elements``: paths of elements that no field names but a ``//`` looks into."""

    fields: tuple[FieldSpec, ...]
    root: str | None = None
    name: str | None = None
    elements: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict, compare=False)

    def to_struct(self) -> T.StructType:
        """Output table schema (types of the declared fields; union with null → nullable)."""
        return T.StructType([f.struct_field() for f in self.fields])

    def field(self, name: str) -> FieldSpec:
        for f in self.fields:
            if f.name == name:
                return f
        raise SpecError(f"no field {name!r} in spec; fields: {[f.name for f in self.fields]}")

    def prune(self, columns) -> "MappingSpec":
        """Keep only the named fields, in the order given. A dotted name
        ``rec.sub`` (``rec`` a record or an array of records, any depth) keeps
        only the named subfields of ``rec``, so the raw parse schema and the
        typed projection shrink with it; rules of the dropped subfields (such
        as required checks) are not evaluated. What they declare stays known to
        the ``//`` paths of the kept ones."""
        kept = _prune_fields(self.fields, list(columns), self.field)
        declared = tuple(_element_paths(self.fields)) if kept != self.fields and any(_descends(f) for f in kept) else ()
        return replace(self, fields=kept, elements=tuple(dict.fromkeys((*self.elements, *declared))))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


def _record_of(f: FieldSpec) -> Record | None:
    t = f.type.element if isinstance(f.type, ArrayOf) else f.type.value if isinstance(f.type, MapOf) else f.type
    return t if isinstance(t, Record) else None


def _descends(f: FieldSpec) -> bool:
    rec = _record_of(f)
    return "//" in f.path or (rec is not None and any(_descends(c) for c in rec.fields))


def _element_paths(fields, above: str = ""):
    """The element paths, from the root, that ``fields`` declare."""
    from .paths import parse_path

    for f in fields:
        if f.engine == "xpath":
            continue
        steps = parse_path(f.path, f.name)
        if any(s.descend for s in steps):
            continue
        path = "/".join([*([above] if above else []), *[s.name for s in steps if not s.attr]])
        if path:
            yield path
        rec = _record_of(f)
        if rec is not None:
            yield from _element_paths(rec.fields, path)


def _prune_fields(fields, names: list[str], lookup) -> tuple[FieldSpec, ...]:
    order: list[str] = []
    subs: dict[str, list[str] | None] = {}
    for n in names:
        head, _, rest = n.partition(".")
        if head not in subs:
            order.append(head)
            subs[head] = []
        if not rest:
            subs[head] = None  # the whole field
        elif subs[head] is not None:
            subs[head].append(rest)
    return tuple(_prune_field(lookup(h), subs[h]) if subs[h] else lookup(h) for h in order)


def _prune_field(f: FieldSpec, names: list[str]) -> FieldSpec:
    rec = f.type.element if isinstance(f.type, ArrayOf) else f.type
    if not isinstance(rec, Record):
        raise SpecError(f"field {f.name!r} has no subfields to select ({names})")

    def lookup(name: str) -> FieldSpec:
        for g in rec.fields:
            if g.name == name:
                return g
        raise SpecError(f"no field {name!r} in {f.name!r}; fields: {[g.name for g in rec.fields]}")

    pruned = replace(rec, fields=_prune_fields(rec.fields, names, lookup))
    return replace(f, type=ArrayOf(pruned) if isinstance(f.type, ArrayOf) else pruned)


# ---------------------------------------------------------------- builders

def scalar(kind: str, **kw) -> Scalar:
    return Scalar(kind, **kw)


def record(*fields: FieldSpec, name: str | None = None) -> Record:
    return Record(tuple(fields), name)


def array(element: Union[str, Scalar, Record]) -> ArrayOf:
    return ArrayOf(Scalar(element) if isinstance(element, str) else element)


def fld(name: str, type_: Union[str, FieldType], path: str, nullable: bool = True, **kw) -> FieldSpec:
    return FieldSpec(name, Scalar(type_) if isinstance(type_, str) else type_, path, nullable, **kw)


def spec(*fields: FieldSpec, root: str | None = None, name: str | None = None, elements: tuple[str, ...] = ()) -> MappingSpec:
    return MappingSpec(tuple(fields), root=root, name=name, elements=tuple(elements))


# ---------------------------------------------------------------- JSON loader

_PRIMITIVE = {"string", "int", "long", "float", "double", "boolean", "bytes"}


def _unwrap(t: Any) -> tuple[Any, bool]:
    """Union handling: ``["null", X]`` / ``[X, "null"]`` → (X, nullable)."""
    if isinstance(t, list):
        branches = [b for b in t if b != "null"]
        if len(branches) != 1:
            raise SpecError(f"unsupported union {t!r}: only a union of one type with null is allowed")
        return branches[0], len(branches) < len(t)
    return t, False


class _Names:
    """The named types of a schema: records, enums and fixed ones, by simple and full name.
    A type may be used wherever it stands after its definition (of several with one name
    the latest counts); a record that would hold itself is rejected, since a table's type
    can't be endless."""

    def __init__(self):
        self.known: dict[str, FieldType | None] = {}  # None: being read

    def names_of(self, t: dict, space: str) -> tuple[list[str], str]:
        name, space = t.get("name"), t.get("namespace", space)
        if not name:
            return [], space
        if "." in name:
            space = name.rpartition(".")[0]
            return [name, name.rpartition(".")[2]], space
        return [name, *([f"{space}.{name}"] if space else [])], space

    def define(self, t: dict, space: str, read) -> FieldType:
        names, space = self.names_of(t, space)
        if not names and t.get("type") != "record":
            raise SpecError(f"{t.get('type')} type without a name")
        self.known.update(dict.fromkeys(names))
        out = read(space)
        self.known.update(dict.fromkeys(names, out))
        return out

    def find(self, name: str, space: str) -> FieldType:
        for n in ([name] if "." in name else [f"{space}.{name}", name]):
            if n in self.known:
                if self.known[n] is None:
                    raise SpecError(f"record {name!r} holds itself: recursive types have no table type")
                return self.known[n]
        raise SpecError(f"unsupported type {name!r} (neither built in nor defined before)")


def _parse_type(t: Any, names: _Names, space: str = "") -> FieldType:
    if isinstance(t, str):
        return Scalar(t) if t in _PRIMITIVE else names.find(t, space)
    if not isinstance(t, dict):
        raise SpecError(f"unsupported type {t!r}")
    base, logical = t.get("type"), t.get("logicalType")
    if isinstance(base, (dict, list)):  # {"type": {"type": ...}}
        inner, _ = _unwrap(base)
        return _parse_type(inner, names, space)
    if base == "record":
        return names.define(t, space, lambda within: Record(tuple(_parse_field(f, names, within) for f in t.get("fields", [])), t.get("name")))
    if base == "enum":
        symbols = tuple(t.get("symbols", ()))
        if not symbols or not all(isinstance(x, str) for x in symbols):
            raise SpecError(f"enum {t.get('name')!r} needs a list of symbols")
        return names.define(t, space, lambda within: Scalar("string", symbols=symbols))
    if base == "fixed":
        size = t.get("size")
        if not isinstance(size, int) or size < 1:
            raise SpecError(f"fixed {t.get('name')!r} needs a size")
        if logical == "decimal":
            return names.define(t, space, lambda within: Scalar("decimal", precision=int(t.get("precision", 38)), scale=int(t.get("scale", 9))))
        return names.define(t, space, lambda within: Scalar("bytes", size=size))
    if base == "array":
        item, _ = _unwrap(t["items"])
        elem = _parse_type(item, names, space)
        if isinstance(elem, (ArrayOf, MapOf)):
            raise SpecError("arrays of arrays or maps are not supported")
        return ArrayOf(elem)
    if base == "map":
        item, _ = _unwrap(t["values"])
        value = _parse_type(item, names, space)
        if isinstance(value, (ArrayOf, MapOf)):
            raise SpecError("maps of arrays or maps are not supported")
        return MapOf(value, t.get("key", "@key"))
    if base in _PRIMITIVE:
        if logical is None:
            return Scalar(base)
        if base == "int" and logical == "date":
            return Scalar("date")
        if base == "long" and logical in ("timestamp-millis", "timestamp-micros"):
            return Scalar("timestamp", unit=t.get("unit", "millis"))
        if base == "bytes" and logical == "decimal":
            return Scalar("decimal", precision=int(t.get("precision", 38)), scale=int(t.get("scale", 9)))
        raise SpecError(f"unsupported logical type {logical!r} on {base!r}")
    if isinstance(base, str):
        return names.find(base, space)
    raise SpecError(f"unsupported type {base!r}")


def _parse_field(f: dict, names: _Names, space: str = "") -> FieldSpec:
    name = f.get("name")
    if "xpath" not in f or f["xpath"] is None:
        raise SpecError(f"field {name!r} has no 'xpath' property")
    t, nullable = _unwrap(f["type"])
    return FieldSpec(
        name=name,
        type=_parse_type(t, names, space),
        path=f["xpath"],
        nullable=nullable,
        function=f.get("class"),
        engine=f.get("engine", "path"),
        text=f.get("text", "first"),
    )


def from_json(obj: Union[str, dict]) -> MappingSpec:
    """Load a spec from a JSON record schema (text or parsed dict).

    Each field: ``{"name", "type", "xpath", ["class"], ["engine"], ["text"]}``;
    types are ``string int long float double boolean bytes``, ``{"type": "int",
    "logicalType": "date"}``, ``{"type": "long", "logicalType":
    "timestamp-millis"|"timestamp-micros"}`` (the text is epoch milliseconds unless
    ``"unit": "micros"``), ``{"type": "bytes", "logicalType": "decimal",
    "precision", "scale"}``, records, arrays, unions with ``"null"``, enums (a string of
    one of the ``symbols``), fixed (bytes of ``size``, or a decimal) and maps (``"key"``: the
    path of a node's key, by default ``@key``). Records, enums and fixed types that have a
    name can be used by it after their definition.
    """
    d = json.loads(obj) if isinstance(obj, str) else obj
    if d.get("type") != "record":
        raise SpecError("a mapping spec must be a record")
    return MappingSpec(
        _parse_type(d, _Names()).fields, root=d.get("root"), name=d.get("name"), elements=tuple(d.get("elements", ()))
    )


def load(path: Union[str, Path]) -> MappingSpec:
    """Read a spec file from the driver's file system (SRC-7)."""
    return from_json(Path(path).read_text())
