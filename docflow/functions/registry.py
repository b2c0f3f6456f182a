"""Field functions looked up by name (the ``class`` property of a spec field).

A field function receives the matches of the field's path and returns a
``Column``; the result is cast (``try_cast``) to the field's declared type.
A function that fails yields null for that field, as the declarative parser
does for plug-in fields. Functions are plain ``Column`` builders, so they run
inside the same JVM projection as the rest of the extraction.

Where built-in expressions can't say it, a field function is plain Python
(:func:`register_python`): it gets the texts of a document's matches and returns the
field's value. All Python fields of a spec are evaluated in one Arrow pass over their
matches, between the one parse and the typed projection; an error of the function, or a
value that the declared type can't hold, is null for that document only.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.spec import SpecError


@dataclass(frozen=True)
class Matches:
    values: Column  # array<string>: non-empty texts or attribute values, document order, never null
    string_value: Column  # text (or attribute value) of the first matched node, '' when none


@dataclass(frozen=True)
class PythonFunction:
    """``fn(values, string_value)``: the matches' texts in document order, and the first one's string value."""

    fn: Callable[[list, str], Any]


FieldFunction = Callable[[Matches], Column]
_REGISTRY: dict[str, FieldFunction | PythonFunction] = {}


def register(name: str, fn: FieldFunction | None = None):
    """Register ``fn`` under ``name``; usable as a decorator."""
    def put(f):
        _REGISTRY[name] = f
        return f
    return put(fn) if fn is not None else put


def register_python(name: str, fn: Callable[[list, str], Any] | None = None):
    """Register ``fn(values, string_value)`` as the Python field function ``name``; usable as a decorator."""
    def put(f):
        _REGISTRY[name] = PythonFunction(f)
        return f
    return put(fn) if fn is not None else put


def lookup(name: str) -> FieldFunction | PythonFunction:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise SpecError(f"unknown field function {name!r}; registered: {sorted(_REGISTRY)}") from None


def registered() -> list[str]:
    return sorted(_REGISTRY)


@register("string_length")
def string_length(m: Matches) -> Column:
    """Length of the string value of the path; 0 when nothing matches (FN-2).
    Counts code points (a UTF-16 count differs only outside the BMP)."""
    return F.length(m.string_value)


@register("sum_values")
def sum_values(m: Matches) -> Column:
    """Integer sum of all matches; 0 when none; null if a value is not an integer
    (AGG-3). Summed in bigint, then narrowed to the declared type."""
    as_long = F.transform(
        m.values, lambda x: F.when(x.rlike(r"^[+-]?[0-9]+\z"), x.try_cast("int").cast("bigint"))
    )
    return F.aggregate(as_long, F.lit(0).cast("bigint"), lambda acc, x: F.try_add(acc, x))
