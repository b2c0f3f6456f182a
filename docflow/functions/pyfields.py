"""User code in Python over Arrow batches: field functions of a spec (UDF-2, XML-11) and
scalar functions with a captured reference (UDF-1)."""

from __future__ import annotations

from typing import Any, Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def to_column(values: list, kind: pa.DataType) -> pa.Array:
    """``values`` as an Arrow array; what the type can't hold becomes null."""
    try:
        return pa.array(values, kind)
    except (pa.ArrowException, TypeError, ValueError, OverflowError):
        return pa.array([_held(v, kind) for v in values], kind)


def _held(value: Any, kind: pa.DataType) -> Any:
    try:
        return pa.scalar(value, kind).as_py()
    except (pa.ArrowException, TypeError, ValueError, OverflowError):
        if pa.types.is_list(kind) and isinstance(value, list):
            return [_held(v, kind.value_type) for v in value]
        return None


def _python_values(values: pa.Array) -> list:
    """The values of a flat array, made by Arrow in one go (much less work than ``to_pylist``)."""
    return values.to_numpy(zero_copy_only=False).tolist()


def _lists(given: pa.ListArray) -> tuple[pa.Array, list]:
    """The elements of all lists one after the other, and the place of every list among
    them: list ``i`` has the elements from ``places[i]`` to ``places[i + 1]``."""
    places = given.offsets.to_numpy()
    return given.values.slice(places[0], places[-1] - places[0]), (places - places[0]).tolist()


def _called(fn: Callable[[list, str], Any], matches: pa.StructArray) -> list:
    """``fn(values, string)`` of every match struct, null for null."""
    if not len(matches):
        return []
    elements, places = _lists(matches.field("values"))
    texts, strings = _python_values(elements), _python_values(matches.field("string"))
    held = _python_values(matches.is_valid())
    out = []
    for i, (string, there) in enumerate(zip(strings, held, strict=True)):
        value = None
        if there:
            try:
                value = fn(texts[places[i] : places[i + 1]], string)
            except Exception:  # noqa: BLE001  an error of the user's function is null for this document
                value = None
        out.append(value)
    return out


def _called_many(fn: Callable[[list, str], Any], matches: pa.ListArray, kind: pa.ListType) -> pa.Array:
    """The same for arrays of match structs: arrays of values."""
    if not len(matches):
        return pa.array([], kind)
    elements, places = _lists(matches)
    values = to_column(_called(fn, elements), kind.value_type)
    return pa.ListArray.from_arrays(pa.array(places, pa.int32()), values, type=kind, mask=matches.is_null())


def python_fields(calls: list[tuple[Callable, Column, T.DataType, bool]]) -> Column:
    """One Arrow function for all ``calls``: (function, matches, type, is it an array of
    matches, one per record?). A struct of fields ``f0``, ``f1``, ..."""
    functions = [(fn, many) for fn, _, _, many in calls]
    fields = [T.StructField(f"f{i}", T.ArrayType(t) if many else t) for i, (_, _, t, many) in enumerate(calls)]
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(inputs: pa.Array) -> pa.Array:
        out = []
        for i, (fn, many) in enumerate(functions):
            matches = inputs.field(i)
            out.append(_called_many(fn, matches, kinds[i]) if many else to_column(_called(fn, matches), kinds[i]))
        return pa.StructArray.from_arrays(out, names=[f.name for f in fields])

    given = F.struct(*[matches.alias(f"f{i}") for i, (_, matches, _, _) in enumerate(calls)])
    return F.arrow_udf(run, T.StructType(fields))(given)


def row_function(fn: Callable[..., Any], lookup_of: Callable[[Any], Any], return_type: T.DataType, inputs: Iterable[Column]) -> Column:
    """``fn(lookup, *values)`` of every row; ``lookup_of(first input)`` gives the lookup. Errors fail the job."""
    kind = to_arrow_type(return_type)

    def run(rows: pa.Array) -> pa.Array:
        columns = [rows.field(i).to_pylist() for i in range(rows.type.num_fields)]
        return pa.array([fn(lookup_of(first), *rest) for first, *rest in zip(*columns, strict=True)], kind)

    given = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(inputs)])
    return F.arrow_udf(run, return_type)(given)
