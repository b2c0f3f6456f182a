"""LKP-1: enrich a table from reference data, with a default for misses.

Semantics:

* left-outer equi-lookup: exactly one output row per input row;
* no match (including a null key) → ``default``;
* a key that is present with a null value gives null (a hit flag decides, not
  ``coalesce``);
* null keys in the reference never match;
* duplicate reference keys: ``on_duplicate="error"`` fails the job,
  ``"any"`` keeps one value per key; rows are never multiplied.

Plan: the reference side is reduced to one row per key (a hash aggregate with
map-side combine), then joined. It is broadcast only after an exact count
shows it is at most ``max_broadcast_rows`` rows and ``max_broadcast_bytes``
(as JSON text). Beyond that a filter of fixed size over the reference's keys
(:mod:`docflow.operators.membership`) is broadcast instead: rows that surely have no
match, null keys among them, take the default where they are, and only the others are
shuffled to a join, whose skewed keys AQE splits.
"""

from __future__ import annotations

from typing import Any, Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pyfields import row_function
from ..session import MAX_BROADCAST_BYTES, size_checked
from .membership import key_filter

DEFAULT = "UNKNOWN"
MAX_BROADCAST_ROWS = 2_000_000

_K, _V, _HIT, _N, _FOUND = "__lkp_key", "__lkp_value", "__lkp_hit", "__lkp_n", "__lkp_found"


def prepare_reference(ref: DataFrame, key: str, value: str, on_duplicate: str = "error") -> DataFrame:
    """One row per non-null key: (key, value, hit=true)."""
    if on_duplicate not in ("error", "any"):
        raise ValueError("on_duplicate must be 'error' or 'any'")
    r = ref.select(F.col(f"`{key}`").alias(_K), F.col(f"`{value}`").alias(_V)).where(F.col(_K).isNotNull())
    if on_duplicate == "any":
        r = r.groupBy(_K).agg(F.first(_V).alias(_V))
    else:
        r = r.groupBy(_K).agg(F.first(_V).alias(_V), F.count(F.lit(1)).alias(_N))
        dup = F.concat(F.lit("duplicate lookup key: "), F.col(_K).cast("string"))
        r = r.select(_K, F.when(F.col(_N) > 1, F.raise_error(dup)).otherwise(F.col(_V)).alias(_V))
    return r.withColumn(_HIT, F.lit(True))


def lookup_with_default(
    df: DataFrame,
    ref: DataFrame,
    key: str,
    ref_key: str,
    ref_value: str,
    out_col: str,
    *,
    default: object = DEFAULT,
    on_duplicate: str = "error",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    prefilter: bool = True,
) -> DataFrame:
    """``df`` with ``out_col`` (added, or replaced where it is) = the reference value
    of ``df[key]``, or ``default``.

    The reference is aggregated, written and measured when this function is
    called, not when the result runs: a stream keeps the reference of that
    moment until it is started anew."""
    reference = prepare_reference(ref, ref_key, ref_value, on_duplicate)
    r, small = size_checked(reference, max_broadcast_rows, max_bytes=max_broadcast_bytes)
    value: Column = F.when(F.col(_HIT), F.col(_V)).otherwise(F.lit(default))
    cols = [value.alias(c) if c == out_col else F.col(f"`{c}`") for c in df.columns]
    if out_col not in df.columns:
        cols.append(value.alias(out_col))
    data_key = F.col(f"`{key}`")
    if small:
        return df.join(F.broadcast(r), data_key == F.col(_K), "left").select(*cols)
    # a shuffle join would send all null keys, which match nothing, to one task: they go round
    # it, as does every row whose key the reference surely lacks
    may_match = data_key.isNotNull()
    held = key_filter(r, _K, r.count()) if prefilter and not df.isStreaming else None
    if held:
        may_match = held.may_hold(data_key.cast(r.schema[_K].dataType))
    matched = df.where(may_match).join(r.hint("shuffle_merge"), data_key == F.col(_K), "left")
    types = {f.name: f.dataType for f in r.schema}
    unmatched = df.where(~may_match).withColumns({_V: F.lit(None).cast(types[_V]), _HIT: F.lit(False)})
    return matched.select(*cols).unionByName(unmatched.select(*cols))


class Reference:
    """What user code captures: ``get(key)`` is the reference value, or the default."""

    def __init__(self, values: dict, default: Any):
        self.values, self.default = values, default

    def get(self, key: Any) -> Any:
        return self.values.get(key, self.default)


def apply_with_reference(
    df: DataFrame,
    fn: Callable[..., Any],
    inputs: Iterable[str],
    ref: DataFrame,
    key: str,
    ref_key: str,
    ref_value: str,
    out_col: str,
    return_type: T.DataType | str = "string",
    *,
    default: object = DEFAULT,
    on_duplicate: str = "error",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS // 4,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES // 4,
) -> DataFrame:
    """UDF-1: ``df`` with ``out_col`` = ``fn(reference, *inputs)``, user code per row that
    captures a reference table; ``reference.get(k)`` follows :func:`lookup_with_default`
    (null keys never match, a null value is a hit).

    The code runs in one Arrow function over batches. The reference is broadcast to the
    tasks as a dictionary if its measured size is within the bounds. Beyond them it isn't:
    the value of ``df[key]`` is looked up by a join first, and the code's reference knows
    that key alone, so code that asks for the row's ``key`` gives the same either way (and
    fails on another key)."""
    reference = prepare_reference(ref, ref_key, ref_value, on_duplicate).select(_K, _V)
    r, small = size_checked(reference, max_broadcast_rows, max_bytes=max_broadcast_bytes)
    kind = T._parse_datatype_string(return_type) if isinstance(return_type, str) else return_type
    given = [F.col(f"`{c}`") for c in inputs]
    if small:
        held = df.sparkSession.sparkContext.broadcast({row[_K]: row[_V] for row in r.toLocalIterator()})
        value = row_function(fn, lambda _: Reference(held.value, default), kind, [F.lit(True), *given])
        return df.withColumn(out_col, value)
    rows = lookup_with_default(
        df, r.select(_K, F.struct(F.col(_V).alias("value")).alias(_V)), key, _K, _V, _FOUND, default=None, on_duplicate="any",
        max_broadcast_rows=0,
    )
    asked = F.struct(F.col(f"`{key}`").alias("key"), F.col(_FOUND).alias("found"))
    return rows.withColumn(out_col, row_function(fn, lambda a: _OneKey(a, default), kind, [asked, *given])).drop(_FOUND)


class _OneKey(Reference):
    """The reference as far as one row's key goes."""

    def __init__(self, asked: dict, default: Any):
        super().__init__({} if asked["found"] is None else {asked["key"]: asked["found"]["value"]}, default)
        self.key = asked["key"]

    def get(self, key: Any) -> Any:
        if key is not None and key != self.key:
            raise KeyError(f"the reference is too large to broadcast: only the row's own key {self.key!r} is known, not {key!r}")
        return super().get(key)
