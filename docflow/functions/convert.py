"""Text → typed value converters (JVM-side expressions, no Python per row).

Each converter maps a string ``Column`` to the declared type and follows the
conversion rules of the declarative extraction:

* int / long: optional sign and digits only (no blanks), range-checked;
* float / double: Spark's numeric parsing;
* boolean: ``true`` only for the text "true" in any case, anything else false;
* date: epoch days; timestamp: epoch milliseconds (or microseconds);
* bytes: UTF-8 bytes of the text;
* decimal: exact; more fraction digits than the scale is an error, never rounded.

``mode="strict"`` raises on text that does not convert; ``"permissive"`` gives
null. Neither depends on the session's ``spark.sql.ansi.enabled``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.spec import Scalar

STRICT, PERMISSIVE = "strict", "permissive"

_INTEGER_TEXT = r"^[+-]?[0-9]+\z"
_FRACTION = r"^\s*[+-]?[0-9]*[.]([0-9]*?)0*\s*\z"


def _guard(s: Column, checked: Column, mode: str, what: str) -> Column:
    """``checked`` is the converted value, null where the text does not convert.
    Permissive: as is. Strict: an error where the text is not null but
    ``checked`` is. ``checked`` appears once, so it is evaluated once even inside
    a lambda (where Catalyst does not eliminate common subexpressions)."""
    if mode == PERMISSIVE:
        return checked
    if mode != STRICT:
        raise ValueError(f"mode must be {STRICT!r} or {PERMISSIVE!r}")
    message = F.concat(F.lit(f"{what}: cannot convert '"), s, F.lit("'"))
    return F.coalesce(checked, F.when(s.isNotNull(), F.raise_error(message)))


def to_integral(s: Column, spark_type: str, mode: str, what: str) -> Column:
    return _guard(s, F.when(s.rlike(_INTEGER_TEXT), s.try_cast(spark_type)), mode, what)


def to_fractional(s: Column, spark_type: str, mode: str, what: str) -> Column:
    return _guard(s, s.try_cast(spark_type), mode, what)


def to_boolean(s: Column) -> Column:
    return F.lower(s) == F.lit("true")


def to_date(s: Column, mode: str, what: str) -> Column:
    return F.date_from_unix_date(to_integral(s, "int", mode, what))


def to_timestamp(s: Column, unit: str, mode: str, what: str) -> Column:
    n = to_integral(s, "bigint", mode, what)
    return F.timestamp_micros(n) if unit == "micros" else F.timestamp_millis(n)


def to_bytes(s: Column) -> Column:
    return F.encode(s, "UTF-8")


def to_decimal(s: Column, precision: int, scale: int, mode: str, what: str) -> Column:
    t = f"decimal({precision},{scale})"
    v = s.try_cast(t)
    plain_ok = F.length(F.regexp_extract(s, _FRACTION, 1)) <= scale
    # exponent notation: accept only if no digit is lost at the declared scale
    exp_ok = v.cast("double") == s.try_cast("double")
    ok = F.when(s.rlike("[eE]"), exp_ok).otherwise(plain_ok)
    return _guard(s, F.when(ok, v), mode, what)


def convert(s: Column, t: Scalar, mode: str = STRICT, what: str = "value") -> Column:
    """Convert text ``s`` to the scalar type ``t``; null text stays null."""
    k = t.kind
    if k == "string":
        return _guard(s, F.when(s.isin(*t.symbols), s), mode, f"{what} ({', '.join(t.symbols)})") if t.symbols else s
    if k == "int":
        return to_integral(s, "int", mode, what)
    if k == "long":
        return to_integral(s, "bigint", mode, what)
    if k == "float":
        return to_fractional(s, "float", mode, what)
    if k == "double":
        return to_fractional(s, "double", mode, what)
    if k == "boolean":
        return to_boolean(s)
    if k == "date":
        return to_date(s, mode, what)
    if k == "timestamp":
        return to_timestamp(s, t.unit, mode, what)
    if k == "bytes":
        b = to_bytes(s)
        return b if t.size is None else _guard(s, F.when(F.octet_length(b) == t.size, b), mode, f"{what} ({t.size} bytes)")
    if k == "decimal":
        return to_decimal(s, t.precision, t.scale, mode, what)
    raise ValueError(f"unsupported scalar {k}")


def convert_array(values: Column, t: Scalar, mode: str = STRICT, what: str = "value") -> Column:
    """Element-wise conversion of an ``array<string>`` (FN-14)."""
    if t.kind == "string" and not t.symbols:
        return values
    return F.transform(values, lambda x: convert(x, t, mode, what))
