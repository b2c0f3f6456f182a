"""Why a document can't be read, and where (XML-12)."""

from __future__ import annotations

import xml.parsers.expat as expat

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAUSE = T.StructType([T.StructField("line", T.IntegerType()), T.StructField("position", T.IntegerType()), T.StructField("reason", T.StringType())])
_KIND = pa.struct([("line", pa.int32()), ("position", pa.int32()), ("reason", pa.string())])


def cause_of(text: str) -> dict:
    """Line (from 1), position in the line (from 0, in characters) and reason of the first
    error; a document that is well-formed, and yet no record of the mapping, has no place."""
    reader = expat.ParserCreate()
    try:
        reader.Parse(text, True)
    except expat.ExpatError as e:
        return {"line": e.lineno, "position": e.offset, "reason": expat.ErrorString(e.code)}
    return {"line": None, "position": None, "reason": "not readable by the mapping"}


def causes_of(texts: pa.Array) -> pa.Array:
    """:func:`cause_of` of every text, null for null. Texts and causes pass between Arrow
    and Python column by column, rejects only."""
    there = texts.is_valid()
    causes = [cause_of(t) for t in texts.filter(there).to_numpy(zero_copy_only=False).tolist()]
    found = pa.StructArray.from_arrays([pa.array([c[f.name] for c in causes], f.type) for f in _KIND], fields=list(_KIND))
    return found.take(pc.if_else(there, pc.subtract(pc.cumulative_sum(there.cast("int32")), 1), None))


def reject_cause(document: Column) -> Column:
    """``struct(line, position, reason)`` of a rejected document's text; null for null. Only
    rejects are parsed again, in one Arrow pass; null documents cost nothing."""
    return F.arrow_udf(causes_of, CAUSE)(document)
