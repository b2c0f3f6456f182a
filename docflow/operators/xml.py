"""XML-1: declarative extraction of typed, nested columns from XML documents.

``extract_xml`` parses each document exactly once, inside the JVM, with
``from_xml`` and a raw schema derived from the spec; all typed fields are
expressions over that one parse. It is a narrow transformation (no shuffle),
so it scales with the number of input partitions and works unchanged on
streaming DataFrames.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import STRICT
from ..functions.pyfields import python_fields
from ..plans.compile import PYTHON, Options, compile_spec, needs_document_text, raw_schema
from ..plans.paths import XML_OPTIONS, case_clashes
from ..plans.spec import MappingSpec, SpecError
from .recordscan import scan_chunks, scan_records

_RAW = "__docflow_raw"
_DOC = "__docflow_doc"
_CORRUPT = "#corrupt"


def _reader_options(malformed: str, ignore_namespace: bool) -> dict:
    if malformed not in ("failfast", "permissive"):
        raise ValueError("malformed must be 'failfast' or 'permissive'")
    opts = dict(XML_OPTIONS)
    opts["mode"] = malformed.upper()
    if malformed == "permissive":
        opts["columnNameOfCorruptRecord"] = _CORRUPT
    if ignore_namespace:
        opts["ignoreNamespace"] = "true"
    return opts


_PROLOG_ENCODING = r"""^\s*<\?xml\s[^>]*?encoding\s*=\s*["']([A-Za-z][A-Za-z0-9._-]*)["']"""


def _declared_encoding(b: Column) -> Column:
    """The encoding of a document held as bytes: its byte order mark, else what its
    prolog declares, else UTF-8."""
    mark = F.hex(F.substring(b, 1, 2))
    declared = F.regexp_extract(F.decode(F.substring(b, 1, 256), "ISO-8859-1"), _PROLOG_ENCODING, 1)
    return F.when(mark.isin("FEFF", "FFFE"), F.lit("UTF-16")).when(declared == "", F.lit("UTF-8")).otherwise(F.upper(declared))


def _document_text(df: DataFrame, xml_col: str, encoding: str | None = None) -> Column:
    c = F.col(f"`{xml_col}`")
    if isinstance(df.schema[xml_col].dataType, T.BinaryType):  # documents held as bytes
        name = _declared_encoding(c) if encoding is None else F.lit(encoding.upper())
        other = F.call_function("decode", c, name)
        c = F.when(name.isin("UTF-8", "UTF8"), c.cast("string")).otherwise(other)
    return c


def _check_names(spark: SparkSession, schema: T.StructType) -> None:
    """XML names are case-sensitive; Spark's field access is only if the session says so."""
    clashes = case_clashes(schema)
    if clashes and spark.conf.get("spark.sql.caseSensitive") != "true":
        raise SpecError(f"names that differ only in case ({clashes[0][0]!r}, {clashes[0][1]!r}) need spark.sql.caseSensitive=true")


def extract_xml(
    df: DataFrame,
    xml_col: str,
    spec: MappingSpec,
    *,
    keep: Iterable[str] = (),
    columns: Iterable[str] | None = None,
    mode: str = STRICT,
    malformed: str = "failfast",
    corrupt_col: str = "_corrupt_record",
    ignore_namespace: bool = False,
    encoding: str | None = None,
) -> DataFrame:
    """One typed row per document.

    * ``xml_col``: string or binary column holding one document per row
      (bytes are decoded with ``encoding``, by default the one that the document's
      byte order mark or prolog declares, else UTF-8);
    * ``keep``: input columns passed through unchanged;
    * ``columns``: extract only these top-level fields (the raw schema is pruned
      too, so the parser materialises nothing else);
    * ``mode``: "strict" raises on unconvertible text and missing required
      fields, "permissive" gives null;
    * ``malformed``: "failfast" fails the job on a malformed document,
      "permissive" yields null fields and the document text in ``corrupt_col``;
    * a null document gives a row of nulls.
    """
    keep = list(keep)
    s = spec.prune(columns) if columns is not None else spec
    schema = raw_schema(s)
    _check_names(df.sparkSession, schema)
    if malformed == "permissive":
        schema = schema.add(T.StructField(_CORRUPT, T.StringType()))
    doc = _document_text(df, xml_col, encoding)
    parsed = [F.from_xml(doc, schema, _reader_options(malformed, ignore_namespace)).alias(_RAW)]
    if needs_document_text(s):
        parsed.append(doc.alias(_DOC))
    parsed_df = df.select(*[F.col(f"`{c}`") for c in keep], *parsed)
    extra = [_DOC] if needs_document_text(s) else []
    corrupt = F.col(_RAW).getField(_CORRUPT) if malformed == "permissive" else None
    return _typed(parsed_df, keep, extra, s, mode, corrupt, corrupt_col)


def _typed(parsed_df: DataFrame, keep: list, extra: list, s: MappingSpec, mode: str,
           corrupt: Column | None = None, corrupt_col: str = "_corrupt_record") -> DataFrame:
    """Parse result → typed columns, in two projections after the parse: values
    read by several expressions are staged once, then converted and assembled.
    (Catalyst keeps the projections apart because the staged values are not cheap.)"""
    raw = F.col(_RAW)
    ok = raw.isNotNull()
    if corrupt is not None:
        ok = ok & corrupt.isNull()
    opts = Options(mode=mode, doc=F.col(_DOC) if extra else None, stage=[])
    outs = [F.when(ok, c).alias(f.name) for c, f in zip(compile_spec(s, raw, opts), s.fields)]
    if corrupt is not None:
        outs.append(corrupt.alias(corrupt_col))
    kept = [F.col(f"`{c}`") for c in keep]
    staged_df = parsed_df.select(*kept, _RAW, *extra, *opts.stage)
    if opts.python:  # one Arrow pass for all Python field functions
        staged_df = staged_df.select("*", python_fields(opts.python).alias(PYTHON))
    return staged_df.select(*kept, *outs)


def read_xml(
    spark: SparkSession,
    path: str,
    spec: MappingSpec,
    row_tag: str,
    *,
    mode: str = STRICT,
    columns: Iterable[str] | None = None,
    ignore_namespace: bool = False,
    splittable: bool = True,
) -> DataFrame:
    """Scan XML files where each ``row_tag`` element is one record (SRC-3), with the
    same single parse and typed projection as :func:`extract_xml`. A file larger than
    ``spark.sql.files.maxPartitionBytes`` is read by several tasks
    (:mod:`docflow.operators.recordscan`); ``splittable=False`` leaves each file to one
    task and Spark's own ``rowTag`` reader (compressed files, encodings other than UTF-8)."""
    s = spec.prune(columns) if columns is not None else spec
    if splittable:
        return extract_xml(scan_records(spark, path, row_tag), "xml", s, mode=mode, ignore_namespace=ignore_namespace)
    schema = raw_schema(s)
    _check_names(spark, schema)
    opts = _reader_options("failfast", ignore_namespace)
    opts["rowTag"] = row_tag
    raw_df = spark.read.format("xml").options(**opts).schema(schema).load(path)
    parsed_df = raw_df.select(F.struct(*[F.col(f"`{n}`") for n in schema.fieldNames()]).alias(_RAW))
    return _typed(parsed_df, [], [], s, mode)


def read_xml_documents(
    spark: SparkSession, path: str, spec: MappingSpec, doc_tag: str, row_tag: str, *, rows: int = 1_000, **kw
) -> DataFrame:
    """Documents of any size (XML-9, XML-13): files whose ``doc_tag`` documents may hold more
    ``row_tag`` records than fit a row. One row per chunk of up to ``rows`` records, with
    the fields of ``spec``: those before the records stand in every chunk, those after
    them in the ``last`` one; ``first`` marks a document's first chunk. Explode the records
    (:func:`explode_records`) or aggregate chunks as for split documents."""
    return extract_xml(scan_chunks(spark, path, doc_tag, row_tag, rows=rows), "xml", spec, keep=["path", "block", "seq", "first", "last"], **kw)


def read_xml_files(
    spark: SparkSession, path: str, spec: MappingSpec, *, keep_path: bool = True, **kw
) -> DataFrame:
    """One document per file (SRC-3): ``binaryFile`` scan, then :func:`extract_xml`
    on the file content. Files are split across tasks by Spark's file source."""
    files = spark.read.format("binaryFile").load(path)
    return extract_xml(files, "content", spec, keep=["path"] if keep_path else [], **kw)


def explode_records(df: DataFrame, array_col: str | Column, *, outer: bool = False) -> DataFrame:
    """Repeated groups to rows (XML-13): one row per element of an array of
    records, its fields as columns, other columns repeated. ``outer=True`` keeps
    documents with no element (fields null).

    Built on ``posexplode_outer`` plus a filter on the position: a plain
    ``inline`` makes Catalyst infer ``size(array) > 0`` and push it below the
    parse projection, which would parse every document twice.
    """
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    name = array_col if isinstance(array_col, str) else None
    others = [F.col(f"`{c}`") for c in df.columns if c != name]
    exploded = df.select(*others, F.posexplode_outer(arr).alias("__pos", "__rec"))
    if not outer:
        exploded = exploded.where(F.col("__pos").isNotNull())
    return exploded.select(*others, "__rec.*")
