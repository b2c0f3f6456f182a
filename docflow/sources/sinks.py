"""Appends that can be repeated and that check the sink's schema (SNK-1, SNK-2).

``append_once`` writes a job's rows to a staging folder inside the target, records the
files in a manifest named by the job's token, and only then moves them to where readers
look. A job that is killed at any point and run again with its token

* starts over if the manifest was not written (nothing is visible yet),
* goes on moving files if it was (no row is computed again),
* does nothing if the job was complete,

so every row is there once. Staging and manifests lie in folders that Spark's readers pass
over. One run of a token at a time; runs of different tokens don't meet. While files are
moved, readers may see a part of the job.

``checked_schema`` orders types: a column may be added (earlier rows have null), left out
(null), written narrower than the sink (widened) or wider (the sink is read wider from
then on); all else raises before anything is written. The schema that holds all of a sink's
rows is kept beside the manifests, for :func:`read_sink`.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import _hadoop_path

_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_FLOATS = [T.FloatType(), T.DoubleType()]


class SinkSchemaError(ValueError):
    """Rows whose schema the sink's rows can't share."""


def wider(a: T.DataType, b: T.DataType, where: str) -> T.DataType:
    """The type that holds every value of both; raises where there is none."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in merged(a, b, where + ".")])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType, where + "[]"), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider(a.keyType, b.keyType, where + "{}"), wider(a.valueType, b.valueType, where + "{}"), True)
    if a == b:
        return a
    for order in (_INTEGERS, _FLOATS):
        if a in order and b in order:
            return max(a, b, key=order.index)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        if a.scale != b.scale:
            raise SinkSchemaError(f"{where}: scale {b.scale} against {a.scale} of the sink")
        return T.DecimalType(max(a.precision, b.precision), a.scale)
    kinds = {type(a), type(b)}
    if kinds == {T.TimestampType, T.TimestampNTZType}:
        raise SinkSchemaError(f"{where}: a moment in time against a time without a zone")
    raise SinkSchemaError(f"{where}: {b.simpleString()} against {a.simpleString()} of the sink")


def merged(sink: T.StructType, rows: T.StructType, where: str = "") -> list[T.StructField]:
    """The sink's fields in their order, widened where ``rows`` needs it, then the new ones, all nullable."""
    mine = {f.name: f for f in rows.fields}
    out = [T.StructField(f.name, wider(f.dataType, mine[f.name].dataType, where + f.name) if f.name in mine else f.dataType, True) for f in sink.fields]
    known = {f.name.lower() for f in sink.fields}
    for f in rows.fields:
        if f.name not in {s.name for s in sink.fields}:
            if f.name.lower() in known:
                raise SinkSchemaError(f"{where}{f.name}: differs from a column of the sink by case only")
            out.append(T.StructField(f.name, f.dataType, True))
    return out


def checked_schema(sink: T.StructType | None, rows: T.StructType) -> T.StructType:
    """The schema that holds the sink's rows and the new ones; raises :class:`SinkSchemaError`."""
    return T.StructType(merged(sink or T.StructType([]), rows))


def sink_schema(spark: SparkSession, target: str) -> T.StructType | None:
    """The schema kept with the sink, else that of its files' footers, None without files."""
    folder, fs = _hadoop_path(spark, f"{target}/_jobs/schema.json")
    if fs.exists(folder):
        return T.StructType.fromJson(json.loads(_read(spark, fs, folder)))
    if not fs.exists(_hadoop_path(spark, target)[0]) or not _data_files(spark, target):
        return None
    return spark.read.option("mergeSchema", "true").parquet(target).schema


def read_sink(spark: SparkSession, target: str) -> DataFrame:
    """All rows of the sink under the schema that holds them."""
    schema = sink_schema(spark, target)
    return spark.read.schema(schema).parquet(target) if schema else spark.read.parquet(target)


def _read(spark: SparkSession, fs, path) -> str:
    stream = fs.open(path)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def _write(spark: SparkSession, target: str, text: str) -> None:
    """A small file, complete or not there: written aside and renamed."""
    path, fs = _hadoop_path(spark, target)
    aside = _hadoop_path(spark, target + ".new")[0]
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(path):
        fs.delete(path, False)
    fs.rename(aside, path)


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths below ``folder`` of the files that hold rows."""
    root, fs = _hadoop_path(spark, folder)
    base, found, files = fs.makeQualified(root).toString().rstrip("/"), [], fs.listFiles(root, True)
    while files.hasNext():
        name = files.next().getPath().toString()[len(base) + 1 :]
        if not any(part.startswith(("_", ".")) and "=" not in part for part in name.split("/")):
            found.append(name)
    return sorted(found)


def _move(fs, source, to) -> None:
    """One staged file to its place; done before if it isn't staged any more."""
    if fs.exists(to):
        fs.delete(source, False)
    elif fs.exists(source):
        fs.mkdirs(to.getParent())
        if not fs.rename(source, to):
            raise OSError(f"cannot move {source} to {to}")


def append_once(
    df: DataFrame, target: str, token: str, *, compression: str = "snappy", partition_by: list[str] | None = None, check_schema: bool = True
) -> bool:
    """Append ``df`` as parquet to ``target`` as the job ``token``: once, however often this is
    called with it. False if the job was complete already (``df`` is not run)."""
    spark = df.sparkSession
    target = target.rstrip("/")
    job = "job-" + hashlib.sha256(token.encode()).hexdigest()[:24]
    staging = f"{target}/_staging/{job}"
    path_of = lambda p: _hadoop_path(spark, p)[0]
    fs = _hadoop_path(spark, target)[1]
    files, done = f"{target}/_jobs/{job}.files", f"{target}/_jobs/{job}.done"
    if fs.exists(path_of(done)):
        fs.delete(path_of(staging), True)
        return False
    if not fs.exists(path_of(files)):
        if check_schema:
            schema = checked_schema(sink_schema(spark, target), df.schema)
            types = {f.name: f.dataType for f in schema.fields}
            df = df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in df.columns])
        writer = df.write.mode("overwrite").option("compression", compression)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(staging)
        names = [n for n in _data_files(spark, staging)]
        held = schema.json() if check_schema else None
        _write(spark, files, json.dumps({"files": names, "schema": held}))
    plan = json.loads(_read(spark, fs, path_of(files)))
    if plan["schema"]:  # before any file shows, so that readers never see rows that it can't hold
        old = sink_schema(spark, target)
        new = checked_schema(old, T.StructType.fromJson(json.loads(plan["schema"])))
        if old is None or new != old:
            _write(spark, f"{target}/_jobs/schema.json", new.json())
    for name in plan["files"]:
        folder, _, last = name.rpartition("/")
        _move(fs, path_of(f"{staging}/{name}"), path_of("/".join(x for x in (target, folder, f"{job}-{last}") if x)))
    fs.rename(path_of(files), path_of(done))
    fs.delete(path_of(staging), True)
    return True
