"""The corpus pipeline: stages over ``documents``, each an operator of ``docflow.llm``.

Every stage reads what its predecessor kept, as written Parquet, so a lost executor
repeats at most one stage's tasks. All but the last return the columns of their input,
whatever those are called: the columns that an operator doesn't need travel as one
struct beside those that it does.

Rows without id are scored, cut and grouped like any others. Rows that share an id but
not their text are different documents. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm.carry import free_name
from docflow.llm.linededup import dedup_lines
from docflow.llm.packing import pack_documents
from docflow.llm.simhash import first_rows as near_duplicate_firsts
from docflow.llm.toxicity import toxicity
from docflow.session import drop_folder, materialize_step


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and all other columns as the struct ``row``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(True).alias(free_name(docs.columns, "any")), *others).alias("row"))


def _column(name: str) -> Column:
    """A column of the original table, of a packed one."""
    return F.col(name) if name in ("doc_id", "text") else F.col("row").getField(name)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score of 0.7 or more) go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = toxicity(_packed(docs), labels).where("predicted = 0")
    return clean.select(*[_column(c).alias(c) for c in docs.columns])


def dedup_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of 50 words or more are cut out; ``n_chars`` follows. A
    document whose words all stand in an earlier one goes."""
    cut = dedup_lines(_packed(docs), min_words=50)
    left = cut.where((F.col("n_deleted") == 0) | F.col("text").rlike(r"[^\x09-\x0D\x20]"))

    def value(c: str) -> Column:
        return F.when(F.col("n_deleted") == 0, _column(c)).otherwise(F.length("text")) if c == "n_chars" else _column(c)

    return left.select(*[value(c).cast(t).alias(c) for c, t in docs.dtypes])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of SimHash near-duplicates one row stays: that of smallest id, rows
    without id last, then of smallest hash of its text and of its other columns."""
    others = F.struct(F.lit(True).alias(free_name(docs.columns, "any")), *[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    key = F.concat(F.md5(F.coalesce("text", F.lit("")).cast("binary")), F.md5(F.to_json(others).cast("binary")))
    name = free_name(docs.columns, "key")
    keyed = docs.withColumn(name, key)
    first = near_duplicate_firsts(keyed.select("doc_id", "text", F.col(name).alias("key")), shingle_words=4, max_bits=4)
    # equal rows meet as one of each task; an inner join (keys are single) isn't moved before that
    return keyed.dropDuplicates([name]).join(first.withColumnRenamed("key", name), name).drop(name)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' bytes packed into sequences of 2,048, 4,096 or 8,192."""
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_repeated_lines),
    ("simhash near-dedup", one_of_each_group),
    ("best-fit packing", pack),
]

#: The first and the last stage learn weights and pack greedily: no SQL for the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's own intermediates and its input are
    deleted as soon as its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        kept, path = materialize_step(spark, lambda s=stage, d=docs: s(spark, d, sf_dir), "pipeline-" + name.replace(" ", "-"))
        if before:
            drop_folder(spark, before)
        docs, before = kept, path
    return STAGES[-1][1](spark, docs, sf_dir)
