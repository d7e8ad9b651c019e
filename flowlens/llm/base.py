"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from flowlens.session import checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str, text_col: str, *extra: Column) -> DataFrame:
    """(doc_id, text, ...): only the columns an operator reads, so that no other column of the
    input can clash with those it adds."""
    return df.select(df[id_col].alias("doc_id"), df[text_col].cast("string").alias("text"), *extra)


def output_schema(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df``'s own doc_id followed by the columns of ``ddl``."""
    return T.StructType([df.schema["doc_id"], *T.StructType.fromDDL(ddl).fields])


def map_rows(df: DataFrame, ddl: str, make: Callable[[], Callable], budget: int = 1 << 20) -> DataFrame:
    """Map (doc_id, text) to (doc_id, ``ddl``) in Arrow batches without a shuffle.

    ``make()`` runs once in a task and returns a function from a list of texts (null: empty)
    to a list of lists, one for each column of ``ddl``.  It is called with some ``budget``
    characters of text at a time, or with one longer text, which bounds a task's memory.
    """
    schema = output_schema(df, ddl)
    names, types = schema.names, [to_arrow_type(f.dataType) for f in schema.fields[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for start, stop, part in text_runs(column, budget):
                cols = work(part)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start), *(pa.array(c, t) for c, t in zip(cols, types))], names=names)

    return df.mapInArrow(run, schema)


def text_runs(column: pa.Array, budget: int) -> Iterator[tuple[int, int, list[str]]]:
    """Consecutive runs (start, stop, texts) of a string column of some ``budget`` characters."""
    start, size, part = 0, 0, []
    for i in range(len(column)):
        t = column[i].as_py() or ""
        if part and size + len(t) > budget:
            yield start, i, part
            start, size, part = i, 0, []
        part.append(t)
        size += len(t)
    if part:
        yield start, len(column), part


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path inside the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch`` named, in whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def id_crc(doc_id: str | Column) -> Column:
    """CRC-32 of the id written as text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary"))


def sample_labels(labels: DataFrame, label: str, keep: Column, max_rows: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of at most ``max_rows`` labelled rows, those smallest by md5 of the id
    among the rows that satisfy ``keep``; an id labelled twice counts once, with its larger label."""
    rows = (labels.where(keep & F.col(id_col).isNotNull() & F.col(label).isNotNull())
            .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label")))
    return rows.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_rows)


def labelled_texts(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(doc_id, text, label) of the documents named in ``labels``, which has at most
    ``max_rows`` rows: they are broadcast, so the texts of other documents never move.  Of rows
    that repeat an id one stays, that with the smallest digest of its text, so there are at
    most ``max_rows``.  The result is spread over a bounded number of tasks and written to the
    shared folder."""
    named = F.broadcast(labels.limit(max_rows))
    one = F.min_by("text", F.sha2("text", 256)).alias("text")       # partial: a repeated id sends one row from each task
    rows = docs.join(named, "doc_id").groupBy("doc_id", "label").agg(one).select("doc_id", "text", "label")
    return settle(rows.repartition(12, "doc_id"))
