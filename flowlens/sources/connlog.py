"""Connection-log sources.

* S1 tab-separated log with a header line;
* S2 comma-separated splits with a header line;
* S3 raw Zeek text: field names from a ``#fields`` line, whitespace-separated values, ``#``
  starts a comment anywhere in a line;
* S4 a row cap.

Columns go by the names in each file's own header (``clean_name`` of them), so the files of a
folder may order their columns differently.  A header that lacks a column of the schema is an
error.  One scan of the text finds each file's header (a partial and a final aggregate: lines
stay where they are, one row a file moves); then the files of each distinct header are read
together by Spark's own reader.  Only a file's first line is its header: a later line that equals
it is a row.  Values may be quoted, with doubled quotes inside.  A file in which a line has an odd
number of quotes may hold quoted line breaks and is read whole by one task; all others are split.

Each reader has its own null markers; then values are ``try_cast`` to the declared types (ANSI
casts would raise), and ``rejected_values`` counts what did not fit.  No types are inferred.
"""

from __future__ import annotations

import csv
import functools
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.columns import null_if_marker
from flowlens.schema import CONN

# fixed values: what the reference's table reader takes as missing
TABLE_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
               "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# fixed values: what its raw log reader adds to them
RAW_NULLS = (*TABLE_NULLS, "-", "(empty)")


def clean_name(name: str) -> str:
    """``id.orig_h`` -> ``orig_h``; ``detailed-label`` -> ``detailed_label``."""
    name = name[3:] if name.startswith("id.") else name
    return re.sub(r"[^0-9A-Za-z_]", "_", name)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, value, block, at): every line, its file, where its split starts in the file, and a
    number that grows along the lines of a split."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value",
                                        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def _as_path(file: str) -> str:
    """A file's metadata name as a path to read: not URL-encoded, without glob characters."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def files_by(per_file: DataFrame, *keys: str) -> list[tuple[Row, list[str] | None]]:
    """Groups of files (file, keys) with equal keys and their paths; None for the paths where all
    files are one group."""
    groups = per_file.groupBy(*keys).agg(F.collect_list("file").alias("files")).collect()
    return [(r, None if len(groups) == 1 else sorted(map(_as_path, r["files"]))) for r in sorted(groups, key=lambda r: repr(r[:-1]))]


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, breaks): each file's first line, and whether it may hold quoted line breaks."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    first = F.when(F.col("block") == 0, F.col("at"))
    return read_lines(spark, path).groupBy("file").agg(F.min_by("value", first).alias("header"), F.max(quotes % 2 == 1).alias("breaks"))


def typed(df: DataFrame, schema: T.StructType, nulls: tuple = TABLE_NULLS) -> DataFrame:
    """Null markers -> NULL, then ``try_cast`` each column to the schema's type."""
    cols = []
    for f in schema.fields:
        c = null_if_marker(F.col(f.name), nulls)
        cols.append(c.alias(f.name) if isinstance(f.dataType, T.StringType)
                    else c.try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def rejected_values(df: DataFrame, schema: T.StructType, nulls: tuple = TABLE_NULLS) -> DataFrame:
    """(column, rejected): how many text values are no null marker and do not fit their type."""
    cast = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    counts = df.agg(*[F.count_if(null_if_marker(F.col(f.name), nulls).isNotNull() & null_if_marker(
        F.col(f.name), nulls).try_cast(f.dataType).isNull()).alias(f.name) for f in cast])
    return counts.unpivot([], [f.name for f in cast], "column", "rejected")


def read_table_text(spark: SparkSession, path: str, schema: T.StructType = CONN, sep: str = "\t",
                    quoted_breaks: bool | None = None) -> DataFrame:
    """S1 / S2 before typing: the schema's columns as text, found by each file's header.
    ``quoted_breaks`` says whether values may hold line breaks; None looks at each file."""
    found = table_files(spark, path)
    if quoted_breaks is not None:
        found = found.withColumn("breaks", F.lit(quoted_breaks))
    parts = []
    for r, files in files_by(found, "header", "breaks"):
        names = [clean_name(n) for n in next(csv.reader([r["header"].rstrip("\r")], delimiter=sep), [])]
        if missing := [c for c in schema.fieldNames() if c not in names]:
            raise ValueError(f"a header has no column {', '.join(missing)}: {names}")
        raw = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        rows = spark.read.schema(raw).options(sep=sep, header=True, multiLine=r["breaks"], quote='"', escape='"').csv(files or path)
        parts.append(rows.select(*[F.col(f"c{names.index(c)}").alias(c) for c in schema.fieldNames()]))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in schema.fieldNames()]))
    return functools.reduce(DataFrame.unionByName, parts)


def read_conn_log(spark: SparkSession, path: str, schema: T.StructType = CONN,
                  sep: str = "\t") -> DataFrame:
    """A log with a header line, columns by name."""
    return typed(read_table_text(spark, path, schema, sep), schema)


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType = CONN) -> DataFrame:
    """Comma-separated split with a header line."""
    return read_conn_log(spark, path, schema, sep=",")


def read_zeek(spark: SparkSession, path: str, schema: T.StructType | None = None,
              max_rows: int | None = None) -> DataFrame:
    """S3 (+ S4): raw Zeek log as a DataFrame.

    Each file's ``#fields`` line names its columns; files with different fields are put
    together by name.  Without any ``#fields`` line, columns are named ``c0, c1, ...`` (width =
    longest row).  With ``schema``, columns are matched by clean name and cast; otherwise text
    is kept.
    """
    fields = F.col("value").startswith("#fields")
    found = read_lines(spark, path).groupBy("file").agg(
        F.min_by("value", F.when(fields, F.struct("block", "at"))).alias("header"))
    groups = files_by(found, "header")
    headers = [r["header"] for r, _ in groups]
    if any(headers) and not all(headers):
        raise ValueError(f"no header in {', '.join(next(files for r, files in groups if not r['header']))}")
    parts = []
    for header, files in ((r["header"], files) for r, files in groups):
        body = F.trim(F.regexp_replace("value", "#.*$", ""))
        rows = spark.read.text(files or path).select(body.alias("value")).where(F.col("value") != "").select(
            F.split("value", r"\s+").alias("v"))
        names = ([clean_name(n) for n in re.sub(r"^#fields\s*", "", header).split()] if header
                 else [f"c{i}" for i in range(rows.agg(F.max(F.size("v"))).first()[0] or 0)])
        parts.append(rows.select(*[F.get("v", F.lit(names.index(n))).alias(n) for n in dict.fromkeys(names)]))
    parts.sort(key=lambda p: (-len(p.columns), p.columns))
    df = functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts) if parts else spark.createDataFrame([], T.StructType([]))
    known = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    df = df.select(*[(null_if_marker(F.col(n), RAW_NULLS).try_cast(known[n]) if n in known
                      and not isinstance(known[n], T.StringType) else null_if_marker(F.col(n), RAW_NULLS)).alias(n)
                     for n in df.columns])
    return df.limit(max_rows) if max_rows is not None else df


def row_cap(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """At most ``n`` rows; ``order`` makes the cap deterministic."""
    return (df.orderBy(*order) if order else df).limit(n)
