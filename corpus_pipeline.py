"""The corpus pipeline: toxicity, near duplicates, decontamination, secrets, token ids.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that its predecessor kept.
All but the last return the columns of ``docs``; rows and texts change as follows.

1. toxicity: rows that the classifier rejects go.  It learns from the labels of rows that are
   not held out, as the operator's query does.
2. near_duplicates: of each SimHash component one row stays, that with the smallest id.
3. decontamination: rows that hold a benchmark window go.
4. secrets: secrets inside texts are masked, and ``n_chars`` follows the new text; no row goes.
5. encoding: (doc_id, n_tokens, ids, decoded_sha256) of each row.  Ids that do not decode to the
   row's text are an error.

A stage's copy of the corpus is removed once the next stage's is written; the last one stays.

Null texts count as empty and stay null until the last stage, where they have no ids; rows that
repeat id and text are one document to stage 2; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import bpe, decontamination, secret_scan, simhash, toxicity
from flowlens.llm.base import discard, read_table, scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle=simhash.SHINGLE, radius=simhash.RADIUS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return clean.withColumn("n_chars", length)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, verify=True)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("secrets", mask_secrets), ("encoding", encode)]

#: SQL can express neither the classifier nor the merges; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder, before = scratch(spark, "pipeline"), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
