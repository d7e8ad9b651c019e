"""Decisions on scored rows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import threshold
from flowlens.schema import ALERT_TEXT, DEFAULT_WHITELIST, SAFE_TEXT


def decide(df: DataFrame, t: float, score: str = "score", out: str = "pred") -> DataFrame:
    """``pred = score >= t`` (inclusive)."""
    return df.withColumn(out, threshold(score, t))


def whitelist_override(df: DataFrame, whitelist: list[str] | DataFrame = DEFAULT_WHITELIST,
                       src: str = "src_ip", pred: str = "pred") -> DataFrame:
    """A trusted source's prediction is forced to 0.

    A Python list stays a literal IN-set (fine up to thousands of entries).  A DataFrame of
    trusted addresses (column ``ip``) is de-duplicated and left-joined; Spark broadcasts it
    only when its measured size is under the broadcast threshold, else shuffles both sides.
    """
    if isinstance(whitelist, DataFrame):
        trusted = whitelist.select(F.col("ip").alias("_wl")).distinct().withColumn("_trusted", F.lit(True))
        j = df.join(trusted, F.col(src) == F.col("_wl"), "left")
        return (j.withColumn(pred, F.when(F.col("_trusted"), F.lit(0)).otherwise(F.col(pred)))
                .drop("_wl", "_trusted"))
    return df.withColumn(pred, F.when(F.col(src).isin(*whitelist), F.lit(0)).otherwise(F.col(pred)))


def alert_record(df: DataFrame, pred: str = "pred") -> DataFrame:
    """Status text, ``ip:port -> ip:port``, upper-cased protocol and state."""
    return df.select(
        "*",
        F.when(F.col(pred) == 1, F.lit(ALERT_TEXT)).otherwise(F.lit(SAFE_TEXT)).alias("status"),
        F.concat_ws(" -> ", F.concat_ws(":", "src_ip", F.col("sport").cast("string")),
                    F.concat_ws(":", "dst_ip", F.col("dport").cast("string"))).alias("endpoints"),
        F.upper("proto").alias("proto_upper"))


def score_pair(df: DataFrame, score: str = "score", out: str = "pair") -> DataFrame:
    """(1 - p, p)."""
    return df.withColumn(out, F.array(F.lit(1.0) - F.col(score), F.col(score)))


def positive_score(df: DataFrame, probability: str = "probability", out: str = "score") -> DataFrame:
    """The positive-class column of a Spark ML probability vector."""
    return df.withColumn(out, vector_to_array(probability)[1])
