"""Labels and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import binary_label, is_benign
from flowlens.schema import DEFAULT_ATTACKERS, FEATURES


def drop_null_label(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows without a label are dropped (pushed to the scan as IsNotNull)."""
    return df.where(F.col(label).isNotNull())


def with_benign_flag(df: DataFrame, label: str = "label", out: str = "is_benign") -> DataFrame:
    """``is_benign`` = trimmed, lower-cased label starts with 'benign'."""
    return df.withColumn(out, is_benign(label))


def with_target(df: DataFrame, label: str = "label", out: str = "y") -> DataFrame:
    """Binary target y = 1 for anything not benign."""
    return df.withColumn(out, binary_label(label))


def benign_subset(df: DataFrame, flag: str = "is_benign") -> DataFrame:
    """The benign rows."""
    return df.where(F.col(flag))


def attack_subset(df: DataFrame, flag: str = "is_benign") -> DataFrame:
    """The attack rows."""
    return df.where(~F.col(flag))


def feature_projection(df: DataFrame, keys: list[str] | None = None,
                       target: str = "y") -> DataFrame:
    """P5: the 12 feature columns, the target and any key columns (pruned at the scan)."""
    keys = keys or []
    cols = keys + FEATURES + ([target] if target in df.columns else [])
    return df.select(*cols)


def drop_helper(df: DataFrame, helper: str = "is_benign") -> DataFrame:
    """Drop the helper flag; a no-op when it is absent."""
    return df.drop(helper)


def label_by_source(df: DataFrame, attackers: list[str] | DataFrame = DEFAULT_ATTACKERS,
                    src: str = "src_ip", out: str = "y") -> DataFrame:
    """Ground truth by source address (1 for a listed attacker).

    A Python list stays a literal IN-set; a DataFrame of addresses (column ``ip``) is joined
    (Spark picks broadcast from its measured size).
    """
    if isinstance(attackers, DataFrame):
        marks = attackers.select(F.col("ip").alias("_ip")).distinct().withColumn("_hit", F.lit(1))
        return (df.join(marks, F.col(src) == F.col("_ip"), "left")
                .withColumn(out, F.coalesce(F.col("_hit"), F.lit(0)))
                .drop("_ip", "_hit"))
    return df.withColumn(out, F.when(F.col(src).isin(*attackers), 1).otherwise(0))


def clean_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """P1 + P2 + P3 in one projection."""
    return with_target(with_benign_flag(drop_null_label(df, label), label), label)
