"""Class profile (A1-A3): counts per split, imbalance band, class weight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import imbalance_ratio, imbalance_severity


def class_counts(df: DataFrame, split: str | None = "split", flag: str = "is_benign") -> DataFrame:
    """A1: total, benign and attack rows per split (one partial+final hash aggregate)."""
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_if(F.col(flag)).alias("benign"),
            F.count_if(~F.col(flag)).alias("attack")]
    return df.groupBy(split).agg(*aggs) if split else df.agg(*aggs)


def imbalance(counts: DataFrame, benign: str = "benign", attack: str = "attack") -> DataFrame:
    """A2: ``1:%.2f`` ratio and severity band over the counts of A1."""
    b, a = F.col(benign), F.col(attack)
    return (counts.withColumn("class_ratio", imbalance_ratio(b, a))
            .withColumn("severity", imbalance_severity(b, a)))


def class_weight(df: DataFrame, y: str = "y", groups: list[str] | None = None) -> DataFrame:
    """A3: negatives / positives, 1.0 when there is no positive."""
    pos = F.sum(F.col(y)).cast("double")
    n = F.count(F.lit(1)).cast("double")
    w = F.when(pos > 0, F.try_divide(n - pos, pos)).otherwise(F.lit(1.0)).alias("pos_weight")
    return df.groupBy(*groups).agg(w) if groups else df.agg(w)


def with_class_weight(df: DataFrame, weight: float, y: str = "y", out: str = "w") -> DataFrame:
    """Per-row weight column for ``weightCol``: ``weight`` for positives, 1 otherwise."""
    return df.withColumn(out, F.when(F.col(y) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
