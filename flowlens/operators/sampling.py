"""Sampling and splitting.

Every plan here is exact and deterministic and none sorts or shuffles the table: the order keys at
the cuts are found by counting (``plans.ordering.segments``), and rows are compared with them.
Rows are ranked only where a cut falls inside a run of equal keys.  Spark's ``sampleBy`` /
``randomSplit`` are approximate and partition-dependent, so they are not used.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.plans.ordering import TASK_ROWS, hash_number, hash_order, numeric_key, segments

SPLIT_NAMES = ("train", "cal", "test")


def stratified_sample(df: DataFrame, stratum: str, n: dict, key: str = "uid", seed: int = 42,
                      task_rows: int = TASK_ROWS) -> DataFrame:
    """Exactly ``n[v]`` rows of each stratum value ``v`` without replacement, chosen by the
    seeded hash order of ``key`` (rows that repeat a key are taken in any order).  A stratum that
    is absent or smaller than its ``n`` raises ``ValueError`` (as the reference does); strata not
    named in ``n`` are dropped."""
    named = [v for v in n if v is not None]
    keep = F.col(stratum).isin(*named) if named else F.lit(False)
    if None in n:
        keep = keep | F.col(stratum).isNull()
    hashed = df.where(keep).withColumn("_h", hash_order(F.coalesce(F.col(key).cast("string"), F.lit("")), seed))
    found: dict = {}

    def cut(value, total: int) -> list[int]:
        found[value] = total
        return [int(n[value])]

    seg = segments(hashed, hash_number(F.col("_h")), ["_h", key], cut, stratum, task_rows=task_rows)
    for value, k in n.items():
        if found.get(value, 0) < int(k):
            raise ValueError(f"stratum {value!r} has {found.get(value, 0)} rows, {int(k)} requested")
    return seg.where(F.col("segment") == 0).drop("segment", "_h")


def ratio_split(df: DataFrame, stratum: str, total: int, shares: dict, key: str = "uid",
                seed: int = 42) -> DataFrame:
    """Stratified sample of ``total`` rows with per-stratum shares (e.g. 60:40).  The sizes
    add up to the total: rows left over by rounding down go to the largest remainders."""
    return stratified_sample(df, stratum, share_sizes(total, shares), key=key, seed=seed)


def share_sizes(total: int, shares: dict) -> dict:
    if abs(sum(shares.values()) - 1) > 1e-9:
        raise ValueError("the shares do not add up to 1")
    exact = {v: Fraction(str(s)) * total for v, s in shares.items()}
    sizes = {v: int(x) for v, x in exact.items()}
    for v in sorted(exact, key=lambda v: sizes[v] - exact[v])[:total - sum(sizes.values())]:
        sizes[v] += 1
    return sizes


def shuffled_split(df: DataFrame, key: str = "uid", seed: int = 42, train_frac: float = 0.70,
                   out: str = "split", task_rows: int = TASK_ROWS) -> DataFrame:
    """D3 + D4: seeded full shuffle, first ``int(train_frac * n)`` rows are train, rest test."""
    hashed = df.withColumn("_h", hash_order(F.coalesce(F.col(key).cast("string"), F.lit("")), seed))
    seg = segments(hashed, hash_number(F.col("_h")), ["_h", key], lambda _, n: [int(train_frac * n)], task_rows=task_rows)
    return seg.withColumn(out, F.when(F.col("segment") == 0, "train").otherwise("test")).drop("segment", "_h")


def chronological_split(df: DataFrame, order: list[str] = ("ts", "uid"),
                        boundaries: tuple = (0.70, 0.80), names=SPLIT_NAMES, out: str = "split",
                        task_rows: int = TASK_ROWS) -> DataFrame:
    """Rows in (ts, uid) order; cuts at ``int(b * n)`` for each boundary (70/10/20).  Null times
    come first, NaN last.  The passes before the cut read only the time; nothing is written.
    Materialize a costly input beforehand."""
    order = list(order)
    seg = segments(df, numeric_key(df, order[0]), order, lambda _, n: [int(b * n) for b in boundaries], task_rows=task_rows)
    name = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("segment") + 1)
    return seg.withColumn(out, name).drop("segment")


def leakage_audit(splits: DataFrame, split: str = "split", ts: str = "ts",
                  key: str = "uid") -> DataFrame:
    """Per split min/max time, whether the splits are ordered in time, and how many keys
    occur in more than one split (one aggregate by split, one by key; both partial)."""
    per = splits.groupBy(split).agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"),
                                    F.count(F.lit(1)).alias("rows"))
    dup = (splits.groupBy(key).agg((F.min(split) != F.max(split)).alias("_multi"))
           .agg(F.count_if("_multi").alias("key_overlap")))
    pivot = per.agg(*[F.max(F.when(F.col(split) == s, F.col(c))).alias(f"{s}_{c}")
                      for s in SPLIT_NAMES for c in ("min_ts", "max_ts", "rows")])
    ordered = ((F.col("train_max_ts") <= F.col("cal_min_ts"))
               & (F.col("cal_max_ts") <= F.col("test_min_ts")))
    one = F.lit(1).alias("_one")
    return (pivot.select("*", one).join(dup.select("*", one), "_one").drop("_one")
            .withColumn("time_ordered", ordered))


def restore_order(df: DataFrame, order: list[str] = ("ts", "uid")) -> DataFrame:
    """O1: original row order after sampling (a distributed range-partitioned sort)."""
    return df.orderBy(*order)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union all by column name."""
    return a.unionByName(b)
