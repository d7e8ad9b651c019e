"""Exact order statistics without a sort and without a sample.

The value at a rank is found by narrowing an interval, all groups and ranks together:

1. every value goes to a coarse bin by its sign and 16 steps for each doubling (a monotone
   function, so bins are intervals); bins are counted, with their least and largest value;
2. the bin of each rank is cut into ``BINS`` equal parts between its least and largest value, and
   counted again; a level narrows an interval some 4,096 times.

It ends when a bin's least and largest value are the same.  Each level is a scan of the group and
value columns, a partial and a final aggregate.  The driver gets at most one row for each coarse
bin and group, later ``BINS`` rows for each open interval, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
STEPS = 16
_EDGE = 1100.0 * STEPS          # beyond the exponents of doubles


@dataclass
class Cut:
    """The value at a rank, how many values of its group are less, and how many equal it."""
    rank: int
    value: float
    below: int
    equal: int


def coarse_bin(x: Column) -> Column:
    """Monotone bin of a double; -infinity first, NaN last, as Spark orders them."""
    size = F.floor(F.log2(F.abs(x)) * STEPS).cast("double") + _EDGE
    return (F.when(F.isnan(x), 2 * _EDGE + 1).when(x == float("inf"), 2 * _EDGE).when(x == float("-inf"), -2 * _EDGE)
            .when(x == 0, 0.0).when(x > 0, size).otherwise(-size))


def _counted(rows: DataFrame, *keys: str) -> list:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()


def _single(r) -> bool:
    return r["lo"] == r["hi"] or math.isnan(r["hi"])


def order_statistics(rows: DataFrame, ranks: Callable[[object, int], list[int]], group: str, value: str,
                     bins: int = BINS) -> dict[object, tuple[int, list[Cut]]]:
    """For each group its number of values and the cuts at ``ranks(group, number)`` (0-based; ranks
    outside the group are left out).  ``rows`` has no null values; there are few groups."""
    bins = max(2, bins)
    long = rows.select(F.col(group).alias("g"), F.col(value).cast("double").alias("x"))
    found: dict[object, list] = {}
    for r in _counted(long.withColumn("b", coarse_bin(F.col("x"))), "g", "b"):
        found.setdefault(r["g"], []).append(r)
    totals = {g: sum(r["n"] for r in own) for g, own in found.items()}
    cuts: dict[object, list[Cut]] = {g: [] for g in found}
    todo: dict[tuple, list[int]] = {}                       # (group, lo, hi, below) -> ranks

    def place(g, own: list, below: int, wanted: list[int]) -> None:
        """Sort ranks into the bins of an interval that starts ``below``."""
        for r in sorted(own, key=lambda r: r["b"]):
            inside = [k for k in wanted if below <= k < below + r["n"]]
            if inside and _single(r):
                cuts[g] += [Cut(k, r["hi"], below, r["n"]) for k in inside]
            elif inside:
                todo.setdefault((g, r["lo"], r["hi"], below), []).extend(inside)
            below += r["n"]

    for g, own in found.items():
        place(g, own, 0, [k for k in dict.fromkeys(ranks(g, totals[g])) if 0 <= k < totals[g]])
    while todo:
        now, todo = list(todo.items()), {}
        chain = None
        for i, ((g, lo, hi, _), _) in enumerate(now):
            x = F.col("x")
            part = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1))
            test, out = F.col("g").eqNullSafe(F.lit(g)) & x.between(lo, hi), F.struct(F.lit(i).alias("t"), part.alias("b"))
            chain = F.when(test, out) if chain is None else chain.when(test, out)
        per: dict[int, list] = {}
        for r in _counted(long.withColumn("at", chain).where(F.col("at").isNotNull()).select("at.t", "at.b", "x"), "t", "b"):
            per.setdefault(r["t"], []).append(r)
        for i, ((g, _, _, below), wanted) in enumerate(now):
            place(g, per[i], below, wanted)
    return {g: (totals[g], sorted(cuts[g], key=lambda c: c.rank)) for g in found}
