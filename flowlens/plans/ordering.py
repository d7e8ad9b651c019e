"""Global order without a single-task sort.

A global position (row i of a table in some total order) is what splits, exact-n samples,
curves and sequence windows need.  ``Window.orderBy`` without a partition would pull the
whole table into one task, so no plan here uses one:

* ``segments`` cuts a table at ranks: the values at the ranks are found by counting
  (``plans.selection``), and a row's segment is a comparison with them.  Rows are ranked only
  where a cut falls inside a run of equal values, and then only those of the run.
* ``fixed_order`` range-partitions rows on a whole composite key, sorts inside partitions and
  fixes the result.  The last key is the row's number in its input split, so that rows which
  agree in every other key are spread over partitions too.
* ``dense_index`` numbers the rows of ``fixed_order``, ``running_sums`` sums along them: a small
  table with one row for each partition says what lies before it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.columns import epoch_micros
from flowlens.plans.selection import order_statistics


def numeric_key(df: DataFrame, c: str) -> Column:
    """An order-preserving DOUBLE for a numeric or timestamp column (nulls first)."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        x = epoch_micros(c, dt).cast("double")
    elif isinstance(dt, T.DateType):
        x = F.unix_date(F.col(c)).cast("double")
    else:
        x = F.col(c).cast("double")
    return F.coalesce(x, F.lit(float("-inf")))


#: Rows of a run of equal values that one task ranks; more go through range partitions.
TASK_ROWS = 2_000_000


def hash_order(key: Column, seed: int = 42) -> Column:
    """Seeded pseudo-random order key: md5 of ``seed:key`` (same bytes in Spark and DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_number(h: Column) -> Column:
    """The first 13 hex digits of an md5 order key as a DOUBLE (exact, in the same order)."""
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double")


def join_null_safe(big: DataFrame, small: DataFrame, keys: list[str],
                   broadcast: bool = False, how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL (a NULL stratum is still a stratum);
    ``broadcast`` only for a small side whose size is bounded."""
    ren = small.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c)
                         for c in small.columns])
    ren = F.broadcast(ren) if broadcast else ren
    cond = [big[k].eqNullSafe(ren[f"_k_{k}"]) for k in keys]
    return big.join(ren, cond, how).drop(*[f"_k_{k}" for k in keys])


def segments(df: DataFrame, value: Column, order: list[str], cuts: Callable[[object, int], list[int]],
             stratum: str | None = None, out: str = "segment", task_rows: int = TASK_ROWS) -> DataFrame:
    """Adds ``out``: how many of the ``cuts(stratum value, number of rows)`` are at most the row's
    rank by ``order`` (0-based, inside its stratum).

    ``value`` is a double that is non-decreasing in ``order`` and never null.  A row's segment
    follows from comparing it with the values at the cuts.  Only where a cut falls inside a run
    of equal values are rows ranked, and only those of the run: by a window while the run has
    at most ``task_rows``, else through range partitions.  The passes that find the cuts read
    ``value`` and ``stratum`` alone.
    """
    one = F.col(stratum) if stratum else F.lit(0)
    found = order_statistics(df.select(one.alias("_g"), value.alias("_x")), cuts, "_g", "_x")
    keyed = df.withColumns({"_x": value, "_run": F.lit(None).cast("int")})
    segment, run, runs = F.lit(0), F.lit(None).cast("int"), []      # runs: (rows, [(place in the run, cuts)])
    for g, (total, stats) in found.items():
        own, wanted = one.eqNullSafe(F.lit(g)), cuts(g, total)
        step, ties = F.lit(sum(k <= 0 for k in wanted)), {}
        for c in (c for c in stats if c.rank > 0):
            n, inside = wanted.count(c.rank), F.col("_x").eqNullSafe(F.lit(c.value))
            step = step + F.when((F.col("_x") > F.lit(c.value)) | (inside & F.lit(c.rank == c.below)), n).otherwise(0)
            if c.rank > c.below:
                if c.below not in ties:
                    run = F.when(own & inside, len(runs)).otherwise(run)
                    runs.append((c.equal, ties.setdefault(c.below, [])))
                ties[c.below].append((c.rank - c.below, n))
        segment = F.when(own, step).otherwise(segment)
    if not runs:
        return keyed.withColumn(out, segment).drop("_x", "_run")
    keyed = keyed.withColumns({out: segment, "_run": run})
    tied = keyed.where(F.col("_run").isNotNull())
    if max(rows for rows, _ in runs) <= task_rows:
        ranked = tied.withColumn("_r", F.row_number().over(Window.partitionBy("_run").orderBy(*order)) - 1)
    else:
        ranked = dense_index(tied, order, strata=["_run"], out="_r")
    more = F.lit(0)
    for i, (_, places) in enumerate(runs):
        more = F.when(F.col("_run") == i, sum((F.when(F.col("_r") >= k, n).otherwise(0) for k, n in places), F.lit(0))).otherwise(more)
    ranked = ranked.withColumn(out, F.col(out) + more).drop("_r")
    return keyed.where(F.col("_run").isNull()).unionByName(ranked).drop("_x", "_run")


def fixed_order(df: DataFrame, keys: list[str | Column], n_partitions: int | None = None,
                fix: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows in the order of ``keys``, range-partitioned, sorted inside partitions and fixed (by a
    reliable checkpoint, or ``fix``), with ``_pid`` and ``_local``, the place in the partition.

    Spark samples the whole key, so a hot leading value is split by the keys after it, and rows
    that agree in all keys by their number in the input: no partition is larger than its share
    by much, whatever the skew.
    """
    from flowlens.plans.materialize import materialize

    cols = [F.col(c) if isinstance(c, str) else c for c in keys] + [F.col("_tie")]
    # default: the session's shuffle parallelism, which a cluster sizes for its data
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    local = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    return (fix or materialize)(ranged.drop("_tie")).withColumns({"_pid": F.spark_partition_id(), "_local": local})


def partition_edges(rows: DataFrame, strata: list[str], sums: list[str] = ()) -> list[Row]:
    """One row for each partition of ``fixed_order`` that has rows, by ``_pid``: its number of rows
    ``n``, and ``first`` and ``last``, the struct of (strata, n, sums) of its first and last
    stratum inside it."""
    per = rows.groupBy("_pid", *strata).agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_at"),
                                            *[F.sum(c).alias(f"_s_{c}") for c in sums])
    whole = F.struct(*strata, "_n", *[f"_s_{c}" for c in sums])
    return sorted(per.groupBy("_pid").agg(F.sum("_n").alias("n"), F.min_by(whole, "_at").alias("first"), F.max_by(whole, "_at").alias("last"))
                  .collect(), key=lambda r: r["_pid"])


def carried(edges: list[Row], strata: list[str], names: list[str]) -> dict[int, list]:
    """For each partition, the totals of ``names`` over the rows of its first stratum that lie in
    partitions before it."""
    out, last = {}, None                    # last: (stratum, totals) at the end of the partitions so far
    for r in edges:
        first, end = (tuple(r[e][c] for c in strata) for e in ("first", "last"))
        before = last[1] if last is not None and last[0] == first else [0] * len(names)
        out[r["_pid"]] = before
        own = [r["last"][c] for c in names]
        last = end, ([a + b for a, b in zip(before, own)] if first == end else own)
    return out


def dense_index(df: DataFrame, order: list[str | Column], strata: list[str] | None = None,
                out: str = "_i", n_partitions: int | None = None, rows_per_partition: int | None = None) -> DataFrame:
    """0-based position in ``order`` within each stratum, exact and contiguous; rows that agree in
    the whole order are numbered in any order.

    ``fixed_order`` numbers rows inside partitions; a small table of per-(partition, stratum)
    counts, prefix-summed over partitions, turns that into the global position.
    """
    strata = list(strata or [])
    if n_partitions is None and rows_per_partition is not None:
        n_partitions = max(1, -(-df.count() // rows_per_partition))
    tagged = fixed_order(df, strata + list(order), n_partitions)
    counts = tagged.groupBy("_pid", *strata).agg(F.count(F.lit(1)).alias("_di_cnt"), F.min("_local").alias("_di_first"))
    w = (Window.partitionBy(*strata) if strata else Window.partitionBy()).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", *strata, "_di_first", F.coalesce(F.sum("_di_cnt").over(w), F.lit(0)).cast("bigint").alias("_di_before"))
    # without strata the table has one row per range partition: a bounded broadcast
    joined = join_null_safe(tagged, offsets, ["_pid", *strata], broadcast=not strata)
    return (joined.withColumn(out, F.col("_di_before") + F.col("_local") - F.col("_di_first"))
            .drop("_pid", "_local", "_di_first", "_di_before"))


def number_in_place(df: DataFrame, out: str = "_i") -> DataFrame:
    """Numbers rows from 0 as they lie: partition after partition, in the order inside them."""
    from flowlens.plans.materialize import materialize

    local = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    rows = materialize(df).withColumns({"_pid": F.spark_partition_id(), "_local": local})
    before = F.coalesce(F.sum("_n").over(Window.partitionBy().orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = rows.groupBy(F.col("_pid").alias("_p")).agg(F.count(F.lit(1)).alias("_n")).select("_p", before.cast("bigint").alias("_before"))
    # one row for each partition: a bounded broadcast
    joined = rows.join(F.broadcast(offsets), F.col("_pid") == F.col("_p"))
    return joined.withColumn(out, F.col("_before") + F.col("_local")).drop("_pid", "_p", "_local", "_before")


def running_sums(df: DataFrame, groups: list[str], order_col: str, values: list[str], descending: bool = True,
                 suffix: str = "_cum", n_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of the BIGINT ``values`` per group along ``order_col`` (distinct values
    expected, e.g. one row per distinct score): one range exchange, then a sum inside each
    partition that starts from what the partitions before it hold of its first group."""
    key = F.col(order_col).desc() if descending else F.col(order_col).asc()
    rows = fixed_order(df, [*groups, key], n_partitions)
    edges = partition_edges(rows, groups, values)
    before = carried(edges, groups, [f"_s_{v}" for v in values])
    own_columns = df.columns
    schema = T.StructType(df.schema.fields + [T.StructField(f"{v}{suffix}", T.LongType()) for v in values])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, end = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if totals is None:
                totals = np.array(before[batch.column("_pid")[0].as_py()], np.int64)
            new = run_starts(batch, groups, end)
            own = np.column_stack([batch.column(v).to_numpy(zero_copy_only=False).astype(np.int64) for v in values])
            cum = np.cumsum(own, axis=0)
            at = np.flatnonzero(new)
            base = np.vstack([-totals[None, :], (cum - own)[at]])
            cum -= base[np.cumsum(new)]
            totals, end = cum[-1], batch.slice(batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in own_columns] + [pa.array(cum[:, i]) for i in range(len(values))],
                                             names=schema.names)

    return rows.drop("_local").mapInArrow(run, schema)


def run_starts(batch: pa.RecordBatch, cols: list[str], before: pa.RecordBatch | None) -> np.ndarray:
    """Which rows of a batch differ in ``cols`` from the row before them; ``before`` is the last row
    of the batch before.  A partition's first row starts no run: it may continue one."""
    new = np.zeros(batch.num_rows, bool)
    for c in cols:
        own = batch.column(c)
        prior = pa.concat_arrays([(before.column(c) if before is not None else own.slice(0, 1)), own.slice(0, batch.num_rows - 1)])
        same = pc.or_(pc.fill_null(pc.equal(own, prior), False), pc.and_(pc.is_null(own), pc.is_null(prior)))
        new |= ~same.to_numpy(zero_copy_only=False)
    return new
