"""Sliding row windows of length L over an order (W1-W4) and batch scoring of them (K5).

Rows are put in order once (``plans.ordering.fixed_order``: one range exchange on the whole order
key, a sort inside partitions, fixed).  Partitions stay where they are; only the last L-1 rows of
each move, to the task of the partition after it (a table of partitions x (L-1) rows, which is
broadcast).  A task then slides along its rows as Arrow batches, keeping the last L-1 rows
between batches: a strided view over the values is all windows at once, and no row is ever
held L times.  The work of a task follows its rows alone, whatever the skew, and the result
equals the plain global window exactly.  ``partition_by`` gives per-key windows (no mixing of
hosts); keys are the leading part of the order, so a key of any size spans partitions.

``sequence_windows`` returns windows as rows, ``flat_windows`` as arrays that a model takes;
``score_sequences`` scores them where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from flowlens.plans.materialize import materialize
from flowlens.plans.ordering import carried, fixed_order, partition_edges, run_starts
from flowlens.schema import SEQ_LEN

Fix = Callable[[DataFrame], DataFrame]
Encode = Callable[[np.ndarray], np.ndarray]


@dataclass
class _Slide:
    """Rows in order, and what each partition needs of those before it."""
    rows: DataFrame
    parts: list[str]
    length: int
    before: dict[int, int]          # rows of the partition's first key in earlier partitions
    tails: dict[int, pa.Table]      # the last L-1 of them at most

    @classmethod
    def over(cls, df: DataFrame, parts: list[str], order: list[str], length: int, fix: Fix) -> _Slide:
        rows = fixed_order(df, [*parts, *order], fix=fix)
        edges = partition_edges(rows, parts)
        before = {p: n for p, (n,) in carried(edges, parts, ["_n"]).items()}
        if length == 1 or not edges:
            return cls(rows, parts, length, before, {})
        # one row for each partition: a bounded broadcast
        sizes = df.sparkSession.createDataFrame([(r["_pid"], r["n"]) for r in edges], "_p int, _n bigint")
        ends = (rows.join(F.broadcast(sizes), F.col("_pid") == F.col("_p")).where(F.col("_local") >= F.col("_n") - (length - 1))
                .drop("_p", "_n").toArrow().sort_by([("_pid", "ascending"), ("_local", "ascending")]))
        tails, carry, last = {}, ends.slice(0, 0), None
        at = np.searchsorted(ends["_pid"].to_numpy(), [r["_pid"] for r in edges])
        for r, start in zip(edges, at):
            first, end = (tuple(r[e][c] for c in parts) for e in ("first", "last"))
            carry = carry if last == first else ends.slice(0, 0)
            if carry.num_rows:
                tails[r["_pid"]] = carry.drop_columns(["_pid", "_local"])
            held = min(r["n"], length - 1)
            kept = min(r["last"]["_n"], held)
            own = ends.slice(start + held - kept, kept)
            carry = pa.concat_tables([carry, own]) if first == end else own
            carry, last = carry.slice(max(0, carry.num_rows - (length - 1))), end
        return cls(rows, parts, length, before, tails)

    def run(self, emit: Callable[[pa.Table, np.ndarray, int], pa.RecordBatch], schema: T.StructType) -> DataFrame:
        """``emit(rows, position, start)`` for each batch: the L-1 rows before it at most and then its
        own, which begin at ``start``, and each own row's 0-based position in its key."""
        parts, length, before, tails = self.parts, self.length, self.before, self.tails
        shared = self.rows.sparkSession.sparkContext.broadcast((before, tails))

        def slide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            carry, end, position = None, None, 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                if end is None:
                    pid = batch.column("_pid")[0].as_py()
                    position, carry = shared.value[0][pid], shared.value[1].get(pid)
                new = run_starts(batch, parts, end)
                at = np.arange(batch.num_rows) + position
                starts = np.flatnonzero(new)
                if len(starts):
                    runs = np.cumsum(new)
                    at = np.where(runs > 0, np.arange(batch.num_rows) - starts[np.maximum(runs - 1, 0)], at)
                end, position = batch.slice(batch.num_rows - 1), int(at[-1]) + 1
                own = pa.Table.from_batches([batch]).drop_columns(["_pid"])
                rows = pa.concat_tables([carry.cast(own.schema), own]) if carry is not None else own
                yield emit(rows.combine_chunks(), at, rows.num_rows - batch.num_rows)
                carry = rows.slice(max(0, rows.num_rows - (length - 1))) if length > 1 else None

        return self.rows.drop("_local").mapInArrow(slide, schema)


def _matrix(rows: pa.Table, values: list[str], length: int, start: int) -> np.ndarray:
    """Values as doubles (null: NaN), with exactly L-1 rows before the batch's own."""
    own = [rows[v].cast(pa.float64()).to_numpy() for v in values]
    x = np.column_stack(own) if own else np.zeros((rows.num_rows, 0))
    short = length - 1 - start
    return np.vstack([np.zeros((short, x.shape[1])), x]) if short > 0 else x[start - (length - 1):]


def _tensor(rows: pa.Table, values: list[str], length: int, at: np.ndarray, start: int, pad: bool,
            encode: Encode | None = None) -> tuple[np.ndarray, np.ndarray]:
    """[n, L, d] windows of the rows that have one, and those rows; members that do not exist are 0."""
    x = _matrix(rows, values, length, start)
    x = encode(x) if encode else x
    view = np.lib.stride_tricks.sliding_window_view(x, length, axis=0).transpose(0, 2, 1)
    if not pad:
        chosen = np.flatnonzero(at >= length - 1)
        return (view if len(chosen) == len(at) else view[chosen]), chosen
    short = np.flatnonzero(at < length - 1)
    if len(short):
        view = view.copy()
        view[short] = np.where((np.arange(length) >= length - 1 - at[short][:, None])[:, :, None], view[short], 0.0)
    return view, np.arange(len(at))


def _prepared(df: DataFrame, parts: list[str], keep: list[str], members: list[str], order: list[str], values: list[str],
              checkpoint: bool) -> DataFrame:
    cols = list(dict.fromkeys([*parts, *keep, *members, *order, *values]))
    return materialize(df.select(*cols), checkpoint)


def sequence_windows(df: DataFrame, order: list[str], values: list[str],
                     length: int = SEQ_LEN, pad: bool = False,
                     partition_by: list[str] | None = None, keep: list[str] | None = None,
                     member_cols: list[str] | None = None, checkpoint: bool = False, fix: Fix = materialize) -> DataFrame:
    """W1 (``pad=False``: only full windows, n-L+1 of them) and W2 (``pad=True``: one window
    per row, missing history as zero vectors).  W3: the window carries its last row's
    ``keep`` columns (e.g. the label).

    Output: ``keep`` columns, ``seq_pos`` (position of the last row), ``n_real`` (rows that
    exist), ``members`` (ARRAY<STRUCT<pos, values...>> of the real rows, in order) and
    ``seq`` (ARRAY<ARRAY<DOUBLE>> of length L, zero-padded on the left when ``pad``).
    ``checkpoint`` writes the input before it is ordered, for one that is costly to compute
    without a shuffle of its own; ``fix`` holds the ordered rows.
    """
    parts, keep = list(partition_by or []), list(keep or [])
    extra = [c for c in (member_cols or []) if c not in values]
    df = _prepared(df, parts, keep, extra, list(order), list(values), checkpoint)
    kept = list(dict.fromkeys([*parts, *keep]))
    member = T.StructType([T.StructField("pos", T.LongType()), *(df.schema[c] for c in [*extra, *values])])
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("seq_pos", T.LongType()), T.StructField("n_real", T.LongType()),
                           T.StructField("members", T.ArrayType(member)), T.StructField("seq", T.ArrayType(T.ArrayType(T.DoubleType())))])
    kind = to_arrow_type(member)

    def emit(rows: pa.Table, at: np.ndarray, start: int) -> pa.RecordBatch:
        tensor, chosen = _tensor(rows, values, length, at, start, pad)
        n_real = np.minimum(at[chosen] + 1, length)
        ends = np.cumsum(n_real)
        flat = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n_real, n_real)       # place in the window
        index = np.repeat(chosen - n_real + 1, n_real) + flat + start
        picked = rows.take(pa.array(index)).combine_chunks()
        cols = [pa.array(np.repeat(at[chosen] - n_real + 1, n_real) + flat, pa.int64()),
                *(picked[c].combine_chunks() if picked.num_rows else pa.array([], picked.schema.field(c).type) for c in [*extra, *values])]
        structs = pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(cols, kind)], fields=list(kind))
        offsets = pa.array(np.r_[0, ends].astype(np.int32))
        n, d = len(chosen), tensor.shape[2]
        inner = pa.ListArray.from_arrays(pa.array(np.arange(n * length + 1, dtype=np.int32) * d), pa.array(tensor.reshape(-1)))
        seq = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * length), inner)
        own = rows.slice(start).take(pa.array(chosen)).combine_chunks()
        head = [own[c].combine_chunks() if n else pa.array([], own.schema.field(c).type) for c in kept]
        return pa.RecordBatch.from_arrays([*head, pa.array(at[chosen], pa.int64()), pa.array(n_real, pa.int64()),
                                           pa.ListArray.from_arrays(offsets, structs), seq], names=schema.names)

    return _Slide.over(df, parts, list(order), length, fix).run(emit, schema)


def flat_windows(df: DataFrame, order: list[str], values: list[str], encode: Encode, length: int = SEQ_LEN,
                 partition_by: list[str] | None = None, keep: list[str] | None = None, out: str = "window",
                 fix: Fix = materialize) -> DataFrame:
    """W1 + W3 for models: each full window as one ARRAY<DOUBLE> ``out`` of its rows, one after
    another, with the ``keep`` columns of its last row and ``seq_pos``.  ``encode`` turns the rows'
    values ([n, d]) into a model's inputs ([n, e]) before they are windowed, once for each row."""
    parts, keep = list(partition_by or []), list(keep or [])
    df = _prepared(df, parts, keep, [], list(order), list(values), False)
    kept = list(dict.fromkeys([*parts, *keep]))
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("seq_pos", T.LongType()), T.StructField(out, T.ArrayType(T.DoubleType()))])

    def emit(rows: pa.Table, at: np.ndarray, start: int) -> pa.RecordBatch:
        tensor, chosen = _tensor(rows, values, length, at, start, False, encode)
        n, d = len(chosen), length * tensor.shape[2]
        own = rows.slice(start).take(pa.array(chosen)).combine_chunks()
        head = [own[c].combine_chunks() if n else pa.array([], own.schema.field(c).type) for c in kept]
        windows = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(tensor.reshape(-1)))
        return pa.RecordBatch.from_arrays([*head, pa.array(at[chosen], pa.int64()), windows], names=schema.names)

    return _Slide.over(df, parts, list(order), length, fix).run(emit, schema)


def score_sequences(df: DataFrame, order: list[str], values: list[str], model_fn: Callable[[np.ndarray], np.ndarray],
                    length: int = SEQ_LEN, pad: bool = False, partition_by: list[str] | None = None,
                    keep: list[str] | None = None, out: str = "score", checkpoint: bool = False, fix: Fix = materialize) -> DataFrame:
    """W1-W3 and K5 in one: scores ``[n, L, d] float64 tensor -> [n] scores`` of the windows of
    ordered rows, with the ``keep`` columns of their last rows and ``seq_pos``.  The tensor is a
    strided view over the rows; ``model_fn`` is shipped once per task."""
    parts, keep = list(partition_by or []), list(keep or [])
    df = _prepared(df, parts, keep, [], list(order), list(values), checkpoint)
    kept = list(dict.fromkeys([*parts, *keep]))
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("seq_pos", T.LongType()), T.StructField(out, T.DoubleType())])

    def emit(rows: pa.Table, at: np.ndarray, start: int) -> pa.RecordBatch:
        tensor, chosen = _tensor(rows, values, length, at, start, pad)
        scores = np.asarray(model_fn(tensor), np.float64).reshape(-1) if len(chosen) else np.zeros(0)
        own = rows.slice(start).take(pa.array(chosen)).combine_chunks()
        head = [own[c].combine_chunks() if len(chosen) else pa.array([], own.schema.field(c).type) for c in kept]
        return pa.RecordBatch.from_arrays([*head, pa.array(at[chosen], pa.int64()), pa.array(scores)], names=schema.names)

    return _Slide.over(df, parts, list(order), length, fix).run(emit, schema)


def warmup_fill(pred: DataFrame, position: str, length: int = SEQ_LEN, out: str = "pred") -> DataFrame:
    """The first L-1 rows of a batch get prediction 0 (all rows when the batch is
    shorter than L); ``position`` is the 1-based row number inside the batch."""
    return pred.withColumn(out, F.when(F.col(position) < length, F.lit(0))
                           .otherwise(F.coalesce(F.col(out), F.lit(0))))


def score_windows(windows: DataFrame, model_fn: Callable[[np.ndarray], np.ndarray],
                  seq: str = "seq", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """K5: score windows with a user function ``[n, L, d] float64 tensor -> [n] scores``.

    Runs as ``mapInArrow``: each window is flattened in Spark to a fixed-length
    ``ARRAY<DOUBLE>``, so an Arrow batch's list values reshape straight into the tensor
    (no per-row Python); key columns pass through as Arrow arrays.  ``model_fn`` is shipped
    once per task (load heavy models lazily inside it, once per Python worker)."""
    keep = list(keep or [c for c in windows.columns if c not in (seq, "members")])
    fields = [f for f in windows.schema.fields if f.name in keep]
    schema = T.StructType(fields + [T.StructField(out, T.DoubleType())])
    flat = windows.select(*keep, F.flatten(seq).alias("_flat"), F.size(seq).alias("_L"))

    def run(batches):
        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            col = rb.column(rb.schema.get_field_index("_flat"))
            length = rb.column(rb.schema.get_field_index("_L"))[0].as_py()
            values = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            tensor = values.reshape(n, length, -1)
            scores = np.asarray(model_fn(tensor), dtype=np.float64).reshape(-1)
            cols = [rb.column(rb.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(scores, pa.float64())],
                                             names=keep + [out])

    return flat.mapInArrow(run, schema)


def logistic_model(weights: list[float], bias: float) -> Callable[[np.ndarray], np.ndarray]:
    """A fixed logistic scorer over window means of each feature (test and demo model)."""
    w = np.asarray(weights, dtype=np.float64)

    def fn(tensor: np.ndarray) -> np.ndarray:
        z = tensor.mean(axis=1) @ w + bias
        return 1.0 / (1.0 + np.exp(-z))

    return fn

