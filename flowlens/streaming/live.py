"""Live detection: packets -> flows per event-time window -> 5-flow sequences -> score ->
threshold -> warm-up fill -> whitelist -> alert records (J1-J7, A17, W4, P14-P16).

The reference flushes a buffer of packets every wall-clock second.  Here a batch is an
event-time tumbling window (deterministic; a packet belongs to its own second), and the same
functions run on a static DataFrame (the *batch twin*, which also covers the final flush, J5)
or on a stream.

Stream plan (append mode):
  packets --withWatermark--> groupBy(window, flow key)     (A4; state per open window, dropped
                                                            once the watermark passes it)
          --foreachBatch--> the closed windows' flows       (append mode emits all flows of a
              -> batch twin: 5-flow sequences per window    window in one micro-batch)
                 -> score (mapInArrow) -> decisions
              -> parquet folder of the batch id, overwritten on replay (idempotent sink)
              -> with ``attackers``: totals of truth, score and decision over all batches so
                 far, from which ``running_scorecard`` gives the scorecard at any time
No window's flows are ever gathered into one row or one task.
"""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators.decisions import alert_record, decide, positive_score, whitelist_override
from flowlens.operators.features import FeatureModel
from flowlens.operators.flows import (aggregate_flows, event_time_of, filter_packets, in_a_flow,
                                      normalize_packets, with_flow_key)
from flowlens.operators.metrics import attach_row, merge_tallies, scorecard, scorecard_of_tally, tally
from flowlens.operators.labels import label_by_source
from flowlens.operators.sequences import Fix, score_sequences, sequence_windows, warmup_fill
from flowlens.plans.materialize import materialize
from flowlens.schema import DEFAULT_ATTACKERS, DEFAULT_WHITELIST, SEQ_LEN

FLOW_ID = ["src_ip", "sport", "dst_ip", "dport"]
ALERT_KEEP = ["window_start"] + FLOW_ID + ["proto", "conn_state", "first_seq"]


def live_flows(packets: DataFrame, window: str = "1 second", history: bool = True) -> DataFrame:
    """J1 + J2: flows per event-time window (state never crosses windows)."""
    return aggregate_flows(packets, window=window, history=history)


def live_sequences(flows: DataFrame, values: list[str], length: int = SEQ_LEN,
                   pad: bool = True, keep: list[str] | None = None, fix: Fix = materialize) -> DataFrame:
    """Per window, flows in first-arrival order, windows of ``length`` flows.
    ``seq_pos`` is the 0-based position of the flow inside its window."""
    keep = [c for c in (keep or ALERT_KEEP) if c != "window_start"]
    return sequence_windows(flows, ["first_seq"], values, length=length, pad=pad,
                            partition_by=["window_start"], keep=keep,
                            member_cols=["first_seq"], fix=fix)


def decide_alerts(scored: DataFrame, t: float, whitelist=DEFAULT_WHITELIST,
                  length: int = SEQ_LEN, position: str = "seq_pos") -> DataFrame:
    """J4 after scoring: threshold (P13) -> warm-up fill (W4) -> whitelist (P14) -> record."""
    d = decide(scored, t).withColumn("_row", F.col(position) + 1)
    return alert_record(whitelist_override(warmup_fill(d, "_row", length).drop("_row"), whitelist))


def live_alerts(flows: DataFrame, model_fn: Callable[[np.ndarray], np.ndarray], t: float,
                values: list[str], whitelist=DEFAULT_WHITELIST, length: int = SEQ_LEN, fix: Fix = materialize) -> DataFrame:
    """J4 on a static flow table (batch twin)."""
    scored = score_sequences(flows, ["first_seq"], values, model_fn, length=length, pad=True, partition_by=["window_start"],
                             keep=ALERT_KEEP, fix=fix)
    return decide_alerts(scored, t, whitelist, length)


def fitted_live_alerts(flows: DataFrame, fm: FeatureModel, model: PipelineModel, t: float,
                       whitelist=DEFAULT_WHITELIST, length: int = SEQ_LEN, rows: bool = False, fix: Fix = materialize) -> DataFrame:
    """J4 with fitted preprocessing and a fitted model: a sequence model scores padded windows
    of prepared flows (the first ``length - 1`` of a window are warm-up); with ``rows`` a row
    model scores each prepared flow by itself, without warm-up."""
    if rows:
        scored = decide(positive_score(model.transform(fm.transform(flows))).select(*ALERT_KEEP, "score"), t)
        return alert_record(whitelist_override(scored, whitelist))
    seqs = live_sequences(fm.prepare(flows), fm.row_values, length=length, pad=True, fix=fix)
    vectors = fm.window_vectors(seqs, length)
    scored = positive_score(model.transform(vectors)).select(*ALERT_KEEP, "seq_pos", "score")
    return decide_alerts(scored, t, whitelist, length)


def window_throughput(packets: DataFrame, window: str = "1 second") -> DataFrame:
    """Packets, flows and packets per second of each window.  Flows are counted as
    distinct keys; no flow is built."""
    seconds = F.lit(float(_seconds(window)))
    p = (packets.withColumn("event_time", event_time_of(packets, "ts"))
         .groupBy(F.window("event_time", window).start.alias("window_start"))
         .agg(F.count(F.lit(1)).alias("packets")))
    kept = with_flow_key(normalize_packets(filter_packets(packets)))
    f = (kept.withColumn("event_time", event_time_of(kept, "ts"))
         .select(F.window("event_time", window).start.alias("window_start"), "lo", "hi").distinct()
         .groupBy("window_start").agg(F.count(F.lit(1)).alias("flows")))
    return (p.join(f, "window_start", "left").fillna(0, ["flows"])
            .withColumn("pkts_per_s", F.col("packets") / seconds))


def live_scorecard(alerts: DataFrame, attackers=DEFAULT_ATTACKERS) -> DataFrame:
    """Ground truth by source (P15), accumulated predictions, one scorecard (A10)."""
    return scorecard(_with_truth(alerts, attackers), ["dataset"], y="y", score="score", pred="pred")


def _with_truth(alerts: DataFrame, attackers) -> DataFrame:
    return label_by_source(alerts, attackers).withColumn("dataset", F.lit("live"))


def _seconds(window: str) -> float:
    n, unit = window.split()
    scale = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600,
             "hours": 3600, "day": 86400, "days": 86400}[unit]
    return float(n) * scale


# ---- Structured Streaming -----------------------------------------------------------------

def stream_flows(packets: DataFrame, window: str = "1 second",
                 watermark: str = "0 seconds") -> DataFrame:
    """J1/J2/J7 on a stream: windowed flow aggregation; rows later than the watermark are
    dropped; a window's flows are emitted once the watermark passes its end."""
    p = packets.withColumn("event_time", event_time_of(packets, "ts")) \
        .withWatermark("event_time", watermark)
    return aggregate_flows(p, window=window, keep_window=True)


def stream_throughput(packets: DataFrame, window: str = "1 second", watermark: str = "0 seconds") -> DataFrame:
    """A17 on a stream: the rows of ``window_throughput`` for each window the watermark has
    passed.  Packets are counted per flow key (none for a packet outside every flow), then per
    window; state holds one row per flow of an open window."""
    p = packets.withColumn("event_time", event_time_of(packets, "ts")).withWatermark("event_time", watermark)
    keyed = with_flow_key(normalize_packets(p.withColumn("_kept", in_a_flow())))
    flows = keyed.groupBy(F.window("event_time", window), F.when(F.col("_kept"), F.col("lo")).alias("lo"),
                          F.when(F.col("_kept"), F.col("hi")).alias("hi")).agg(F.count(F.lit(1)).alias("packets"))
    return (flows.groupBy("window").agg(F.sum("packets").alias("packets"), F.count("lo").alias("flows"))
            .select(F.col("window.start").alias("window_start"), "packets", "flows",
                    (F.col("packets") / F.lit(float(_seconds(window)))).alias("pkts_per_s")))


TALLY = "dataset string, y boolean, score double, pred boolean, n bigint, through bigint"


def _totals_path(out_path: str, batch_id: int) -> str:
    return f"{out_path.rstrip('/')}/_totals/slot={batch_id % 2}"


def _totals(spark: SparkSession, path: str) -> DataFrame:
    """Totals saved at ``path``, none where nothing has been saved."""
    try:
        return spark.read.schema(TALLY).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], TALLY)


def add_to_totals(out_path: str, batch_id: int, alerts: DataFrame | None, spark: SparkSession, attackers=DEFAULT_ATTACKERS) -> None:
    """Totals through ``batch_id``: those through the batch before plus this batch's alerts.
    Two slots take turns, so the slot read is never the one written: a batch that is run again
    counts once.  Batches before evaluation began, or before a break in it, are not counted."""
    parts = _totals(spark, _totals_path(out_path, batch_id - 1)).where(F.col("through") == batch_id - 1).drop("through")
    if alerts is not None:
        parts = parts.unionByName(tally(_with_truth(alerts, attackers), ["dataset"]))
    (merge_tallies(parts, ["dataset"]).withColumn("through", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").parquet(_totals_path(out_path, batch_id)))


def running_scorecard(spark: SparkSession, out_path: str) -> DataFrame:
    """J6 while the stream runs: the scorecard of all alerts through the last finished batch, equal
    to ``live_scorecard`` of the alerts written.  Reads the totals, not the alerts; no row before
    the first alert."""
    both = _totals(spark, _totals_path(out_path, 0)).unionByName(_totals(spark, _totals_path(out_path, 1)))
    last = attach_row(both, both.agg(F.max("through").alias("_last"))).where(F.col("through") == F.col("_last"))
    return scorecard_of_tally(last.drop("through", "_last"), ["dataset"])


def alert_batch_writer(out_path: str, alerts_of: Callable[[DataFrame], DataFrame], attackers=None):
    """``foreachBatch`` handler: the flows of the windows closed in this micro-batch (append
    mode emits every flow of a window in the same batch) go through the exact batch twin
    (J3/J4, no per-window collect) and are written to the batch's own folder with overwrite, so a
    replayed batch id replaces its output instead of duplicating.  With ``attackers`` the alerts
    written are added to the totals of ``running_scorecard``.

    Flows, and their ordered form, are held in executor memory for the batch: no checkpoint is
    written.  Their lineage stays, so blocks of a lost executor are made again."""
    def handle(flows: DataFrame, batch_id: int) -> None:
        held: list[DataFrame] = []

        def hold(df: DataFrame) -> DataFrame:
            held.append(df.persist())
            return held[-1]

        batch_id, spark = int(batch_id), flows.sparkSession
        flows = hold(flows.drop("window"))       # else each action runs the aggregation again
        try:
            if flows.isEmpty():
                if attackers is not None:
                    add_to_totals(out_path, batch_id, None, spark, attackers)
                return
            fixed = {"fix": hold} if "fix" in inspect.signature(alerts_of).parameters else {}
            (alerts_of(flows, **fixed).withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))
            if attackers is not None:
                add_to_totals(out_path, batch_id, spark.read.parquet(f"{out_path}/batch_id={batch_id}"), spark, attackers)
        finally:
            for df in held:
                df.unpersist()
    return handle


def start_alert_stream(packets: DataFrame, out_path: str,
                       model_fn: Callable[[np.ndarray], np.ndarray] | None = None,
                       t: float = 0.5, values: list[str] | None = None, window: str = "1 second",
                       watermark: str = "0 seconds", whitelist=DEFAULT_WHITELIST,
                       length: int = SEQ_LEN, checkpoint: str | None = None,
                       trigger_once: bool = False,
                       alerts_of: Callable[[DataFrame], DataFrame] | None = None,
                       attackers=None):
    """J1-J5/J7 + S8 on a stream: stateful flow aggregation per event-time window (state is
    dropped once the watermark passes), then each micro-batch of closed windows is scored and
    decided by ``alert_batch_writer``: by ``model_fn`` over the ``values`` columns, or by
    ``alerts_of`` (flows -> alerts), e.g. ``fitted_live_alerts`` with a saved model.  The checkpoint lives beside the output unless given,
    so streams to different outputs never share one and a later session finds it again.
    ``attackers`` (a list or a table of addresses) turns accumulated evaluation on, see
    ``running_scorecard``."""
    checkpoint = checkpoint or f"{out_path.rstrip('/')}/_checkpoint"
    w = (stream_flows(packets, window, watermark).writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(alert_batch_writer(out_path, alerts_of or functools.partial(
             live_alerts, model_fn=model_fn, t=t, values=values, whitelist=whitelist, length=length), attackers)))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
