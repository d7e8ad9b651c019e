"""Packets -> bidirectional flows.

Plan (batch):
  * one hash aggregate (partial before the shuffle, final after) keyed by the canonical
    endpoint pair ``lo = least((src_ip, sport), (dst_ip, dport))``, ``hi = greatest(...)``.
    Every counter is kept per canonical side; ``min_by(is_lo, arrival_seq)`` says which side
    initiated, and a projection swaps sides afterwards.  A hot flow costs one partial row per
    map task, whatever its size.
  * the 10-letter history is kept in the same aggregate by ``first_k``, a buffer of 10 slots that
    merges with others of its kind: a map task ships, and streaming state holds, 10 packets of
    a flow at most, whatever the flow sends.  One scan, one exchange.
  * the connection state is decided from counters over the *untruncated* history.
Streaming uses the same aggregate per event-time window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.internal import InternalFunction

from flowlens.functions.columns import conn_state, epoch_micros, service_from_ports
from flowlens.schema import HISTORY_LEN, PACKET_PROTOCOLS


def seconds_of(df: DataFrame, c: str = "ts") -> Column:
    """Event time as DOUBLE seconds (timestamps via microseconds; doubles kept as they are)."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(c, dt).cast("double") / F.lit(1_000_000.0)
    return F.col(c).cast("double")


def event_time_of(df: DataFrame, c: str = "ts") -> Column:
    """Event time as TIMESTAMP (for windows and watermarks)."""
    dt = df.schema[c].dataType
    if isinstance(dt, T.TimestampType):
        return F.col(c)
    if isinstance(dt, T.TimestampNTZType):
        return F.timestamp_micros(epoch_micros(c, dt))
    return F.timestamp_seconds(F.col(c))


def in_a_flow() -> Column:
    """P7 as a condition: an IP packet (both addresses present) of tcp, udp or icmp."""
    proto = F.lower(F.trim(F.col("proto")))
    return proto.isin(*PACKET_PROTOCOLS) & F.col("src_ip").isNotNull() & F.col("dst_ip").isNotNull()


def filter_packets(packets: DataFrame) -> DataFrame:
    """Keep IP packets (both addresses present) of tcp, udp or icmp."""
    return packets.where(in_a_flow())


def normalize_packets(packets: DataFrame) -> DataFrame:
    """Lower-case protocol; icmp has ports 0 and payload 0; a missing payload is 0."""
    proto = F.lower(F.trim(F.col("proto")))
    icmp = proto == "icmp"
    return packets.withColumns({
        "proto": proto,
        "sport": F.when(icmp, 0).otherwise(F.coalesce("sport", F.lit(0))).cast("int"),
        "dport": F.when(icmp, 0).otherwise(F.coalesce("dport", F.lit(0))).cast("int"),
        "payload_len": F.when(icmp, 0).otherwise(F.coalesce("payload_len", F.lit(0))).cast("int"),
        "pkt_len": F.coalesce("pkt_len", F.lit(0)).cast("int"),
    })


def _key_columns() -> dict:
    a = F.struct(F.col("src_ip").alias("ip"), F.col("sport").alias("port"))
    b = F.struct(F.col("dst_ip").alias("ip"), F.col("dport").alias("port"))
    return {"lo": F.least(a, b), "hi": F.greatest(a, b), "is_lo": a == F.least(a, b)}


def with_flow_key(packets: DataFrame) -> DataFrame:
    """O2: canonical endpoint pair (lexicographic on (ip, port)) and the packet's side."""
    return packets.withColumns(_key_columns())


def _proto_code() -> Column:
    return (F.when(F.col("proto") == "tcp", 0).when(F.col("proto") == "udp", 1)
            .when(F.col("proto") == "icmp", 2).otherwise(3))


def _proto_name() -> Column:
    return (F.when(F.col("proto_code") == 0, "tcp").when(F.col("proto_code") == 1, "udp")
            .when(F.col("proto_code") == 2, "icmp").otherwise("other"))


def _letters(init_lo: Column, arr: Column) -> Column:
    """History letters: orig s/d, resp a/D, by zero / non-zero payload, in arrival order."""
    return F.array_join(F.transform(arr, lambda x: F.when(
        x["is_lo"] == init_lo, F.when(x["data"], F.lit("d")).otherwise(F.lit("s"))
    ).otherwise(F.when(x["data"], F.lit("D")).otherwise(F.lit("a")))), "")


def first_k(value: Column, k: int) -> Column:
    """Aggregate: the ``k`` smallest values of a group, ascending.  The buffer holds ``k`` values on
    either side of a shuffle and in streaming state."""
    return F.array_sort(InternalFunction.collect_top_k(value, k, True))


def aggregate_flows(packets: DataFrame, window: str | None = None,
                    history_len: int = HISTORY_LEN, key_includes_proto: bool = False,
                    missing_service: str = "-", history_plan: str = "slots",
                    prepared: bool = False, keep_window: bool = False,
                    history: bool = True) -> DataFrame:
    """A4: packets -> one row per flow (per event-time window when ``window`` is given).

    Packets without a time belong to no flow, with or without windows.  ``history=False``
    leaves the history letters and their top-k branch out.

    ``history_plan``: ``slots`` (letters in the same aggregate) or ``rank`` (batch only: a bounded
    top-k before a second exchange, joined to the counters).  ``keep_window`` also returns the ``window`` struct, whose
    event-time metadata lets a stream chain a second windowed aggregation.
    """
    p = packets if prepared else normalize_packets(filter_packets(packets))
    p = p.where(F.col("ts").isNotNull())
    extra = dict(_key_columns())
    extra["ts_s"] = seconds_of(p, "ts")
    extra["data"] = F.col("payload_len") > 0
    extra["proto_code"] = _proto_code()
    if window and "event_time" not in p.columns:
        extra["event_time"] = event_time_of(p, "ts")
    p = p.withColumns(extra)
    keys: list[Column] = []
    if window:
        keys.append(F.window("event_time", window).alias("window"))
    keys += [F.col("lo"), F.col("hi")]
    if key_includes_proto:
        keys.append(F.col("proto").alias("key_proto"))

    side = F.col("is_lo")
    aggs = [
        F.min("arrival_seq").alias("first_seq"),
        F.min_by("is_lo", "arrival_seq").alias("init_lo"),
        F.min_by("ts_s", "arrival_seq").alias("start_time"),
        F.max("ts_s").alias("end_time"),
        # protocol as a small int: a fixed-width buffer keeps this a HashAggregate
        F.min_by("proto_code", "arrival_seq").alias("proto_code"),
        F.count_if(side).alias("lo_pkts"),
        F.count_if(~side).alias("hi_pkts"),
        F.sum(F.when(side, F.col("payload_len")).otherwise(0)).alias("lo_bytes"),
        F.sum(F.when(~side, F.col("payload_len")).otherwise(0)).alias("hi_bytes"),
        F.sum(F.when(side, F.col("pkt_len")).otherwise(0)).alias("lo_ip_bytes"),
        F.sum(F.when(~side, F.col("pkt_len")).otherwise(0)).alias("hi_ip_bytes"),
        F.count_if(side & ~F.col("data")).alias("lo_zero"),
        F.count_if(~side & ~F.col("data")).alias("hi_zero"),
    ]
    step = F.struct(F.col("arrival_seq").alias("seq"), F.col("is_lo"), F.col("data"))
    if history and history_plan == "slots":
        aggs.append(first_k(step, history_len).alias("h"))
    flows = p.groupBy(*keys).agg(*aggs)
    key_names = [c for c in flows.columns if c in ("window", "lo", "hi", "key_proto")]
    if history and history_plan == "rank":
        part = [F.col(c) for c in key_names]
        ranked = (p.select(*keys, "arrival_seq", "is_lo", "data")
                  .withColumn("rn", F.row_number().over(
                      Window.partitionBy(*part).orderBy("arrival_seq")))
                  .where(F.col("rn") <= history_len))
        hist = ranked.groupBy(*part).agg(F.array_sort(F.collect_list(step)).alias("h"))
        flows = flows.join(hist, key_names)

    init = F.col("init_lo")

    def pick(lo_c: str, hi_c: str, orig: bool = True) -> Column:
        a, b = (F.col(lo_c), F.col(hi_c)) if orig else (F.col(hi_c), F.col(lo_c))
        return F.when(init, a).otherwise(b)

    out = flows.select(
        *([F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
          if window else []),
        *([F.col("window")] if window and keep_window else []),
        F.when(init, F.col("lo.ip")).otherwise(F.col("hi.ip")).alias("src_ip"),
        F.when(init, F.col("lo.port")).otherwise(F.col("hi.port")).alias("sport"),
        F.when(init, F.col("hi.ip")).otherwise(F.col("lo.ip")).alias("dst_ip"),
        F.when(init, F.col("hi.port")).otherwise(F.col("lo.port")).alias("dport"),
        _proto_name().alias("proto"),
        (F.col("end_time") - F.col("start_time")).alias("duration"),
        F.greatest(pick("lo_bytes", "hi_bytes"), F.lit(0)).cast("bigint").alias("orig_bytes"),
        F.greatest(pick("lo_bytes", "hi_bytes", False), F.lit(0)).cast("bigint").alias("resp_bytes"),
        F.lit(0).cast("bigint").alias("missed_bytes"),
        pick("lo_pkts", "hi_pkts").alias("orig_pkts"),
        pick("lo_ip_bytes", "hi_ip_bytes").cast("bigint").alias("orig_ip_bytes"),
        pick("lo_pkts", "hi_pkts", False).alias("resp_pkts"),
        pick("lo_ip_bytes", "hi_ip_bytes", False).cast("bigint").alias("resp_ip_bytes"),
        conn_state(pick("lo_zero", "hi_zero") > 0, pick("lo_zero", "hi_zero", False) > 0)
        .alias("conn_state"),
        *([_letters(init, F.col("h")).alias("history")] if history else []),
        F.col("first_seq"), F.col("start_time"), F.col("end_time"),
    )
    return out.withColumn("service", service_from_ports("sport", "dport", missing_service))
