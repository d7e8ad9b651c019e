"""Conformance queries over V2 (packets) and V4 (conversation turns): P7-P12, A4, W5, W6, O2."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.operators import flows as fl
from flowlens.plans import views

DAY_US = 86_400_000_000


def _round(c: str, n: int = 6):
    return F.round(F.col(c), n).alias(c)


def _flows(spark, sf, window=None):
    return fl.aggregate_flows(views.packet_view(spark, sf), window=window)


FLOW_OUT = ["src_ip", "sport", "dst_ip", "dport", "proto", "service", "conn_state", "history",
            "orig_bytes", "resp_bytes", "missed_bytes", "orig_pkts", "orig_ip_bytes",
            "resp_pkts", "resp_ip_bytes", "first_seq"]


def q_packet_filter(spark, sf):
    p = fl.filter_packets(views.packet_view(spark, sf, filtered=False))
    return p.select("arrival_seq", F.unix_micros("ts").alias("ts_us"), "src_ip", "dst_ip",
                    "proto", "sport", "dport", "payload_len", "pkt_len")


def q_packet_normalize(spark, sf):
    p = fl.normalize_packets(views.packet_view(spark, sf, filtered=False))
    return p.select("arrival_seq", "proto", "sport", "dport", "payload_len", "pkt_len")


def q_flow_key(spark, sf):
    p = fl.with_flow_key(fl.normalize_packets(fl.filter_packets(views.packet_view(spark, sf))))
    return p.select("arrival_seq", F.col("lo.ip").alias("lo_ip"), F.col("lo.port").alias("lo_port"),
                    F.col("hi.ip").alias("hi_ip"), F.col("hi.port").alias("hi_port"), "is_lo")


def q_flow_initiator(spark, sf):
    return _flows(spark, sf).select("src_ip", "sport", "dst_ip", "dport", "first_seq",
                                    _round("start_time"))


def q_flow_history(spark, sf):
    return _flows(spark, sf).select("src_ip", "sport", "dst_ip", "dport", "history")


def q_flow_aggregate(spark, sf):
    return _flows(spark, sf).select(*FLOW_OUT, _round("duration"))


def q_flow_service(spark, sf):
    return _flows(spark, sf).select("src_ip", "sport", "dst_ip", "dport", "service")


def q_flow_state(spark, sf):
    return _flows(spark, sf).select("src_ip", "sport", "dst_ip", "dport", "conn_state")


def q_flow_by_window(spark, sf):
    f = _flows(spark, sf, window="1 day")
    return f.select(F.unix_seconds("window_start").alias("window_start"), *FLOW_OUT,
                    _round("duration"))


def q_turn_flow_history(spark, sf):
    f = fl.aggregate_flows(views.turn_view(spark, sf))
    return f.select("src_ip", "dst_ip", "history", "conn_state", "first_seq")


def q_turn_flow_aggregate(spark, sf):
    f = fl.aggregate_flows(views.turn_view(spark, sf))
    return f.select("src_ip", "dst_ip", "orig_pkts", "orig_bytes", "orig_ip_bytes", "resp_pkts",
                    "resp_bytes", "resp_ip_bytes", _round("duration"), "first_seq")


# ---- oracle SQL ------------------------------------------------------------------------------

def flows_sql(source_sql: str, ts_expr: str, window_us: int | None = None) -> str:
    """Window formulation of the flow table: the initiator is the first packet of the sorted
    endpoint pair, direction = same (ip, port) as that packet, letters by string_agg."""
    wkey = f"epoch_us(ts) // {window_us}" if window_us else "0"
    return f"""
WITH p AS ({source_sql}),
k AS (SELECT *, {ts_expr} AS ts_s, {wkey} AS wid,
        (src_ip < dst_ip OR (src_ip = dst_ip AND sport <= dport)) AS is_lo FROM p),
k2 AS (SELECT *, CASE WHEN is_lo THEN src_ip ELSE dst_ip END AS lo_ip,
        CASE WHEN is_lo THEN sport ELSE dport END AS lo_port,
        CASE WHEN is_lo THEN dst_ip ELSE src_ip END AS hi_ip,
        CASE WHEN is_lo THEN dport ELSE sport END AS hi_port FROM k),
o AS (SELECT *, first_value(src_ip) OVER w AS f_src, first_value(sport) OVER w AS f_sport,
        first_value(dst_ip) OVER w AS f_dst, first_value(dport) OVER w AS f_dport,
        first_value(proto) OVER w AS f_proto, first_value(ts_s) OVER w AS f_ts
      FROM k2 WINDOW w AS (PARTITION BY wid, lo_ip, lo_port, hi_ip, hi_port ORDER BY arrival_seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
d AS (SELECT *, (src_ip = f_src AND sport = f_sport) AS is_orig FROM o),
g AS (SELECT wid, f_src AS src_ip, f_sport AS sport, f_dst AS dst_ip, f_dport AS dport,
        f_proto AS proto, min(arrival_seq) AS first_seq, min(f_ts) AS start_time,
        max(ts_s) - min(f_ts) AS duration,
        CAST(sum(CASE WHEN is_orig THEN payload_len ELSE 0 END) AS BIGINT) AS orig_bytes,
        CAST(sum(CASE WHEN is_orig THEN 0 ELSE payload_len END) AS BIGINT) AS resp_bytes,
        CAST(0 AS BIGINT) AS missed_bytes,
        count(*) FILTER (WHERE is_orig) AS orig_pkts,
        CAST(sum(CASE WHEN is_orig THEN pkt_len ELSE 0 END) AS BIGINT) AS orig_ip_bytes,
        count(*) FILTER (WHERE NOT is_orig) AS resp_pkts,
        CAST(sum(CASE WHEN is_orig THEN 0 ELSE pkt_len END) AS BIGINT) AS resp_ip_bytes,
        bool_or(is_orig AND payload_len <= 0) AS has_s,
        bool_or(NOT is_orig AND payload_len <= 0) AS has_a,
        substr(string_agg(CASE WHEN is_orig THEN (CASE WHEN payload_len > 0 THEN 'd' ELSE 's' END)
                          ELSE (CASE WHEN payload_len > 0 THEN 'D' ELSE 'a' END) END, ''
                          ORDER BY arrival_seq), 1, 10) AS history
      FROM d GROUP BY wid, lo_ip, lo_port, hi_ip, hi_port, f_src, f_sport, f_dst, f_dport, f_proto)
SELECT *, CAST(wid * {(window_us or 0) // 1_000_000} AS BIGINT) AS window_start,
  CASE WHEN has_s AND has_a THEN 'SF' WHEN has_s THEN 'S0' ELSE 'OTH' END AS conn_state,
  CASE WHEN dport = 80 OR sport = 80 THEN 'http' WHEN dport = 53 OR sport = 53 THEN 'dns'
       WHEN dport = 443 OR sport = 443 THEN 'ssl' ELSE '-' END AS service
FROM g"""


TS_OF_TIMESTAMP = "CAST(epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE)"
FLOWS_V2 = flows_sql(views.V2_SQL, TS_OF_TIMESTAMP)
FLOWS_V2_DAY = flows_sql(views.V2_SQL, TS_OF_TIMESTAMP, DAY_US)
FLOWS_V4 = flows_sql(views.V4_SQL, "CAST(ts AS DOUBLE)")
_FLOW_COLS = ", ".join(FLOW_OUT)

ORACLE = {
    "packet_filter": f"""SELECT arrival_seq, epoch_us(ts) AS ts_us, src_ip, dst_ip, proto, sport,
        dport, payload_len, pkt_len FROM ({views.V2_SQL_UNFILTERED}) v
        WHERE lower(trim(proto)) IN ('tcp', 'udp', 'icmp') AND src_ip IS NOT NULL
          AND dst_ip IS NOT NULL""",
    "packet_normalize": f"""SELECT arrival_seq, lower(trim(proto)) AS proto,
        CAST(CASE WHEN lower(trim(proto)) = 'icmp' THEN 0 ELSE coalesce(sport, 0) END AS INTEGER) AS sport,
        CAST(CASE WHEN lower(trim(proto)) = 'icmp' THEN 0 ELSE coalesce(dport, 0) END AS INTEGER) AS dport,
        CAST(CASE WHEN lower(trim(proto)) = 'icmp' THEN 0 ELSE coalesce(payload_len, 0) END AS INTEGER) AS payload_len,
        CAST(coalesce(pkt_len, 0) AS INTEGER) AS pkt_len
        FROM ({views.V2_SQL_UNFILTERED}) v""",
    "flow_key": f"""SELECT arrival_seq,
        CASE WHEN is_lo THEN src_ip ELSE dst_ip END AS lo_ip,
        CASE WHEN is_lo THEN sport ELSE dport END AS lo_port,
        CASE WHEN is_lo THEN dst_ip ELSE src_ip END AS hi_ip,
        CASE WHEN is_lo THEN dport ELSE sport END AS hi_port, is_lo
        FROM (SELECT *, (src_ip < dst_ip OR (src_ip = dst_ip AND sport <= dport)) AS is_lo
              FROM ({views.V2_SQL}) v) k""",
    "flow_initiator": f"SELECT src_ip, sport, dst_ip, dport, first_seq, round(start_time, 6) AS start_time FROM ({FLOWS_V2}) f",
    "flow_history": f"SELECT src_ip, sport, dst_ip, dport, history FROM ({FLOWS_V2}) f",
    "flow_aggregate": f"SELECT {_FLOW_COLS}, round(duration, 6) AS duration FROM ({FLOWS_V2}) f",
    "flow_service": f"SELECT src_ip, sport, dst_ip, dport, service FROM ({FLOWS_V2}) f",
    "flow_state": f"SELECT src_ip, sport, dst_ip, dport, conn_state FROM ({FLOWS_V2}) f",
    "flow_by_window": f"SELECT window_start, {_FLOW_COLS}, round(duration, 6) AS duration FROM ({FLOWS_V2_DAY}) f",
    "turn_flow_history": f"SELECT src_ip, dst_ip, history, conn_state, first_seq FROM ({FLOWS_V4}) f",
    "turn_flow_aggregate": f"""SELECT src_ip, dst_ip, orig_pkts, orig_bytes, orig_ip_bytes, resp_pkts,
        resp_bytes, resp_ip_bytes, round(duration, 6) AS duration, first_seq FROM ({FLOWS_V4}) f""",
}

QUERIES = {
    "packet_filter": q_packet_filter,
    "packet_normalize": q_packet_normalize,
    "flow_key": q_flow_key,
    "flow_initiator": q_flow_initiator,
    "flow_history": q_flow_history,
    "flow_aggregate": q_flow_aggregate,
    "flow_service": q_flow_service,
    "flow_state": q_flow_state,
    "flow_by_window": q_flow_by_window,
    "turn_flow_history": q_turn_flow_history,
    "turn_flow_aggregate": q_turn_flow_aggregate,
}
