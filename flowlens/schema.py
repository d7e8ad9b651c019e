"""Schemas and fixed column lists.

Fixed values that must equal the reference's for the same results: the feature lists, the
packet and flow fields, the label prefix, the status texts and the default addresses.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values (must match the reference) ---------------------------------------------
NUMERIC_FEATURES = [
    "duration", "orig_bytes", "resp_bytes", "missed_bytes",
    "orig_pkts", "orig_ip_bytes", "resp_pkts", "resp_ip_bytes",
]
CATEGORICAL_FEATURES = ["proto", "service", "conn_state", "history"]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
BENIGN_PREFIX = "benign"
ZEEK_NULLS = ["-", "(empty)"]
UNKNOWN_CATEGORY = "unknown"
PACKET_PROTOCOLS = ["tcp", "udp", "icmp"]
HISTORY_LEN = 10
SEQ_LEN = 5
ALERT_TEXT = "[ALERT] Malicious Botnet Traffic Detected!"
SAFE_TEXT = "[SAFE] Clean Traffic Detected!"
DEFAULT_WHITELIST = ["192.168.1.100"]
DEFAULT_ATTACKERS = ["192.168.1.150"]
MODEL_ORDER = ["lgb", "xgb", "lstm"]
# --------------------------------------------------------------------------------------------

# Connection log (tab separated, header; dotted names renamed)
CONN = T.StructType([
    T.StructField("ts", T.DoubleType()),
    T.StructField("uid", T.StringType()),
    T.StructField("orig_h", T.StringType()),
    T.StructField("orig_p", T.IntegerType()),
    T.StructField("resp_h", T.StringType()),
    T.StructField("resp_p", T.IntegerType()),
    T.StructField("proto", T.StringType()),
    T.StructField("service", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("orig_bytes", T.DoubleType()),
    T.StructField("resp_bytes", T.DoubleType()),
    T.StructField("conn_state", T.StringType()),
    T.StructField("local_orig", T.StringType()),
    T.StructField("local_resp", T.StringType()),
    T.StructField("missed_bytes", T.LongType()),
    T.StructField("history", T.StringType()),
    T.StructField("orig_pkts", T.LongType()),
    T.StructField("orig_ip_bytes", T.LongType()),
    T.StructField("resp_pkts", T.LongType()),
    T.StructField("resp_ip_bytes", T.LongType()),
    T.StructField("tunnel_parents", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("detailed_label", T.StringType()),
])

PACKET = T.StructType([
    T.StructField("arrival_seq", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("proto", T.StringType()),
    T.StructField("sport", T.IntegerType()),
    T.StructField("dport", T.IntegerType()),
    T.StructField("payload_len", T.IntegerType()),
    T.StructField("pkt_len", T.IntegerType()),
])

FLOW_COLUMNS = NUMERIC_FEATURES + CATEGORICAL_FEATURES + ["src_ip", "dst_ip", "sport", "dport"]

SCORED = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("key", T.LongType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("pred", T.IntegerType()),
])


def raw_string_schema(schema: T.StructType) -> T.StructType:
    """Same names, every field read as text (nulls normalised before a typed cast)."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
