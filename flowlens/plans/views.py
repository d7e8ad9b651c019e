"""Conformance views V1-V4 over the driver's tables.

The driver ships no network data, so each conformance query starts from one of four views
derived by integer arithmetic from ``events`` / ``conversations``.  They are deterministic in
both Spark and DuckDB, and their work grows with the tables.  Each view exists twice: a
DataFrame builder (what the queries run) and the equivalent SQL (what the oracle runs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.columns import ntz_micros


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch_seconds(ts) -> "F.Column":
    # NTZ wall time read as UTC, whatever the session time zone; micros / 1e6 as DOUBLE
    return ntz_micros(ts).cast("double") / F.lit(1_000_000.0)


def conn_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: a labelled connection log (CONN schema) derived from ``events``."""
    e = read_table(spark, sf_dir, "events")
    eid, uid_ = F.col("event_id"), F.col("user_id")
    null_row = (eid % 5) < 3
    orig_pkts = F.lit(1) + eid % 7
    resp_pkts = eid % 4
    et = F.col("event_type")
    return e.select(
        _epoch_seconds(F.col("ts")).alias("ts"),
        F.concat(F.lit("C"), eid.cast("string")).alias("uid"),
        F.concat(F.lit("10.0.0."), (uid_ % 20).cast("string")).alias("orig_h"),
        (F.lit(49152) + uid_ % 40).cast("int").alias("orig_p"),
        F.concat(F.lit("10.0.1."), (uid_ % 7).cast("string")).alias("resp_h"),
        F.when(uid_ % 4 == 0, 80).when(uid_ % 4 == 1, 53).when(uid_ % 4 == 2, 443)
        .otherwise(23).cast("int").alias("resp_p"),
        F.when(eid % 10 == 0, "udp").otherwise("tcp").alias("proto"),
        F.when(et == "view", "http").when(et == "purchase", "dns").alias("service"),
        F.when(null_row, None).otherwise(F.col("value") / 10).cast("double").alias("duration"),
        F.when(null_row, None).otherwise((eid * 37) % 1500).cast("double").alias("orig_bytes"),
        F.when(null_row, None).otherwise((eid * 91) % 4000).cast("double").alias("resp_bytes"),
        F.when(uid_ % 5 == 0, "S0").when(uid_ % 5 == 1, "OTH").when(uid_ % 5 == 2, "SF")
        .when(uid_ % 5 == 3, "S3").otherwise("RSTR").alias("conn_state"),
        F.lit(None).cast("string").alias("local_orig"),
        F.lit(None).cast("string").alias("local_resp"),
        F.when(eid % 500 == 0, 5792).otherwise(0).cast("bigint").alias("missed_bytes"),
        F.when(uid_ % 4 == 0, "S").when(uid_ % 4 == 1, "C").when(uid_ % 4 == 2, "Dd")
        .otherwise("ShAdDaf").alias("history"),
        orig_pkts.cast("bigint").alias("orig_pkts"),
        (orig_pkts * 60).cast("bigint").alias("orig_ip_bytes"),
        resp_pkts.cast("bigint").alias("resp_pkts"),
        (resp_pkts * 52).cast("bigint").alias("resp_ip_bytes"),
        F.lit(None).cast("string").alias("tunnel_parents"),
        F.when(et == "error", " Malicious ").when(et == "signup", None)
        .when(et == "click", "BENIGN ").otherwise("Benign").alias("label"),
        F.when(et == "error", "DDoS").alias("detailed_label"),
    )


V1_SQL = """
SELECT CAST(epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS ts,
  'C' || CAST(event_id AS VARCHAR) AS uid,
  '10.0.0.' || CAST(user_id % 20 AS VARCHAR) AS orig_h,
  CAST(49152 + user_id % 40 AS INTEGER) AS orig_p,
  '10.0.1.' || CAST(user_id % 7 AS VARCHAR) AS resp_h,
  CAST(CASE user_id % 4 WHEN 0 THEN 80 WHEN 1 THEN 53 WHEN 2 THEN 443 ELSE 23 END AS INTEGER) AS resp_p,
  CASE WHEN event_id % 10 = 0 THEN 'udp' ELSE 'tcp' END AS proto,
  CASE event_type WHEN 'view' THEN 'http' WHEN 'purchase' THEN 'dns' END AS service,
  CASE WHEN event_id % 5 < 3 THEN NULL ELSE value / 10 END AS duration,
  CASE WHEN event_id % 5 < 3 THEN NULL ELSE CAST((event_id * 37) % 1500 AS DOUBLE) END AS orig_bytes,
  CASE WHEN event_id % 5 < 3 THEN NULL ELSE CAST((event_id * 91) % 4000 AS DOUBLE) END AS resp_bytes,
  CASE user_id % 5 WHEN 0 THEN 'S0' WHEN 1 THEN 'OTH' WHEN 2 THEN 'SF' WHEN 3 THEN 'S3' ELSE 'RSTR' END AS conn_state,
  CAST(NULL AS VARCHAR) AS local_orig, CAST(NULL AS VARCHAR) AS local_resp,
  CAST(CASE WHEN event_id % 500 = 0 THEN 5792 ELSE 0 END AS BIGINT) AS missed_bytes,
  CASE user_id % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'C' WHEN 2 THEN 'Dd' ELSE 'ShAdDaf' END AS history,
  CAST(1 + event_id % 7 AS BIGINT) AS orig_pkts,
  CAST(60 * (1 + event_id % 7) AS BIGINT) AS orig_ip_bytes,
  CAST(event_id % 4 AS BIGINT) AS resp_pkts,
  CAST(52 * (event_id % 4) AS BIGINT) AS resp_ip_bytes,
  CAST(NULL AS VARCHAR) AS tunnel_parents,
  CASE event_type WHEN 'error' THEN ' Malicious ' WHEN 'signup' THEN NULL
    WHEN 'click' THEN 'BENIGN ' ELSE 'Benign' END AS label,
  CASE WHEN event_type = 'error' THEN 'DDoS' END AS detailed_label
FROM events
"""


def packet_view(spark: SparkSession, sf_dir: str, filtered: bool = True) -> DataFrame:
    """V2: packets (PACKET schema) derived from ``events``; ``filtered=False`` keeps 'other'."""
    e = read_table(spark, sf_dir, "events")
    eid, u = F.col("event_id"), F.col("user_id")
    cip = F.concat(F.lit("10.0.0."), (u % 20).cast("string"))
    sip = F.concat(F.lit("10.0.1."), (u % 7).cast("string"))
    cp = F.lit(49152) + u % 40
    sp = F.when(u % 4 == 0, 80).when(u % 4 == 1, 53).when(u % 4 == 2, 443).otherwise(23)
    proto = F.when(u % 10 == 9, "other").when(u % 4 == 1, "udp").otherwise("tcp")
    server_sends = eid % 3 == 0
    payload = F.when(eid % 4 == 0, 0).otherwise((eid * 37) % 900)
    out = e.select(
        eid.alias("arrival_seq"),
        F.timestamp_micros(ntz_micros(F.col("ts"))).alias("ts"),
        F.when(server_sends, sip).otherwise(cip).alias("src_ip"),
        F.when(server_sends, cip).otherwise(sip).alias("dst_ip"),
        proto.alias("proto"),
        F.when(server_sends, sp).otherwise(cp).cast("int").alias("sport"),
        F.when(server_sends, cp).otherwise(sp).cast("int").alias("dport"),
        payload.cast("int").alias("payload_len"),
        (F.lit(60) + payload).cast("int").alias("pkt_len"),
    )
    return out.where(F.col("proto").isin("tcp", "udp", "icmp")) if filtered else out


V2_SQL_UNFILTERED = """
SELECT event_id AS arrival_seq, ts,
  CASE WHEN event_id % 3 = 0 THEN sip ELSE cip END AS src_ip,
  CASE WHEN event_id % 3 = 0 THEN cip ELSE sip END AS dst_ip,
  proto,
  CAST(CASE WHEN event_id % 3 = 0 THEN sp ELSE cp END AS INTEGER) AS sport,
  CAST(CASE WHEN event_id % 3 = 0 THEN cp ELSE sp END AS INTEGER) AS dport,
  CAST(CASE WHEN event_id % 4 = 0 THEN 0 ELSE (event_id * 37) % 900 END AS INTEGER) AS payload_len,
  CAST(60 + CASE WHEN event_id % 4 = 0 THEN 0 ELSE (event_id * 37) % 900 END AS INTEGER) AS pkt_len
FROM (SELECT *, '10.0.0.' || CAST(user_id % 20 AS VARCHAR) AS cip,
        '10.0.1.' || CAST(user_id % 7 AS VARCHAR) AS sip,
        49152 + user_id % 40 AS cp,
        CASE user_id % 4 WHEN 0 THEN 80 WHEN 1 THEN 53 WHEN 2 THEN 443 ELSE 23 END AS sp,
        CASE WHEN user_id % 10 = 9 THEN 'other' WHEN user_id % 4 = 1 THEN 'udp' ELSE 'tcp' END AS proto
      FROM events) e
"""
V2_SQL = "SELECT * FROM (" + V2_SQL_UNFILTERED + ") v WHERE proto IN ('tcp', 'udp', 'icmp')"


def score_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: scored rows (model, dataset, key, y, score) derived from ``events``; many ties."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("model"),
        F.when(F.col("event_id") % 2 == 0, "A").otherwise("B").alias("dataset"),
        F.col("event_id").alias("key"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("y"),
        (F.floor(F.col("value")).cast("double") / F.lit(500.0)).alias("score"),
    )


V3_SQL = """
SELECT 'm' || CAST(user_id % 3 AS VARCHAR) AS model,
  CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END AS dataset,
  event_id AS key,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y,
  floor(value) / CAST(500 AS DOUBLE) AS score
FROM events
"""


def turn_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: conversation turns as packets.

    Key = conversation; the side of a turn is whether its role equals the conversation's
    first role; payload = characters of the text; arrival order = turn.
    """
    c = read_table(spark, sf_dir, "conversations")
    # first role per conversation: a partial+final aggregate, then an equi-join (AQE splits
    # a hot conversation on the join side; no single-task window over a large group)
    firsts = c.groupBy("conv_id").agg(F.min_by("role", "turn").alias("first_role"))
    side_a = F.col("role") == F.col("first_role")
    a = F.concat(F.lit("conv-"), F.col("conv_id").cast("string"), F.lit("-a"))
    b = F.concat(F.lit("conv-"), F.col("conv_id").cast("string"), F.lit("-b"))
    n = F.length("text")
    return (c.join(firsts, "conv_id")
            .select(
                (F.col("conv_id") * 100000 + F.col("turn")).alias("arrival_seq"),
                F.col("turn").cast("double").alias("ts"),
                F.when(side_a, a).otherwise(b).alias("src_ip"),
                F.when(side_a, b).otherwise(a).alias("dst_ip"),
                F.lit("tcp").alias("proto"),
                F.lit(0).alias("sport"), F.lit(0).alias("dport"),
                n.cast("int").alias("payload_len"),
                (n + 40).cast("int").alias("pkt_len"),
            ))


V4_SQL = """
SELECT conv_id * 100000 + turn AS arrival_seq, CAST(turn AS DOUBLE) AS ts,
  CASE WHEN role = first_role THEN 'conv-' || CAST(conv_id AS VARCHAR) || '-a'
       ELSE 'conv-' || CAST(conv_id AS VARCHAR) || '-b' END AS src_ip,
  CASE WHEN role = first_role THEN 'conv-' || CAST(conv_id AS VARCHAR) || '-b'
       ELSE 'conv-' || CAST(conv_id AS VARCHAR) || '-a' END AS dst_ip,
  'tcp' AS proto, 0 AS sport, 0 AS dport,
  CAST(length(text) AS INTEGER) AS payload_len, CAST(length(text) + 40 AS INTEGER) AS pkt_len
FROM (SELECT *, first_value(role) OVER (PARTITION BY conv_id ORDER BY turn
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_role
      FROM conversations) c
"""
