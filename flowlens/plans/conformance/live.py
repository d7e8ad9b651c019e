"""Conformance queries of the live path over V2 with 1-day windows (J1-J6, A16, A17, W4,
P14-P16); the batch twin of the streaming plan."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import functions as F

from flowlens.operators import labels as lb
from flowlens.operators import metrics as mt
from flowlens.operators.features import FeatureModel
from flowlens.operators import sequences as sq
from flowlens.plans import views
from flowlens.plans.conformance.flows import FLOWS_V2_DAY
from flowlens.session import checkpoint_dir
from flowlens.streaming import live

WINDOW = "1 day"
VALUES = ["orig_pkts", "resp_pkts"]
WEIGHTS, BIAS, T = [0.37, -0.29], -0.41, 0.55
WHITELIST = ["10.0.0.3"]
ATTACKERS = ["10.0.0.7", "10.0.0.13"]
FID = ["src_ip", "sport", "dst_ip", "dport"]


def flows(spark, sf):
    return live.live_flows(views.packet_view(spark, sf), WINDOW)


def alerts(spark, sf):
    return live.live_alerts(flows(spark, sf), sq.logistic_model(WEIGHTS, BIAS), T, VALUES,
                            whitelist=WHITELIST)


def _ws(c="window_start"):
    return F.unix_seconds(c).alias("window_start")


def q_window_throughput(spark, sf):
    p = views.packet_view(spark, sf)
    w = live.window_throughput(p, WINDOW)
    return w.select(_ws(), "packets", "flows", F.round("pkts_per_s", 6).alias("pkts_per_s"))


def q_batch_means(spark, sf):
    p = views.packet_view(spark, sf)
    w = live.window_throughput(p, WINDOW)
    m = mt.batch_means(w, ["packets", "flows", "pkts_per_s"])
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


def q_live_sequences(spark, sf):
    s = live.live_sequences(flows(spark, sf), VALUES, pad=True)
    mem = F.array_join(F.transform("members", lambda m: m["first_seq"].cast("string")), ",")
    return s.select(_ws(), *FID, "seq_pos", "n_real", mem.alias("members"))


def q_warmup_fill(spark, sf):
    f = flows(spark, sf)
    seqs = live.live_sequences(f, VALUES, pad=True)
    keep = live.ALERT_KEEP + ["seq_pos"]
    scored = sq.score_windows(seqs.select(*keep, "seq"), sq.logistic_model(WEIGHTS, BIAS), keep=keep)   # K5 over windows as rows
    raw = scored.withColumn("pred", (F.col("score") >= F.lit(T)).cast("int"))
    filled = sq.warmup_fill(raw.withColumn("position", F.col("seq_pos") + 1), "position")
    return filled.select(_ws(), *FID, "seq_pos", "pred")


def q_live_alerts(spark, sf):
    a = alerts(spark, sf)
    return a.select(_ws(), *FID, "seq_pos", "pred", F.round("score", 6).alias("score"), "status",
                    "endpoints", "proto_upper", "conn_state")


def q_whitelist_override(spark, sf):
    return alerts(spark, sf).select(_ws(), *FID, "pred")


def q_alert_record(spark, sf):
    return alerts(spark, sf).select(_ws(), "status", "endpoints", "proto_upper", "conn_state")


def q_label_by_source(spark, sf):
    f = lb.label_by_source(flows(spark, sf), ATTACKERS)
    return f.select(_ws(), *FID, "y")


def q_live_scorecard(spark, sf):
    c = live.live_scorecard(alerts(spark, sf), ATTACKERS)
    return c.select("dataset", "tp", "fp", "tn", "fn", *[F.round(m, 6).alias(m) for m in mt.METRICS])


def row_features(spark):
    """Fixed preprocessing of ``live_row_alerts``."""
    return FeatureModel.of(spark, medians={"orig_pkts": 3.0, "resp_pkts": 2.0}, means={"orig_pkts": 2.0, "resp_pkts": 1.5},
                           stds={"orig_pkts": 4.0, "resp_pkts": 2.5}, values={"conn_state": ["OTH", "S0", "SF"]})


ROW_FORMULA = "1 / (1 + exp(-({0} * f_orig_pkts - {1} * f_resp_pkts + {2} * oh_1 - {3} * oh_2)))"
ROW_WEIGHTS, ROW_T = [0.8, 0.5, 0.7, 0.4], 0.5


def row_model():
    """A fixed formula as a Spark ML pipeline with a probability vector, like a fitted row model."""
    p1 = ROW_FORMULA.format(*[f"CAST({w} AS DOUBLE)" for w in ROW_WEIGHTS])
    for slot in (1, 2):
        p1 = p1.replace(f"oh_{slot}", f"CAST(s_conn_state = {slot} AS DOUBLE)")
    pair = SQLTransformer(statement=f"SELECT *, 1 - {p1} AS p0, {p1} AS p1 FROM __THIS__")
    return PipelineModel(stages=[pair, VectorAssembler(inputCols=["p0", "p1"], outputCol="probability")])


def q_live_row_alerts(spark, sf):
    """J4 by a row model behind preprocessing that was saved and loaded."""
    path = f"{checkpoint_dir(spark)}/row-features-{uuid.uuid4().hex}"
    row_features(spark).save(spark, path)
    fm = FeatureModel.load(spark, path)
    a = live.fitted_live_alerts(flows(spark, sf), fm, row_model(), ROW_T, whitelist=WHITELIST, rows=True)
    return a.select(_ws(), *FID, "pred", F.round("score", 6).alias("score"), "status", "endpoints", "conn_state")


QUERIES = {
    "window_throughput": q_window_throughput,
    "batch_means": q_batch_means,
    "live_sequences": q_live_sequences,
    "warmup_fill": q_warmup_fill,
    "live_alerts": q_live_alerts,
    "live_row_alerts": q_live_row_alerts,
    "whitelist_override": q_whitelist_override,
    "alert_record": q_alert_record,
    "label_by_source": q_label_by_source,
    "live_scorecard": q_live_scorecard,
}

# ---- oracle SQL ------------------------------------------------------------------------------

_IN_WL = ", ".join(f"'{x}'" for x in WHITELIST)
_IN_AT = ", ".join(f"'{x}'" for x in ATTACKERS)
SEQ = f"""SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY first_seq) - 1 AS seq_pos,
  count(*) OVER fr AS n_real, array_to_string(list(first_seq) OVER fr, ',') AS members,
  CAST(sum(orig_pkts) OVER fr AS DOUBLE) AS s_op, CAST(sum(resp_pkts) OVER fr AS DOUBLE) AS s_rp
FROM ({FLOWS_V2_DAY}) f
WINDOW fr AS (PARTITION BY window_start ORDER BY first_seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""
SCORED = f"""SELECT *, 1 / (1 + exp(-(CAST({WEIGHTS[0]} AS DOUBLE) * (s_op / 5) + CAST({WEIGHTS[1]} AS DOUBLE) * (s_rp / 5)
  + CAST({BIAS} AS DOUBLE)))) AS score FROM ({SEQ}) s"""
DECIDED = f"""SELECT *, CASE WHEN seq_pos < 4 THEN 0 ELSE CAST(score >= CAST({T} AS DOUBLE) AS INTEGER) END AS pred_w
FROM ({SCORED}) s"""
ALERTS = f"""SELECT *, CASE WHEN src_ip IN ({_IN_WL}) THEN 0 ELSE pred_w END AS pred FROM ({DECIDED}) d"""
RECORD = f"""SELECT *, CASE WHEN pred = 1 THEN '[ALERT] Malicious Botnet Traffic Detected!'
  ELSE '[SAFE] Clean Traffic Detected!' END AS status,
  src_ip || ':' || CAST(sport AS VARCHAR) || ' -> ' || dst_ip || ':' || CAST(dport AS VARCHAR) AS endpoints,
  upper(proto) AS proto_upper FROM ({ALERTS}) a"""
THROUGHPUT = f"""WITH p AS (SELECT CAST((epoch_us(ts) // 86400000000) * 86400 AS BIGINT) AS window_start, count(*) AS packets
    FROM ({views.V2_SQL}) v GROUP BY 1),
f AS (SELECT window_start, count(*) AS flows FROM ({FLOWS_V2_DAY}) x GROUP BY 1)
SELECT p.window_start, packets, coalesce(flows, 0) AS flows, CAST(packets AS DOUBLE) / 86400 AS pkts_per_s
FROM p LEFT JOIN f USING (window_start)"""


def _div(a, b):
    return f"(CASE WHEN ({b}) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


_LBL = f"""SELECT *, CASE WHEN src_ip IN ({_IN_AT}) THEN 1 ELSE 0 END AS y FROM ({ALERTS}) a"""
_CM = f"""SELECT 'live' AS dataset, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp,
  count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn,
  count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn FROM ({_LBL}) l"""
_PTS = f"""WITH per AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
    FROM ({_LBL}) l GROUP BY score),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS "P", sum(neg) OVER () AS "N"
  FROM per WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
q AS (SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS prec, CAST(tp AS DOUBLE) / "P" AS rec FROM c),
r AS (SELECT *, lag(prec, 1, CAST(1 AS DOUBLE)) OVER o AS pp, lag(rec, 1, CAST(0 AS DOUBLE)) OVER o AS pr,
  lag(tp, 1, 0) OVER o AS ptp, lag(fp, 1, 0) OVER o AS pfp FROM q WINDOW o AS (ORDER BY score DESC))
SELECT CASE WHEN max("P") = 0 OR max("N") = 0 THEN 0.5
  ELSE CAST(sum((fp - pfp) * (tp + ptp)) AS DOUBLE) / (2.0 * max("P") * max("N")) END AS roc_auc,
  CASE WHEN max("P") = 0 OR max("N") = 0 THEN 0.5 ELSE sum((rec - pr) * (prec + pp) / 2) END AS pr_auc FROM r"""

ORACLE = {
    "window_throughput": f"SELECT window_start, packets, flows, round(pkts_per_s, 6) AS pkts_per_s FROM ({THROUGHPUT}) t",
    "batch_means": f"""SELECT round(coalesce(avg(packets), 0), 6) AS mean_packets, round(coalesce(avg(flows), 0), 6) AS mean_flows,
  round(coalesce(avg(pkts_per_s), 0), 6) AS mean_pkts_per_s FROM ({THROUGHPUT}) t""",
    "live_sequences": f"SELECT window_start, src_ip, sport, dst_ip, dport, seq_pos, n_real, members FROM ({SEQ}) s",
    "warmup_fill": f"SELECT window_start, src_ip, sport, dst_ip, dport, seq_pos, pred_w AS pred FROM ({DECIDED}) d",
    "live_alerts": f"""SELECT window_start, src_ip, sport, dst_ip, dport, seq_pos, pred, round(score, 6) AS score, status,
  endpoints, proto_upper, conn_state FROM ({RECORD}) r""",
    "live_row_alerts": f"""WITH f AS (SELECT *, (orig_pkts - CAST(2.0 AS DOUBLE)) / 4.0 AS f_orig_pkts,
    (resp_pkts - CAST(1.5 AS DOUBLE)) / 2.5 AS f_resp_pkts, CAST(conn_state = 'S0' AS DOUBLE) AS oh_1,
    CAST(conn_state = 'SF' AS DOUBLE) AS oh_2 FROM ({FLOWS_V2_DAY}) x),
s AS (SELECT *, {ROW_FORMULA.format(*[f"CAST({w} AS DOUBLE)" for w in ROW_WEIGHTS])} AS score FROM f),
d AS (SELECT *, CASE WHEN src_ip IN ({_IN_WL}) THEN 0 ELSE CAST(score >= {ROW_T} AS INTEGER) END AS pred FROM s)
SELECT window_start, src_ip, sport, dst_ip, dport, pred, round(score, 6) AS score,
  CASE WHEN pred = 1 THEN '[ALERT] Malicious Botnet Traffic Detected!' ELSE '[SAFE] Clean Traffic Detected!' END AS status,
  src_ip || ':' || CAST(sport AS VARCHAR) || ' -> ' || dst_ip || ':' || CAST(dport AS VARCHAR) AS endpoints, conn_state FROM d""",
    "whitelist_override": f"SELECT window_start, src_ip, sport, dst_ip, dport, pred FROM ({ALERTS}) a",
    "alert_record": f"SELECT window_start, status, endpoints, proto_upper, conn_state FROM ({RECORD}) r",
    "label_by_source": f"""SELECT window_start, src_ip, sport, dst_ip, dport,
  CASE WHEN src_ip IN ({_IN_AT}) THEN 1 ELSE 0 END AS y FROM ({FLOWS_V2_DAY}) f""",
    "live_scorecard": f"""WITH cm AS ({_CM}), ar AS ({_PTS})
SELECT dataset, tp, fp, tn, fn, round({_div('tp + tn', 'tp + fp + tn + fn')}, 6) AS accuracy,
  round({_div('tp', 'tp + fp')}, 6) AS precision, round({_div('tp', 'tp + fn')}, 6) AS recall,
  round({_div('2 * tp', '2 * tp + fp + fn')}, 6) AS f1, round(CAST(roc_auc AS DOUBLE), 6) AS roc_auc,
  round(CAST(pr_auc AS DOUBLE), 6) AS pr_auc, round({_div('fp', 'fp + tn')}, 6) AS fpr,
  round({_div('fn', 'fn + tp')}, 6) AS fnr FROM cm, ar""",
}
