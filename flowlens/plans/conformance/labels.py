"""Conformance queries over V1 (connection log): scans, labels, profile, sampling, splits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flowlens.operators import labels as lb
from flowlens.operators import profile as pf
from flowlens.operators import sampling as sm
from flowlens.plans import views
from flowlens.plans.ordering import number_in_place
from flowlens.schema import FEATURES
from flowlens.session import checkpoint_dir
from flowlens.sources import connlog, sinks

STRAT_N = {True: 1500, False: 1000}      # the reference's 60:40 calibration draw
RATIO_TOTAL, RATIO_SHARES = 2500, {True: 0.9, False: 0.1}


def clean(spark, sf):
    return lb.clean_labels(views.conn_view(spark, sf))


def chrono(spark, sf):
    return sm.chronological_split(clean(spark, sf))


def q_conn_scan(spark, sf):
    """V1 written as tab-separated files under dotted names, one half with its columns in another
    order, and read back by their headers."""
    view, folder = views.conn_view(spark, sf), f"{checkpoint_dir(spark)}/conn-scan-{uuid.uuid4().hex}"
    for half in (0, 1):
        order = sorted(view.columns, reverse=bool(half))
        names = {c: f"id.{c}" if c in ("orig_h", "orig_p", "resp_h", "resp_p") else c.replace("detailed_", "detailed-") for c in order}
        part = view.where(F.crc32(F.col("uid").cast("binary")) % 2 == half)
        sinks.write_split(part.select(*[F.col(c).alias(names[c]) for c in order]), f"{folder}/{half}")
    return connlog.read_conn_log(spark, f"{folder}/*")


def q_scan_limit(spark, sf):
    return connlog.row_cap(views.conn_view(spark, sf), 100, ["ts", "uid"]).select("uid", "ts", "label")


def q_split_manifest(spark, sf):
    """Rows behind each input table of the log views, and whether every file has a size."""
    m = sinks.manifest(spark, {t: f"{sf}/{t}.parquet" for t in ("events", "conversations")})
    return m.groupBy("dataset").agg(F.sum("rows").alias("rows"), F.min(F.col("bytes") > 0).alias("sized"))


def q_label_not_null(spark, sf):
    return lb.drop_null_label(views.conn_view(spark, sf)).select("uid", "label")


def q_label_benign_flag(spark, sf):
    return clean(spark, sf).select("uid", "is_benign")


def q_label_binary(spark, sf):
    return clean(spark, sf).select("uid", "y")


def q_benign_subset(spark, sf):
    return lb.benign_subset(clean(spark, sf)).select("uid", "label")


def q_feature_projection(spark, sf):
    return lb.feature_projection(clean(spark, sf), keys=["uid"])


def q_class_counts(spark, sf):
    return pf.class_counts(chrono(spark, sf), "split")


def q_imbalance_severity(spark, sf):
    return pf.imbalance(pf.class_counts(chrono(spark, sf), "split"))


def q_class_weight(spark, sf):
    w = pf.class_weight(chrono(spark, sf), groups=["split"])
    return w.select("split", F.round("pos_weight", 6).alias("pos_weight"))


def q_stratified_sample(spark, sf):
    return sm.stratified_sample(clean(spark, sf), "is_benign", STRAT_N).select("uid", "is_benign")


def q_ratio_split(spark, sf):
    return sm.ratio_split(clean(spark, sf), "is_benign", RATIO_TOTAL, RATIO_SHARES) \
        .select("uid", "is_benign")


def q_shuffled_split(spark, sf):
    return sm.shuffled_split(clean(spark, sf)).select("uid", "split")


def q_chronological_split(spark, sf):
    return chrono(spark, sf).select("uid", "split")


def q_split_leakage_audit(spark, sf):
    a = sm.leakage_audit(chrono(spark, sf))
    return a.select("train_rows", "cal_rows", "test_rows", "train_max_ts", "test_min_ts",
                    "time_ordered", "key_overlap")


def q_restore_order(spark, sf):
    """O1: the sample's rows as they lie after the sort, numbered by their place."""
    s = sm.restore_order(sm.stratified_sample(clean(spark, sf), "is_benign", STRAT_N))
    return number_in_place(s, "pos").select("pos", "uid", "is_benign")


def q_union_all(spark, sf):
    c = clean(spark, sf)
    return sm.union_all(lb.benign_subset(c), lb.attack_subset(c)).select("uid", "is_benign")


QUERIES = {
    "conn_scan": q_conn_scan,
    "scan_limit": q_scan_limit,
    "split_manifest": q_split_manifest,
    "label_not_null": q_label_not_null,
    "label_benign_flag": q_label_benign_flag,
    "label_binary": q_label_binary,
    "benign_subset": q_benign_subset,
    "feature_projection": q_feature_projection,
    "class_counts": q_class_counts,
    "imbalance_severity": q_imbalance_severity,
    "class_weight": q_class_weight,
    "stratified_sample": q_stratified_sample,
    "ratio_split": q_ratio_split,
    "shuffled_split": q_shuffled_split,
    "chronological_split": q_chronological_split,
    "split_leakage_audit": q_split_leakage_audit,
    "restore_order": q_restore_order,
    "union_all": q_union_all,
}

# ---- oracle SQL ------------------------------------------------------------------------------

BENIGN_SQL = r"starts_with(lower(regexp_replace(label, '^\s+|\s+$', '', 'g')), 'benign')"
CLEAN_SQL = f"""SELECT *, {BENIGN_SQL} AS is_benign,
  CASE WHEN {BENIGN_SQL} THEN 0 ELSE 1 END AS y FROM ({views.V1_SQL}) v WHERE label IS NOT NULL"""
CHRONO_SQL = f"""SELECT *, CASE WHEN rn < floor(CAST(0.7 AS DOUBLE) * n) THEN 'train'
    WHEN rn < floor(CAST(0.8 AS DOUBLE) * n) THEN 'cal' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY ts, uid) - 1 AS rn, count(*) OVER () AS n
        FROM ({CLEAN_SQL}) c) r"""
COUNTS_SQL = f"""SELECT split, count(*) AS total, count(*) FILTER (WHERE is_benign) AS benign,
  count(*) FILTER (WHERE NOT is_benign) AS attack FROM ({CHRONO_SQL}) s GROUP BY split"""


def _strat_sql(n_true: int, n_false: int) -> str:
    return f"""SELECT uid, is_benign FROM (
  SELECT *, row_number() OVER (PARTITION BY is_benign ORDER BY md5('42:' || uid), uid) AS rn
  FROM ({CLEAN_SQL}) c) r
WHERE (is_benign AND rn <= {n_true}) OR (NOT is_benign AND rn <= {n_false})"""


ORACLE = {
    "conn_scan": views.V1_SQL,
    "scan_limit": f"SELECT uid, ts, label FROM ({views.V1_SQL}) v ORDER BY ts, uid LIMIT 100",
    "split_manifest": """SELECT 'events' AS dataset, count(*) AS rows, true AS sized FROM events UNION ALL
  SELECT 'conversations' AS dataset, count(*) AS rows, true AS sized FROM conversations""",
    "label_not_null": f"SELECT uid, label FROM ({views.V1_SQL}) v WHERE label IS NOT NULL",
    "label_benign_flag": f"SELECT uid, is_benign FROM ({CLEAN_SQL}) c",
    "label_binary": f"SELECT uid, y FROM ({CLEAN_SQL}) c",
    "benign_subset": f"SELECT uid, label FROM ({CLEAN_SQL}) c WHERE is_benign",
    "feature_projection": f"SELECT uid, {', '.join(FEATURES)}, y FROM ({CLEAN_SQL}) c",
    "class_counts": COUNTS_SQL,
    "imbalance_severity": f"""SELECT split, total, benign, attack,
  CASE WHEN benign + attack = 0 THEN 'N/A' WHEN least(benign, attack) = 0 THEN '1:inf'
       ELSE printf('1:%.2f', CAST(greatest(benign, attack) AS DOUBLE) / least(benign, attack)) END AS class_ratio,
  CASE WHEN benign + attack = 0 THEN 'N/A' WHEN least(benign, attack) = 0 THEN 'Extreme Imbalance'
       WHEN CAST(greatest(benign, attack) AS DOUBLE) / least(benign, attack) > 10 THEN 'Extreme Imbalance'
       WHEN CAST(greatest(benign, attack) AS DOUBLE) / least(benign, attack) > 4 THEN 'Severe Imbalance'
       WHEN CAST(greatest(benign, attack) AS DOUBLE) / least(benign, attack) > 1.5 THEN 'Moderate Imbalance'
       ELSE 'Low Imbalance' END AS severity FROM ({COUNTS_SQL}) c""",
    "class_weight": f"""SELECT split, round(CASE WHEN sum(y) > 0
  THEN CAST(count(*) - sum(y) AS DOUBLE) / CAST(sum(y) AS DOUBLE) ELSE 1.0 END, 6) AS pos_weight
  FROM ({CHRONO_SQL}) s GROUP BY split""",
    "stratified_sample": _strat_sql(STRAT_N[True], STRAT_N[False]),
    "ratio_split": _strat_sql(int(RATIO_TOTAL * RATIO_SHARES[True]),
                              int(RATIO_TOTAL * RATIO_SHARES[False])),
    "shuffled_split": f"""SELECT uid, CASE WHEN rn < floor(CAST(0.7 AS DOUBLE) * n) THEN 'train'
  ELSE 'test' END AS split FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || uid), uid) - 1 AS rn,
  count(*) OVER () AS n FROM ({CLEAN_SQL}) c) r""",
    "chronological_split": f"SELECT uid, split FROM ({CHRONO_SQL}) s",
    "split_leakage_audit": f"""WITH s AS ({CHRONO_SQL})
SELECT count(*) FILTER (WHERE split = 'train') AS train_rows,
  count(*) FILTER (WHERE split = 'cal') AS cal_rows,
  count(*) FILTER (WHERE split = 'test') AS test_rows,
  max(ts) FILTER (WHERE split = 'train') AS train_max_ts,
  min(ts) FILTER (WHERE split = 'test') AS test_min_ts,
  (max(ts) FILTER (WHERE split = 'train') <= min(ts) FILTER (WHERE split = 'cal')
   AND max(ts) FILTER (WHERE split = 'cal') <= min(ts) FILTER (WHERE split = 'test')) AS time_ordered,
  (SELECT count(*) FROM (SELECT uid FROM s GROUP BY uid HAVING count(DISTINCT split) > 1) d) AS key_overlap
FROM s""",
    "restore_order": f"""SELECT row_number() OVER (ORDER BY ts, uid) - 1 AS pos, uid, is_benign
  FROM ({_strat_sql(STRAT_N[True], STRAT_N[False]).replace('SELECT uid, is_benign FROM', 'SELECT uid, is_benign, ts FROM', 1)}) s""",
    "union_all": f"""SELECT uid, is_benign FROM ({CLEAN_SQL}) a WHERE is_benign
  UNION ALL SELECT uid, is_benign FROM ({CLEAN_SQL}) b WHERE NOT is_benign""",
}
