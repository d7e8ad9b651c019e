"""Conformance queries over V3 (scored rows): decisions and scorecards (P13, P17, P18, A5-A10,
A14-A16, A18, W7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.functions.columns import threshold
from flowlens.operators import metrics as mt
from flowlens.operators.decisions import score_pair
from flowlens.plans import views

G = ["model", "dataset"]
THRESHOLDS = (0.10, 0.90)
ORDER = ["m0", "m1", "m2"]


def _r(df, cols, n=6):
    return df.select(*[F.round(F.col(c), n).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def decided(spark, sf):
    s = views.score_view(spark, sf)
    parts = [s.withColumn("t", F.lit(t)).withColumn("pred", threshold("score", t))
             for t in THRESHOLDS]
    return parts[0].unionByName(parts[1])


def q_threshold_decision(spark, sf):
    s = views.score_view(spark, sf)
    return s.select("key", threshold("score", 0.10).alias("pred_10"),
                    threshold("score", 0.90).alias("pred_90"))


def q_score_pair(spark, sf):
    s = score_pair(views.score_view(spark, sf))
    return s.select("key", F.round(F.col("pair")[0], 6).alias("p0"),
                    F.round(F.col("pair")[1], 6).alias("p1"))


def q_confusion_matrix(spark, sf):
    return mt.confusion(decided(spark, sf), G + ["t"])


def q_scorecard_basic(spark, sf):
    c = mt.basic_rates(mt.confusion(decided(spark, sf), G + ["t"]))
    return _r(c.drop("tp", "fp", "tn", "fn"), ["accuracy", "precision", "recall", "f1"])


def q_scorecard_error_rates(spark, sf):
    c = mt.error_rates(mt.confusion(decided(spark, sf), G + ["t"]))
    return _r(c.select(*G, "t", "fpr", "fnr"), ["fpr", "fnr"])


def q_roc_auc(spark, sf):
    return _r(mt.roc_auc(views.score_view(spark, sf), G), ["roc_auc"])


def q_pr_auc(spark, sf):
    return _r(mt.pr_auc(views.score_view(spark, sf), G), ["pr_auc"])


def q_pr_curve_points(spark, sf):
    p = mt.curve_points(views.score_view(spark, sf), G)
    p = p.select(*G, "score", "tp", "fp",
                 (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                 mt.safe_div(F.col("tp"), F.col("P")).alias("recall"))
    return _r(p, ["precision", "recall", "score"])


def card(spark, sf, t):
    return mt.scorecard(views.score_view(spark, sf), G, threshold=t)


def q_scorecard_full(spark, sf):
    return _r(card(spark, sf, 0.90), mt.METRICS)


def q_model_select(spark, sf):
    best = mt.select_model(card(spark, sf, 0.10), by=["dataset"], order=ORDER)
    return _r(best.select("dataset", "model", "f1"), ["f1"])


def q_metric_delta(spark, sf):
    d = mt.metric_delta(card(spark, sf, 0.10), "model", "m0")
    return _r(d.select("dataset", "model", "f1", "fpr", "delta_f1", "delta_fpr"),
              ["f1", "fpr", "delta_f1", "delta_fpr"])


def q_scorecard_pivot(spark, sf):
    p = mt.scorecard_pivot(card(spark, sf, 0.10), ["A", "B"], ids=["model"])
    return _r(p, ["A", "B"])


QUERIES = {
    "threshold_decision": q_threshold_decision,
    "score_pair": q_score_pair,
    "confusion_matrix": q_confusion_matrix,
    "scorecard_basic": q_scorecard_basic,
    "scorecard_error_rates": q_scorecard_error_rates,
    "roc_auc": q_roc_auc,
    "pr_auc": q_pr_auc,
    "pr_curve_points": q_pr_curve_points,
    "scorecard_full": q_scorecard_full,
    "model_select": q_model_select,
    "metric_delta": q_metric_delta,
    "scorecard_pivot": q_scorecard_pivot,
}

# ---- oracle SQL ------------------------------------------------------------------------------

V3 = views.V3_SQL
DEC = f"""SELECT *, CAST(0.1 AS DOUBLE) AS t, CAST(score >= CAST(0.1 AS DOUBLE) AS INTEGER) AS pred FROM ({V3}) a
  UNION ALL SELECT *, CAST(0.9 AS DOUBLE) AS t, CAST(score >= CAST(0.9 AS DOUBLE) AS INTEGER) AS pred FROM ({V3}) b"""
CM = f"""SELECT model, dataset, t, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp,
  count(*) FILTER (WHERE y <> 1 AND pred = 1) AS fp, count(*) FILTER (WHERE y <> 1 AND pred <> 1) AS tn,
  count(*) FILTER (WHERE y = 1 AND pred <> 1) AS fn FROM ({DEC}) d GROUP BY model, dataset, t"""


def _div(a, b):
    return f"(CASE WHEN ({b}) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


RATES = f"""SELECT *, {_div('tp + tn', 'tp + fp + tn + fn')} AS accuracy, {_div('tp', 'tp + fp')} AS precision,
  {_div('tp', 'tp + fn')} AS recall, {_div('2 * tp', '2 * tp + fp + fn')} AS f1,
  {_div('fp', 'fp + tn')} AS fpr, {_div('fn', 'fn + tp')} AS fnr FROM ({CM}) c"""
POINTS = f"""WITH per AS (SELECT model, dataset, score, count(*) FILTER (WHERE y = 1) AS pos,
    count(*) FILTER (WHERE y <> 1) AS neg FROM ({V3}) s GROUP BY model, dataset, score),
c AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
    CAST(sum(pos) OVER g AS BIGINT) AS "P", CAST(sum(neg) OVER g AS BIGINT) AS "N" FROM per
  WINDOW w AS (PARTITION BY model, dataset ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         g AS (PARTITION BY model, dataset))
SELECT *, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
  {_div('tp', '"P"')} AS recall FROM c"""
AREAS = f"""WITH p AS ({POINTS}),
q AS (SELECT *, lag(precision, 1, CAST(1 AS DOUBLE)) OVER w AS prev_prec,
    lag(recall, 1, CAST(0 AS DOUBLE)) OVER w AS prev_rec, lag(tp, 1, 0) OVER w AS prev_tp,
    lag(fp, 1, 0) OVER w AS prev_fp FROM p WINDOW w AS (PARTITION BY model, dataset ORDER BY score DESC))
SELECT model, dataset,
  CASE WHEN max("P") = 0 OR max("N") = 0 THEN CAST(0.5 AS DOUBLE)
       ELSE CAST(sum((fp - prev_fp) * (tp + prev_tp)) AS DOUBLE) / (CAST(2 AS DOUBLE) * max("P") * max("N")) END AS roc_auc,
  CASE WHEN max("P") = 0 OR max("N") = 0 THEN CAST(0.5 AS DOUBLE)
       ELSE sum((recall - prev_rec) * (precision + prev_prec) / CAST(2 AS DOUBLE)) END AS pr_auc
FROM q GROUP BY model, dataset"""
FULL_09 = f"""SELECT r.*, a.roc_auc, a.pr_auc FROM ({RATES}) r JOIN ({AREAS}) a USING (model, dataset)
  WHERE r.t = CAST(0.9 AS DOUBLE)"""
FULL_01 = FULL_09.replace("r.t = CAST(0.9 AS DOUBLE)", "r.t = CAST(0.1 AS DOUBLE)")
_M = ", ".join(f"round({m}, 6) AS {m}" for m in mt.METRICS)

ORACLE = {
    "threshold_decision": f"""SELECT key, CAST(score >= CAST(0.1 AS DOUBLE) AS INTEGER) AS pred_10,
  CAST(score >= CAST(0.9 AS DOUBLE) AS INTEGER) AS pred_90 FROM ({V3}) s""",
    "score_pair": f"SELECT key, round(1 - score, 6) AS p0, round(score, 6) AS p1 FROM ({V3}) s",
    "confusion_matrix": CM,
    "scorecard_basic": f"""SELECT model, dataset, t, round(accuracy, 6) AS accuracy,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM ({RATES}) r""",
    "scorecard_error_rates": f"SELECT model, dataset, t, round(fpr, 6) AS fpr, round(fnr, 6) AS fnr FROM ({RATES}) r",
    "roc_auc": f"SELECT model, dataset, round(roc_auc, 6) AS roc_auc FROM ({AREAS}) a",
    "pr_auc": f"SELECT model, dataset, round(pr_auc, 6) AS pr_auc FROM ({AREAS}) a",
    "pr_curve_points": f"""SELECT model, dataset, round(score, 6) AS score, tp, fp, round(precision, 6) AS precision,
  round(recall, 6) AS recall FROM ({POINTS}) p""",
    "scorecard_full": f"SELECT model, dataset, tp, fp, tn, fn, {_M} FROM ({FULL_09}) f",
    "model_select": f"""SELECT dataset, model, round(f1, 6) AS f1 FROM (SELECT *, row_number() OVER
  (PARTITION BY dataset ORDER BY f1 DESC, model) AS rn FROM ({FULL_01}) f) x WHERE rn = 1""",
    "metric_delta": f"""WITH c AS (SELECT * FROM ({FULL_01}) f),
b AS (SELECT dataset, f1 AS bf1, fpr AS bfpr FROM c WHERE model = 'm0')
SELECT dataset, model, round(f1, 6) AS f1, round(fpr, 6) AS fpr,
  CASE WHEN model = 'm0' THEN NULL ELSE round(f1 - bf1, 6) END AS delta_f1,
  CASE WHEN model = 'm0' THEN NULL ELSE round(fpr - bfpr, 6) END AS delta_fpr FROM c LEFT JOIN b USING (dataset)""",
    "scorecard_pivot": f"""WITH f AS ({FULL_01}),
l AS (UNPIVOT (SELECT model, dataset, {', '.join(mt.METRICS)} FROM f) ON {', '.join(mt.METRICS)}
      INTO NAME metric VALUE value)
SELECT model, metric, round(max(value) FILTER (WHERE dataset = 'A'), 6) AS "A",
  round(max(value) FILTER (WHERE dataset = 'B'), 6) AS "B" FROM l GROUP BY model, metric""",
}

