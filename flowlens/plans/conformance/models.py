"""Model queries over V1 (K1-K12).  Trained models cannot be written in SQL, so those that return
scores are rows-only checks (no oracle entry); determinism is covered by seeded-rerun tests.
``candidate_support``, ``ablation_support`` and ``score_keys`` return what does not depend on the
trained numbers (which rows were scored, how many of either class) and have SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.operators import features as ft
from flowlens.operators import metrics as mt
from flowlens.operators import models as md
from flowlens.operators import profile as pf
from flowlens.operators import sampling as sm
from flowlens.plans.conformance.labels import CHRONO_SQL, CLEAN_SQL, chrono, clean
from flowlens.plans.materialize import materialize, spread
from flowlens.schema import FEATURES

ORDER = ["ts", "uid"]
KEY = "uid"


#: What the models read of a connection.
COLUMNS = list(dict.fromkeys([*ORDER, KEY, *FEATURES, "y", "is_benign", "split"]))


def _splits(spark, sf):
    c = materialize(spread(chrono(spark, sf).select(*COLUMNS)))
    return {s: c.where(F.col("split") == s) for s in ("train", "cal", "test")}


def _candidates(spark, sf, which):
    sp = _splits(spark, sf)
    fm = ft.fit_features(sp["train"])
    w = pf.class_weight(sp["train"]).first()["pos_weight"]
    trained = md.train_candidates(fm, sp["train"], w, ORDER, KEY, which=which)
    scored = md.candidate_scores(fm, trained, {"A": sp["test"], "B": sp["cal"]}, ORDER, KEY)
    return scored, trained


def _card(spark, sf, which):
    scored, trained = _candidates(spark, sf, which)
    card = md.candidate_scorecards(scored, trained)
    return card.select("model", "dataset", "tp", "fp", "tn", "fn",
                       *[F.round(m, 6).alias(m) for m in mt.METRICS])


def q_candidate_gbt(spark, sf):
    return _card(spark, sf, ("gbt",))


def q_candidate_rf(spark, sf):
    return _card(spark, sf, ("rf",))


def q_candidate_mlp_seq(spark, sf):
    return _card(spark, sf, ("mlp_seq",))


def q_batch_scores(spark, sf):
    scored, _ = _candidates(spark, sf, ("gbt",))
    return scored.select("model", "dataset", "key", "y", F.round("score", 6).alias("score"), "pred")


def q_candidate_scorecards(spark, sf):
    card = _card(spark, sf, tuple(md.CANDIDATE_ORDER))
    winner = md.pick_winner(card, "B").select(F.col("model").alias("_w"))
    return (card.join(F.broadcast(winner), F.col("model") == F.col("_w"), "left")
            .withColumn("selected", F.col("_w").isNotNull()).drop("_w"))


def q_candidate_support(spark, sf):
    """K1-K4, K6: rows of either class that each candidate scored, by dataset."""
    scored, _ = _candidates(spark, sf, tuple(md.CANDIDATE_ORDER))
    card = md.candidate_scorecards(scored)
    return card.select("model", "dataset", (F.col("tp") + F.col("fn")).alias("attacks"), (F.col("fp") + F.col("tn")).alias("benign"))


def q_score_keys(spark, sf):
    """The scored rows' keys and labels, of a row model and of a window model."""
    scored, _ = _candidates(spark, sf, ("rf", "mlp_seq"))
    return scored.select("model", "dataset", "key", "y", F.col("score").between(0, 1).alias("in_range"))


def _ablation(spark, sf, family):
    sp = _splits(spark, sf)
    sh = materialize(spread(sm.shuffled_split(clean(spark, sf)).select(*COLUMNS)))
    return md.ablation_report(ft.fit_features, sp["train"], sp["test"],
                              (sh.where(F.col("split") == "train"), sh.where(F.col("split") == "test")),
                              ORDER, KEY, family=family)


def q_ablation_report(spark, sf):
    return _ablation(spark, sf, "mlp_seq").select("experiment", *[F.round(c, 6).alias(c) for c in ("f1", "fpr", "delta_f1", "delta_fpr")])


def q_ablation_report_tree(spark, sf):
    return _ablation(spark, sf, "rf").select("experiment", *[F.round(c, 6).alias(c) for c in ("f1", "fpr", "delta_f1", "delta_fpr")])


def q_ablation_support(spark, sf):
    """Rows of either class in each experiment, for a tree and a sequence winner."""
    parts = [_ablation(spark, sf, family).select(F.lit(family).alias("family"), "experiment", (F.col("tp") + F.col("fn")).alias("attacks"),
                                                 (F.col("fp") + F.col("tn")).alias("benign")) for family in ("rf", "mlp_seq")]
    return parts[0].unionByName(parts[1])


def q_three_way_scorecard(spark, sf):
    from flowlens.plans import views
    from flowlens.plans.conformance.live import ATTACKERS
    from flowlens.streaming import live
    sp = _splits(spark, sf)
    fm = ft.fit_features(sp["train"])
    final = md.Scorer(fm, "mlp_seq", md.train_candidates(fm, sp["train"], 1.0, ORDER, KEY, which=("mlp_seq",))["mlp_seq"].model)
    flows = live.live_flows(views.packet_view(spark, sf), "1 day")
    p = md.three_way_scorecard(final, sp["test"], sp["cal"], flows, ATTACKERS, ORDER, KEY)
    return p.select("model", "metric", *[F.round(c, 6).alias(c) for c in ("A", "B", "live")])


QUERIES = {
    "three_way_scorecard": q_three_way_scorecard,
    "candidate_gbt": q_candidate_gbt,
    "candidate_rf": q_candidate_rf,
    "candidate_mlp_seq": q_candidate_mlp_seq,
    "batch_scores": q_batch_scores,
    "candidate_scorecards": q_candidate_scorecards,
    "ablation_report": q_ablation_report,
    "ablation_report_tree": q_ablation_report_tree,
    "candidate_support": q_candidate_support,
    "score_keys": q_score_keys,
    "ablation_support": q_ablation_support,
}

# ---- oracle SQL ------------------------------------------------------------------------------


def _scored_sql(*models: tuple[str, int]) -> str:
    """(model, dataset, uid, y) of the rows that ``models`` score, each given with the place of its first
    row: a row model scores all, a window model not the first four."""
    return f"""SELECT m.model, s.dataset, s.uid, s.y FROM (SELECT *, CASE split WHEN 'test' THEN 'A' ELSE 'B' END AS dataset,
    row_number() OVER (PARTITION BY split ORDER BY ts, uid) AS place FROM ({CHRONO_SQL}) c WHERE split IN ('test', 'cal')) s
  JOIN (VALUES {", ".join(f"('{name}', {first})" for name, first in models)}) m(model, first) ON s.place >= m.first"""


#: (experiment, family, y) of the rows behind each experiment
_TESTED = f"""SELECT e.experiment, f.family, s.y FROM (SELECT 'time' AS split_by, y, row_number() OVER (ORDER BY ts, uid) AS place
    FROM ({CHRONO_SQL}) c WHERE split = 'test'
  UNION ALL SELECT 'shuffled', y, row_number() OVER (ORDER BY h, uid) FROM (SELECT *, md5('42:' || uid) AS h,
    row_number() OVER (ORDER BY md5('42:' || uid), uid) - 1 AS rn, count(*) OVER () AS n FROM ({CLEAN_SQL}) c) r
    WHERE rn >= floor(CAST(0.7 AS DOUBLE) * n)) s
  JOIN (VALUES ('baseline', 'time'), ('no_numeric', 'time'), ('no_categorical', 'time'), ('capacity', 'time'),
    ('shuffled', 'shuffled')) e(experiment, split_by) USING (split_by)
  JOIN (VALUES ('rf', 1), ('mlp_seq', {md.SEQ_LEN})) f(family, first) ON s.place >= f.first"""

ORACLE = {
    "candidate_support": f"""SELECT model, dataset, count(*) FILTER (WHERE y = 1) AS attacks, count(*) FILTER (WHERE y = 0) AS benign
  FROM ({_scored_sql(("gbt", 1), ("rf", 1), ("mlp_seq", md.SEQ_LEN))}) s GROUP BY model, dataset""",
    "score_keys": f"SELECT model, dataset, uid AS key, y, true AS in_range FROM ({_scored_sql(('rf', 1), ('mlp_seq', md.SEQ_LEN))}) s",
    "ablation_support": f"""SELECT family, experiment, count(*) FILTER (WHERE y = 1) AS attacks, count(*) FILTER (WHERE y = 0) AS benign
  FROM ({_TESTED}) t GROUP BY family, experiment""",
}
