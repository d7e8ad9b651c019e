"""User-level entry points: one function per task the reference's scripts perform, each a
composition of the DataFrame operators (no logic of its own).

| Task | Function |
| --- | --- |
| profile splits: counts, imbalance, file sizes | ``profile_splits`` |
| draw a calibration set (exact n per class, original order) and write it | ``draw_calibration_set`` |
| fit preprocessing + candidates, score sets A/B, pick and save the winner | ``train_and_select`` |
| scorecard of a saved model on two sets (+ live traffic) | ``evaluate_model`` |
| ablation study | ``ablation_study`` |
| live detection from a packet folder to alert files | ``live_detection`` |
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators import features as ft
from flowlens.operators import labels as lb
from flowlens.operators import models as md
from flowlens.operators import profile as pf
from flowlens.operators import sampling as sm
from flowlens.operators.metrics import scorecard
from flowlens.plans.materialize import materialize
from flowlens.sources import connlog, sinks
from flowlens.streaming import live


def _load(spark: SparkSession, path: str) -> DataFrame:
    return lb.clean_labels(connlog.read_conn_log(spark, path))


def profile_splits(spark: SparkSession, paths: dict) -> DataFrame:
    """A1 + A2 (+ S6): rows, benign, attack, ratio and band per named split file."""
    parts = [_load(spark, p).withColumn("split", F.lit(name)) for name, p in paths.items()]
    allrows = parts[0]
    for p in parts[1:]:
        allrows = allrows.unionByName(p)
    prof = pf.imbalance(pf.class_counts(allrows, "split"))
    files = sinks.manifest(spark, {n: p for n, p in paths.items()}, fmt="csv") \
        .groupBy(F.col("dataset").alias("split")).agg(F.sum("mb").alias("mb"))
    return prof.join(files, "split", "left")


def draw_calibration_set(spark: SparkSession, source: str, out: str, n_benign: int = 1500,
                         n_attack: int = 1000, seed: int = 42) -> DataFrame:
    """D1 + O1 + S5/P6: exact n per class, original order restored, written as TSV."""
    s = sm.stratified_sample(_load(spark, source), "is_benign",
                             {True: n_benign, False: n_attack}, seed=seed)
    s = sm.restore_order(s).drop("y")
    sinks.write_split(s, out, fmt="tsv")
    return s


def train_and_select(spark: SparkSession, train_path: str, set_a_path: str, set_b_path: str,
                     model_dir: str | None = None, order: tuple = ("ts", "uid"),
                     key: str = "uid", which: tuple = tuple(md.CANDIDATE_ORDER)
                     ) -> tuple[DataFrame, ft.FeatureModel, dict]:
    """Fit preprocessing on train, train the candidates, score the
    training set and sets A and B in one grouped scorecard, select on set B, optionally save
    the fitted preprocessing, every candidate and the winner's name (``load_winner``)."""
    train = _load(spark, train_path)
    fm = ft.fit_features(train)
    weight = pf.class_weight(train).first()["pos_weight"]
    trained = md.train_candidates(fm, train, weight, list(order), key, which=which)
    scored = md.candidate_scores(fm, trained, {"train": train, "A": _load(spark, set_a_path),
                                               "B": _load(spark, set_b_path)}, list(order), key)
    card = md.candidate_scorecards(scored, trained)
    winner = md.pick_winner(card, "B").first()["model"]
    if model_dir:
        fm.save(spark, f"{model_dir}/preprocessing")
        for name, tr in trained.items():
            md.save_model(tr.model, f"{model_dir}/models/{name}")
        spark.createDataFrame([(winner,)], "model string").coalesce(1).write.mode("overwrite") \
            .parquet(f"{model_dir}/winner")
    return card.withColumn("selected", F.col("model") == F.lit(winner)), fm, trained


def load_winner(spark: SparkSession, model_dir: str) -> md.Scorer:
    """K7 / S9 in a later session: preprocessing, name and model of the saved winner."""
    name = spark.read.parquet(f"{model_dir}/winner").first()["model"]
    return md.Scorer(ft.FeatureModel.load(spark, f"{model_dir}/preprocessing"), name, md.load_model(f"{model_dir}/models/{name}"))


def evaluate_model(spark: SparkSession, winner: md.Scorer, set_a: str, set_b: str,
                   live_flows: DataFrame | None = None, attackers: list[str] | None = None,
                   order: tuple = ("ts", "uid"), key: str = "uid",
                   t: dict | float | None = None) -> DataFrame:
    """K10 + K11 (+ A18): a final model of any family on sets A and B (and live traffic)."""
    if live_flows is not None:
        return md.three_way_scorecard(winner, _load(spark, set_a), _load(spark, set_b), live_flows, attackers or [],
                                      list(order), key, t=t)
    parts = [winner.scores(_load(spark, p), name, list(order), key, t, label="final") for name, p in (("A", set_a), ("B", set_b))]
    return scorecard(parts[0].unionByName(parts[1]), ["model", "dataset"])


def ablation_study(spark: SparkSession, train_path: str, test_path: str, order: tuple = ("ts", "uid"), key: str = "uid",
                   t: float | None = None, family: str = "mlp_seq") -> DataFrame:
    """K9 for a winner's family: baseline, no numeric, no categorical, capacity limit, shuffled split."""
    train, test = _load(spark, train_path), _load(spark, test_path)
    sh = sm.shuffled_split(train.unionByName(test))
    return md.ablation_report(ft.fit_features, train, test,
                              (sh.where(F.col("split") == "train").drop("split"),
                               sh.where(F.col("split") == "test").drop("split")),
                              list(order), key, t=t, family=family)


def live_detection(spark: SparkSession, packet_dir: str, out_dir: str, model: md.Scorer | Callable[[np.ndarray], np.ndarray],
                   t: float | None = None, values: list[str] | None = None, window: str = "1 second", watermark: str = "0 seconds",
                   whitelist: list[str] | None = None, once: bool = False, attackers=None):
    """S7 -> J1-J5, J7 -> S8: stream packet files to per-batch alert folders, scored by a saved
    winner of any family (default threshold: that of the candidate on live traffic) or by a
    function over windows of the ``values`` columns.  With ``attackers`` the alerts are evaluated as
    they come: ``streaming.live.running_scorecard(spark, out_dir)``."""
    trusted = whitelist if whitelist is not None else live.DEFAULT_WHITELIST
    packets = sinks.packet_stream(spark, packet_dir)
    if isinstance(model, md.Scorer):
        def alerts_of(flows: DataFrame, fix=materialize) -> DataFrame:
            own = md.threshold_of(model.name, "live", t)
            return live.fitted_live_alerts(flows, model.features, model.model, own, trusted, rows=not model.windows, fix=fix)

        return live.start_alert_stream(packets, out_dir, window=window, watermark=watermark, alerts_of=alerts_of, trigger_once=once,
                                       attackers=attackers)
    return live.start_alert_stream(packets, out_dir, model, 0.5 if t is None else t, values, window, watermark,
                                   whitelist=trusted, trigger_once=once, attackers=attackers)
