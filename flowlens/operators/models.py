"""Learning and scoring as Spark ML jobs.

The reference trains gradient-boosted trees and a sequence network in one process.  Here the
candidates are Spark ML estimators trained on executors:
  * ``gbt``     - ``GBTClassifier`` (100 rounds, step 0.05, depth 6, positive weight = A3);
  * ``rf``      - ``RandomForestClassifier`` (100 trees, depth 6, same weight): a second,
                  distinct tree family;
  * ``mlp_seq`` - ``MultilayerPerceptronClassifier`` over flattened 5-row windows
                  ([5*d, 32, 2]; unweighted, like the reference's sequence model), fitted in
                  blocks (``operators.network``).
Scoring is ``PipelineModel.transform`` + the positive-class probability; every candidate's
scores on every dataset are unioned and summarised by ONE grouped scorecard job.

A ``Scorer`` (preprocessing, candidate name, model) is what selection, evaluation, ablation and the
live path work with: it knows whether its model takes prepared rows or windows of them.
"""

from __future__ import annotations

import functools
import time
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.decisions import decide, positive_score, whitelist_override
from flowlens.operators.features import FeatureModel
from flowlens.operators.labels import label_by_source
from flowlens.operators.metrics import metric_delta, scorecard, scorecard_pivot, select_model
from flowlens.operators.network import DENSE_WIDTH, SequencePerceptron
from flowlens.operators.profile import class_weight, with_class_weight
from flowlens.operators.sequences import flat_windows, sequence_windows
from flowlens.plans.materialize import even_parts, materialize
from flowlens.plans.ordering import hash_order
from flowlens.schema import DEFAULT_WHITELIST, SEQ_LEN

CANDIDATE_ORDER = ["gbt", "rf", "mlp_seq"]
#: Candidates that score single rows; all others score windows.
ROW_MODELS = ("gbt", "rf")
#: Decision thresholds: the sequence model has its own, trees the library's default; live
#: traffic has a lower one.
SEQUENCE_T, TREE_T, LIVE_T = 0.90, 0.50, 0.05
#: Windows that the network's fit puts into one matrix product: speed, and the order of its sums.
BLOCK = 1000


def threshold_of(name: str, dataset: str, thresholds: dict | float | None = None) -> float:
    """The threshold of a (model, dataset) pair.  ``thresholds`` is one number for
    all, or a dictionary by (model, dataset), model or dataset, looked up in that order."""
    if isinstance(thresholds, (int, float)):
        return float(thresholds)
    for k in ((name, dataset), name, dataset):
        if thresholds and k in thresholds:
            return float(thresholds[k])
    return TREE_T if name in ROW_MODELS else LIVE_T if dataset == "live" else SEQUENCE_T


def gbt(weight_col: str | None = "w", max_iter: int = 100, depth: int = 6, seed: int = 42):
    """K1 (K8 with ``max_iter=1, depth=1``)."""
    kw = dict(featuresCol="features", labelCol="label", maxIter=max_iter, stepSize=0.05,
              maxDepth=depth, seed=seed)
    if weight_col:
        kw["weightCol"] = weight_col
    return GBTClassifier(**kw)


def rf(weight_col: str | None = "w", trees: int = 100, depth: int = 6, seed: int = 42):
    """K2."""
    kw = dict(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    if weight_col:
        kw["weightCol"] = weight_col
    return RandomForestClassifier(**kw)


def mlp(width: int, hidden: int = 32, seed: int = 42, max_iter: int = 100):
    """K3 (K8 with ``hidden=1``)."""
    out = SequencePerceptron(featuresCol="features", labelCol="label", layers=[width, hidden, 2], seed=seed, maxIter=max_iter, blockSize=BLOCK)
    out.length = SEQ_LEN if width % SEQ_LEN == 0 else 1
    return out


def prepare_rows(fm: FeatureModel, df: DataFrame, y: str = "y", **zero) -> DataFrame:
    """Assembled feature vector + double label."""
    return fm.transform(df, **zero).withColumn("label", F.col(y).cast("double"))


def prepare_sequences(fm: FeatureModel, df: DataFrame, order: list[str], keep: list[str],
                      partition_by: list[str] | None = None, y: str = "y",
                      length: int = SEQ_LEN, **zero) -> DataFrame:
    """W1 + W3 over prepared rows: one flattened window vector per full window, label of the
    last row.  Up to ``DENSE_WIDTH`` entries the vectors are dense and made where the windows are, as
    the network takes them; wider ones are sparse."""
    rows, keep = fm.prepare(df, **zero), list(dict.fromkeys(keep + [y]))
    if length * fm.width <= DENSE_WIDTH:
        w = flat_windows(rows, order, fm.row_values, fm.row_encoder(), length, partition_by, keep)
        w = w.withColumns({"n_real": F.lit(length).cast("bigint"), "features": array_to_vector("window")}).drop("window")
    else:
        w = sequence_windows(rows, order, fm.row_values, length=length, pad=False, partition_by=partition_by, keep=keep)
        w = fm.window_vectors(w, length).drop("seq", "members")
    return w.withColumn("label", F.col(y).cast("double"))


def score(model: PipelineModel, df: DataFrame, name: str, dataset: str, key: str,
          y: str = "y", t: float = 0.5, keep: tuple = ()) -> DataFrame:
    """K4 (+ P18, P13): SCORED rows (model, dataset, key, y, score, pred); keys as text, so
    that datasets with keys of different types can be put together."""
    out = positive_score(model.transform(df), out="_score")
    return decide(out.select(F.lit(name).alias("model"), F.lit(dataset).alias("dataset"),
                             F.col(key).cast("string").alias("key"), F.col(y).cast("int").alias("y"),
                             F.col("_score").alias("score"), *keep), t)


class Scorer(NamedTuple):
    """A fitted model with its preprocessing, for rows or windows, in batch or live."""
    features: FeatureModel
    name: str
    model: PipelineModel

    @property
    def windows(self) -> bool:
        return self.name not in ROW_MODELS

    def inputs(self, df: DataFrame, order: list[str], keep: list[str], partition_by: list[str] | None = None, **zero) -> DataFrame:
        return model_inputs(self.name, self.features, df, order, keep, partition_by, **zero)

    def scores(self, df: DataFrame, dataset: str, order: list[str], key: str, t: dict | float | None = None, keep: tuple = (),
               partition_by: list[str] | None = None, label: str | None = None) -> DataFrame:
        """K4 / K5: SCORED rows under ``label`` (default: the candidate's name), each decided by the
        threshold of the candidate and dataset."""
        rows = self.inputs(df, order, [key, *keep], partition_by)
        return score(self.model, rows, label or self.name, dataset, key, t=threshold_of(self.name, dataset, t), keep=keep)


def model_inputs(name: str, fm: FeatureModel, df: DataFrame, order: list[str], keep: list[str],
                 partition_by: list[str] | None = None, **zero) -> DataFrame:
    """What candidate ``name`` takes: prepared rows, or full windows of them."""
    return prepare_rows(fm, df, **zero) if name in ROW_MODELS else prepare_sequences(fm, df, order, keep, partition_by, **zero)


def estimator(name: str, fm: FeatureModel, small: bool = False):
    """K1-K3 by name; ``small`` is K8: one tree of depth 1, or one hidden unit."""
    if name == "gbt":
        return gbt(max_iter=1, depth=1) if small else gbt()
    if name == "rf":
        return rf(trees=1, depth=1) if small else rf()
    return mlp(SEQ_LEN * fm.width, hidden=1 if small else 32)


@dataclass
class Trained:
    name: str
    model: PipelineModel
    seconds: float          # K12: wall time of the fit (driver-side timing of the Spark jobs)


def fit_timed(name: str, estimator, df: DataFrame) -> Trained:
    t0 = time.time()
    m = Pipeline(stages=[estimator]).fit(df)
    return Trained(name, m, time.time() - t0)


def training_inputs(name: str, fm: FeatureModel, train: DataFrame, pos_weight: float, order: list[str], key: str) -> DataFrame:
    """Inputs of a candidate's fit: vectors, labels and A3 weights (trees only).  Fits read them many
    times, in stages too short for many small tasks: partitions are put together.  They are written
    once, except for windows that the network packs, whose rows are written already."""
    n = even_parts(train.sparkSession, train.count())
    rows = with_class_weight(model_inputs(name, fm, train, order, [key]), pos_weight)
    return materialize(rows.select("features", "label", "w").coalesce(n), name in ROW_MODELS or SEQ_LEN * fm.width > DENSE_WIDTH)


def train_candidates(fm: FeatureModel, train: DataFrame, pos_weight: float, order: list[str],
                     key: str, which: tuple = tuple(CANDIDATE_ORDER)) -> dict:
    """K1-K3 on the training rows; rows get ``w`` = A3 for positives (trees only)."""
    inputs: dict[bool, DataFrame] = {}
    out = {}
    for name in (n for n in CANDIDATE_ORDER if n in which):
        by_rows = name in ROW_MODELS
        if by_rows not in inputs:
            inputs[by_rows] = training_inputs(name, fm, train, pos_weight, order, key)
        out[name] = fit_timed(name, estimator(name, fm), inputs[by_rows])
    return out


def candidate_scores(fm: FeatureModel, trained: dict, datasets: dict, order: list[str],
                     key: str, t: dict | float | None = None) -> DataFrame:
    """K4 + K6: every candidate on every dataset, one SCORED union; each (model, dataset)
    pair decides by its own threshold (``threshold_of``)."""
    parts = []
    for ds, df in datasets.items():
        inputs: dict[bool, DataFrame] = {}
        for name, tr in trained.items():
            by_rows = name in ROW_MODELS
            if by_rows not in inputs:
                inputs[by_rows] = model_inputs(name, fm, df, order, [key])
            parts.append(score(tr.model, inputs[by_rows], name, ds, key, t=threshold_of(name, ds, t)))
    return functools.reduce(DataFrame.unionByName, parts)


def candidate_scorecards(scored: DataFrame, trained: dict | None = None) -> DataFrame:
    """K6 + K12: one grouped scorecard over all (model, dataset) pairs, with fit seconds."""
    card = scorecard(scored, ["model", "dataset"])
    if trained:
        secs = scored.sparkSession.createDataFrame(
            [(n, float(t.seconds)) for n, t in trained.items()], "model string, train_seconds double")
        card = card.join(F.broadcast(secs), "model", "left")
    return card


def pick_winner(card: DataFrame, dataset: str, order: list[str] = CANDIDATE_ORDER) -> DataFrame:
    """Best F1 on the selection dataset, earlier candidate wins ties."""
    return select_model(card.where(F.col("dataset") == dataset), metric="f1", order=order)


def save_model(model: PipelineModel, path: str) -> None:
    """Spark ML persistence (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass(frozen=True)
class Experiment:
    """One row of an ablation: what is zeroed in the test inputs (F6), which split (D6), and whether
    the model's capacity is limited (K8)."""
    name: str
    zero_numeric: bool = False
    zero_categorical: bool = False
    shuffled: bool = False
    small: bool = False


EXPERIMENTS = (Experiment("baseline"), Experiment("no_numeric", zero_numeric=True), Experiment("no_categorical", zero_categorical=True),
               Experiment("capacity", small=True), Experiment("shuffled", shuffled=True))


def ablation_report(fm_fit, train: DataFrame, test: DataFrame, shuffled: tuple[DataFrame, DataFrame],
                    order: list[str], key: str, t: float | None = None, seed: int = 42, family: str = "mlp_seq",
                    experiments: tuple[Experiment, ...] = EXPERIMENTS) -> DataFrame:
    """K9 (with K8, F6, F7, D6) for a winner of any ``family``: confusion counts, F1 and FPR per
    experiment, deltas against the baseline (A15).

    Experiments share what they have in common: preprocessing and training inputs by split, models
    by split and capacity, test inputs by split and what is zeroed.  Preprocessing is refitted on the shuffled split, whose windows are cut
    over the seeded shuffled order, not over time."""
    t = threshold_of(family, "test", t)
    data = {False: (train, test, order)}
    if any(e.shuffled for e in experiments):
        data[True] = (*(d.withColumn("_shuffled", hash_order(F.col(key), seed)) for d in shuffled), ["_shuffled", key])
    fms, fitted, tested, parts = {}, {}, {}, []
    for e in experiments:
        own_train, own_test, by = data[e.shuffled]
        if e.shuffled not in fms:
            fm = fm_fit(own_train)
            weight = class_weight(own_train).first()["pos_weight"]
            fms[e.shuffled] = fm, training_inputs(family, fm, own_train, weight, by, key)
        fm, inputs = fms[e.shuffled]
        if (e.shuffled, e.small) not in fitted:
            fitted[e.shuffled, e.small] = fit_timed(e.name, estimator(family, fm, e.small), inputs).model
        inputs = e.shuffled, e.zero_numeric, e.zero_categorical
        if inputs not in tested:
            tested[inputs] = model_inputs(family, fm, own_test, by, [key], zero_numeric=e.zero_numeric, zero_categorical=e.zero_categorical)
        parts.append(score(fitted[e.shuffled, e.small], tested[inputs], e.name, "test", key, t=t))
    card = scorecard(functools.reduce(DataFrame.unionByName, parts), ["model"])
    return metric_delta(card, "model", experiments[0].name).withColumnRenamed("model", "experiment")


def live_scores(scorer: Scorer, live_flows: DataFrame, attackers: list[str], t: dict | float | None = None,
                window_col: str = "window_start", whitelist=DEFAULT_WHITELIST) -> DataFrame:
    """J6 with a fitted model: SCORED rows of live flows, labels by source.  Windows restart with
    each event window, in first-arrival order, and trusted sources' predictions are forced to 0
    (P14); a row model's predictions stay as they are, as in the reference."""
    flows = label_by_source(live_flows, attackers).withColumn("flow_key", F.col("first_seq"))
    scored = scorer.scores(flows, "live", ["first_seq"], "flow_key", t, keep=("src_ip",), partition_by=[window_col], label="final")
    return (whitelist_override(scored, whitelist) if scorer.windows else scored).drop("src_ip")


def three_way_scorecard(scorer: Scorer, set_a: DataFrame, set_b: DataFrame, live_flows: DataFrame, attackers: list[str],
                        order: list[str], key: str, t: dict | float | None = None,
                        window_col: str = "window_start", whitelist=DEFAULT_WHITELIST) -> DataFrame:
    """K10 + K11: a final model of any family on set A, set B and live traffic, one grouped
    scorecard, pivoted to metric rows x dataset columns (A18).  Each dataset has its threshold
    (``threshold_of``)."""
    sets = [scorer.scores(df, name, order, key, t, label="final") for name, df in (("A", set_a), ("B", set_b))]
    sets.append(live_scores(scorer, live_flows, attackers, t, window_col, whitelist))
    card = scorecard(functools.reduce(DataFrame.unionByName, sets), ["model", "dataset"])
    return scorecard_pivot(card, ["A", "B", "live"], ids=["model"])
