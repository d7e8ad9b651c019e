"""Scorecards.

All metrics are grouped aggregates over a scored table (``group`` columns such as model and
dataset, target ``y``, ``score``, decision ``pred``), so many (model, dataset) pairs are
scored in one job.

Curves (ROC-AUC, PR-AUC) follow the usual definitions: one curve point per distinct score,
taken in descending order, with ties merged.  The plan:
  1. count positives and negatives per (group, distinct score): a partial+final aggregate;
  2. running totals along descending score: one range exchange, totals of the partitions
     before, and a sum inside each partition (``running_sums``), never one task per group;
  3. the previous point's totals are ``cum - this``, so every trapezoid is a row-local
     expression, and the areas are one more grouped sum.
PR-AUC is the trapezoid over the precision/recall points anchored at (recall 0, precision 1).
Spark's ``BinaryClassificationEvaluator.areaUnderPR`` anchors differently and is not used.
A single-class group gets 0.5 for both areas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import safe_div
from flowlens.plans.materialize import materialize
from flowlens.plans.ordering import join_null_safe, running_sums

METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "fpr", "fnr"]


def with_decision(scored: DataFrame, t: float, score: str = "score", out: str = "pred") -> DataFrame:
    """P13 applied: ``pred = score >= t``."""
    return scored.withColumn(out, (F.col(score) >= F.lit(float(t))).cast("int"))


def confusion(scored: DataFrame, groups: list[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """A5: tp, fp, tn, fn per group, both classes always present (zeros when absent)."""
    yy, pp = F.col(y) == 1, F.col(pred) == 1
    return scored.groupBy(*groups).agg(
        F.count_if(yy & pp).alias("tp"), F.count_if(~yy & pp).alias("fp"),
        F.count_if(~yy & ~pp).alias("tn"), F.count_if(yy & ~pp).alias("fn"))


def basic_rates(cm: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 (= 2tp / (2tp + fp + fn)); 0 on a zero denominator."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return (cm.withColumn("accuracy", safe_div(tp + tn, tp + fp + tn + fn))
            .withColumn("precision", safe_div(tp, tp + fp))
            .withColumn("recall", safe_div(tp, tp + fn))
            .withColumn("f1", safe_div(2 * tp, 2 * tp + fp + fn)))


def error_rates(cm: DataFrame) -> DataFrame:
    """FPR = fp / (fp + tn), FNR = fn / (fn + tp); 0 when undefined."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return (cm.withColumn("fpr", safe_div(fp, fp + tn))
            .withColumn("fnr", safe_div(fn, fn + tp)))


def score_counts(scored: DataFrame, groups: list[str], y: str = "y", score: str = "score",
                 checkpoint: bool = True) -> DataFrame:
    """Positives and negatives per (group, distinct score): a partial+final aggregate whose
    result every curve pass re-reads, so its lineage is cut once."""
    per = scored.groupBy(*groups, score).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    return materialize(per, checkpoint)


def curve_points(scored: DataFrame, groups: list[str], y: str = "y", score: str = "score",
                 n_partitions: int | None = None, per: DataFrame | None = None) -> DataFrame:
    """One row per (group, distinct score) with counts at that score (pos, neg) and
    running totals over descending score (tp, fp) plus the group's totals (P, N)."""
    per = per if per is not None else score_counts(scored, groups, y, score)
    cum = running_sums(per, groups, score, ["pos", "neg"], descending=True, n_partitions=n_partitions)
    tot = per.groupBy(*groups).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    cum = cum.withColumnRenamed("pos_cum", "tp").withColumnRenamed("neg_cum", "fp")
    return join_null_safe(cum, tot, groups) if groups else attach_row(cum, tot)


def confusion_at(per: DataFrame, groups: list[str], t: float, score: str = "score") -> DataFrame:
    """A5 for ``pred = score >= t`` from per-score counts (no second scan of the rows)."""
    hit = F.col(score) >= F.lit(float(t))
    return per.groupBy(*groups).agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"))


def _pr_point(tp: Column, fp: Column) -> Column:
    return F.when(tp + fp == 0, F.lit(1.0)).otherwise(tp.cast("double") / (tp + fp).cast("double"))


def curve_areas(points: DataFrame, groups: list[str]) -> DataFrame:
    """A8 + A9 from curve points: trapezoids per point, summed per group."""
    tp, fp, pos, neg = F.col("tp"), F.col("fp"), F.col("pos"), F.col("neg")
    P, N = F.col("P").cast("double"), F.col("N").cast("double")
    roc_piece = neg.cast("double") * (2 * tp - pos).cast("double")
    pr_piece = pos.cast("double") * (_pr_point(tp, fp) + _pr_point(tp - pos, fp - neg))
    agg = points.groupBy(*groups).agg(
        F.sum(roc_piece).alias("_roc"), F.sum(pr_piece).alias("_pr"),
        F.first("P").alias("P"), F.first("N").alias("N"))
    single = (F.col("P") == 0) | (F.col("N") == 0)
    return agg.select(
        *groups,
        F.when(single, F.lit(0.5)).otherwise(F.col("_roc") / (F.lit(2.0) * P * N)).alias("roc_auc"),
        F.when(single, F.lit(0.5)).otherwise(F.col("_pr") / (F.lit(2.0) * P)).alias("pr_auc"))


def roc_auc(scored: DataFrame, groups: list[str], y: str = "y", score: str = "score") -> DataFrame:
    return curve_areas(curve_points(scored, groups, y, score), groups).drop("pr_auc")


def pr_auc(scored: DataFrame, groups: list[str], y: str = "y", score: str = "score") -> DataFrame:
    return curve_areas(curve_points(scored, groups, y, score), groups).drop("roc_auc")


def scorecard(scored: DataFrame, groups: list[str], y: str = "y", score: str = "score",
              pred: str = "pred", threshold: float | None = None) -> DataFrame:
    """A10: confusion counts and the 8 metrics per group in one table.

    With ``threshold`` the decision is ``score >= threshold`` and everything comes from the
    per-score counts; otherwise ``pred`` is taken as given (e.g. after warm-up fill and whitelist
    overrides) and everything comes from the tally.  Either way the rows are scored once."""
    if threshold is None:
        return scorecard_of_tally(materialize(tally(scored, groups, y, score, pred)), groups)
    per = score_counts(scored, groups, y, score)
    cm = error_rates(basic_rates(confusion_at(per, groups, threshold, score)))
    areas = curve_areas(curve_points(scored, groups, y, score, per=per), groups)
    return join_null_safe(cm, areas, groups) if groups else attach_row(cm, areas)


def tally(scored: DataFrame, groups: list[str], y: str = "y", score: str = "score", pred: str = "pred") -> DataFrame:
    """Rows per (group, truth, score, decision): what a scorecard needs of them.  Tallies of parts
    add up (``merge_tallies``), so a scorecard can be kept while rows arrive."""
    return scored.groupBy(*groups, (F.col(y) == 1).alias("y"), F.col(score).alias("score"),
                          (F.col(pred) == 1).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def merge_tallies(parts: DataFrame, groups: list[str]) -> DataFrame:
    return parts.groupBy(*groups, "y", "score", "pred").agg(F.sum("n").alias("n"))


def scorecard_of_tally(t: DataFrame, groups: list[str]) -> DataFrame:
    """A10 from a tally: equal to ``scorecard`` of the rows tallied."""
    yy, pp = F.col("y"), F.col("pred")

    def total(hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(hit, F.col("n")).otherwise(F.lit(0))), F.lit(0))

    cm = t.groupBy(*groups).agg(total(yy & pp).alias("tp"), total(~yy & pp).alias("fp"),
                                total(~yy & ~pp).alias("tn"), total(yy & ~pp).alias("fn"))
    per = materialize(t.groupBy(*groups, "score").agg(total(yy).alias("pos"), total(~yy).alias("neg")))
    areas = curve_areas(curve_points(t, groups, per=per), groups)
    cm = error_rates(basic_rates(cm))
    return join_null_safe(cm, areas, groups) if groups else attach_row(cm, areas)


def select_model(card: DataFrame, by: list[str] | None = None, metric: str = "f1",
                 model: str = "model", order: list[str] | None = None) -> DataFrame:
    """The best model per ``by`` group on ``metric``, strict ``>`` so the earlier model in
    ``order`` wins ties (names outside ``order`` rank after it, then alphabetically)."""
    by = by or []
    order = order or []
    pos = (F.array_position(F.array(*[F.lit(m) for m in order]), F.col(model))
           if order else F.lit(0).cast("bigint"))
    pos = F.when(pos == 0, F.lit(len(order) + 1)).otherwise(pos)
    # min_by over (-metric, position, name): a partial+final aggregate, deterministic on ties
    rank = F.struct((-F.col(metric)).alias("m"), pos.alias("p"), F.col(model).alias("n"))
    best = F.min_by(F.struct(*card.columns), rank).alias("_best")
    res = card.groupBy(*by).agg(best) if by else card.agg(best)
    return res.select("_best.*")


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Append the columns of a one-row table (an aggregate without groups) to every row: a
    broadcast equi-join on a constant, not a cartesian product."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(row.withColumn("_one", F.lit(1))), "_one").drop("_one"))


def metric_delta(card: DataFrame, key: str, baseline: str, metrics: tuple = ("f1", "fpr"),
                 by: list[str] | None = None) -> DataFrame:
    """Each row's metric minus that of the baseline row with the same ``by`` columns
    (default: ``dataset`` where the card has one; NULL matches NULL).  NULL on the baseline
    itself and where a group has no baseline; two baseline rows of one group raise."""
    by = by if by is not None else [c for c in ("dataset",) if c in card.columns and c != key]

    def only(m: str) -> Column:
        return F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"several rows with {key} = {baseline}"))) \
            .otherwise(F.max(m)).alias(f"_base_{m}")

    base = card.where(F.col(key) == baseline).groupBy(*by, F.lit(1).alias("_one")).agg(*[only(m) for m in metrics])
    out = join_null_safe(card.withColumn("_one", F.lit(1)), base, [*by, "_one"], how="left")
    for m in metrics:
        out = out.withColumn(f"delta_{m}", F.when(F.col(key) == baseline, F.lit(None))
                             .otherwise(F.col(m) - F.col(f"_base_{m}")))
    return out.drop("_one", *[f"_base_{m}" for m in metrics])


def batch_means(per_batch: DataFrame, values: list[str], groups: list[str] | None = None) -> DataFrame:
    """Mean of per-batch measurements, 0 when there is no batch."""
    aggs = [F.coalesce(F.avg(v), F.lit(0.0)).alias(f"mean_{v}") for v in values]
    return per_batch.groupBy(*groups).agg(*aggs) if groups else per_batch.agg(*aggs)


def scorecard_pivot(card: DataFrame, datasets: list[str], dataset: str = "dataset",
                    ids: list[str] | None = None, metrics: list[str] = METRICS) -> DataFrame:
    """Metric rows x dataset columns (unpivot, then pivot with the dataset list given so
    no extra job is needed to find the pivot values)."""
    ids = ids or []
    long = card.unpivot(ids + [dataset], metrics, "metric", "value")
    return long.groupBy(*ids, "metric").pivot(dataset, datasets).agg(F.first("value"))
