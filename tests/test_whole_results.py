"""Results that must not lose rows or values on inputs the conformance views never contain."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlens.operators import features as ft
from flowlens.operators import metrics as mt
from flowlens.operators import models as md
from flowlens.operators import sampling as sm
from flowlens.operators.flows import aggregate_flows
from flowlens.plans import selection
from flowlens.plans.selection import order_statistics
from flowlens.sources import sinks

from conftest import FIXTURE_PACKETS, PACKET_DDL

CARD = [("m0", "A", 0.5, 0.1), ("m1", "A", 0.7, 0.2), ("m0", "B", 0.9, 0.0), ("m1", "B", 0.8, 0.3), ("m0", None, 0.1, 0.5),
        ("m1", None, 0.4, 0.4), ("m1", "C", 0.6, 0.6)]


def test_delta_is_taken_against_the_same_dataset(spark):
    card = spark.createDataFrame(CARD, "model string, dataset string, f1 double, fpr double")
    got = {(r["model"], r["dataset"]): r["delta_f1"] for r in mt.metric_delta(card, "model", "m0").collect()}
    assert len(got) == len(CARD)
    assert {k: v if v is None else round(v, 9) for k, v in got.items()} == {
        ("m0", "A"): None, ("m1", "A"): 0.2, ("m0", "B"): None, ("m1", "B"): -0.1, ("m0", None): None, ("m1", None): 0.3, ("m1", "C"): None}


def test_two_baselines_raise(spark):
    card = spark.createDataFrame(CARD + [("m0", "A", 0.2, 0.2)], "model string, dataset string, f1 double, fpr double")
    with pytest.raises(Exception, match="several rows"):
        mt.metric_delta(card, "model", "m0").collect()


def test_null_groups_stay(spark):
    rows = [("m", d, i % 2, i / 10) for d in ("A", None) for i in range(10)]
    scored = spark.createDataFrame(rows, "model string, dataset string, y int, score double")
    card = {r["dataset"]: r for r in mt.scorecard(scored, ["model", "dataset"], threshold=0.5).collect()}
    assert card.keys() == {"A", None}
    assert card["A"]["roc_auc"] == card[None]["roc_auc"]
    assert mt.curve_points(scored, ["model", "dataset"]).count() == 20


def test_absent_stratum_raises(spark):
    df = spark.createDataFrame([(str(i), True) for i in range(20)], "uid string, is_benign boolean")
    with pytest.raises(ValueError, match="False"):
        sm.stratified_sample(df, "is_benign", {True: 10, False: 5})
    with pytest.raises(ValueError, match="21"):
        sm.stratified_sample(df, "is_benign", {True: 21})


@pytest.mark.parametrize("shares", [{True: 0.29, False: 0.71}, {True: 0.6, False: 0.4}, {True: 1 / 3, False: 2 / 3}])
def test_ratio_totals_are_met(spark, shares):
    assert sum(sm.share_sizes(100, shares).values()) == 100
    df = spark.createDataFrame([(str(i), i % 2 == 0) for i in range(400)], "uid string, is_benign boolean")
    assert sm.ratio_split(df, "is_benign", 100, shares).count() == 100


def test_packets_without_a_time_belong_to_no_flow(spark):
    rows = [*FIXTURE_PACKETS, (50, None, "10.0.0.20", "10.0.0.21", "tcp", 1, 2, 0, 60)]
    df = spark.createDataFrame(rows, PACKET_DDL)
    assert aggregate_flows(df).where("src_ip = '10.0.0.20'").count() == 0
    assert aggregate_flows(df, window="1 day").count() == aggregate_flows(df).count()


def test_flows_without_history_are_the_same_flows(spark):
    df = spark.createDataFrame(FIXTURE_PACKETS, PACKET_DDL)
    short, whole = aggregate_flows(df, history=False), aggregate_flows(df)
    assert "WindowGroupLimit" not in short._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, whole.drop("history").collect()))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.just(float("nan")), st.just(float("inf")), st.just(float("-inf")),
                                 st.floats(-50, 50), st.sampled_from([1.0, 2.0])), max_size=60), size=st.sampled_from([2, 5, 4096]))
def test_medians_are_exact_at_any_number_of_bins(spark, values, size):
    df = spark.createDataFrame([(v, 7.0 if i % 3 else None) for i, v in enumerate(values)], "a double, b double")
    got = {r["feature"]: r["median"] for r in ft.exact_medians(df, ["a", "b"], bins=size).collect()}
    for c, own in (("a", [v for v in values if v is not None and not math.isnan(v)]), ("b", [7.0 for i in range(len(values)) if i % 3])):
        own.sort()
        want = (own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2 if own else None
        assert (got.get(c) is None) == (want is None)
        assert want is None or got[c] == want or (math.isnan(want) and math.isnan(got[c]))


def test_ranks_and_cuts_take_nan_and_infinity(spark):
    values = [None, float("-inf"), -1.0, 0.0, 0.0, 5.0, float("inf"), float("nan")] * 5
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x double, i int")
    total, cuts = order_statistics(df.where("x is not null").withColumn("g", F.lit("a")), lambda _, n: [0, 4, 5, 12, 24, 29, 34], "g", "x")["a"]
    assert total == 35
    assert [(c.value, c.below, c.equal) for c in cuts[:-1]] == [(float("-inf"), 0, 5), (float("-inf"), 0, 5), (-1.0, 5, 5), (0.0, 10, 10), (5.0, 20, 5),
                                                               (float("inf"), 25, 5)]
    assert math.isnan(cuts[-1].value) and (cuts[-1].below, cuts[-1].equal) == (30, 5)
    split = sm.chronological_split(df.withColumnRenamed("x", "ts").withColumnRenamed("i", "uid"))
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 28, "cal": 4, "test": 8}
    assert {r["split"] for r in split.where("ts is null or ts = double('-inf')").collect()} == {"train"}


def test_collected_rows_do_not_follow_the_row_count(spark, monkeypatch):
    seen = []
    real = selection._counted
    monkeypatch.setattr(selection, "_counted", lambda *a: seen.append(len(out := real(*a))) or out)
    for n in (20_000, 400_000):
        df = spark.range(n).select((F.rand(3) * 1e6).alias("a"), F.exp(F.randn(5) * 20).alias("b"))
        m = {r["feature"]: r["median"] for r in ft.exact_medians(df, ["a", "b"]).collect()}
        want = df.agg(F.median("a").alias("a"), F.median("b").alias("b")).first().asDict()
        assert m == want
    assert max(seen) <= 2 * 4096


def test_thresholds_by_model_and_dataset():
    assert [md.threshold_of(*x) for x in (("gbt", "A"), ("mlp_seq", "B"), ("final", "live"))] == [0.5, 0.9, 0.05]
    own = {("gbt", "A"): 0.1, "gbt": 0.2, "live": 0.3}
    assert [md.threshold_of(*x, own) for x in (("gbt", "A"), ("gbt", "B"), ("final", "live"), ("rf", "A"))] == [0.1, 0.2, 0.3, 0.5]
    assert md.threshold_of("gbt", "A", 0.7) == 0.7


def test_feature_model_survives_a_session(spark, tmp_path):
    fm = ft.FeatureModel.of(spark, {"a": 1.5}, {"a": 0.25}, {"a": 2.0}, {"c": ["é", "x'y", "unknown"]})
    fm.save(spark, f"{tmp_path}/fm")
    again = ft.FeatureModel.load(spark.newSession(), f"{tmp_path}/fm")
    assert again == fm
    df = spark.createDataFrame([(None, "é"), (3.0, None)], "a double, c string")
    assert [r["features"] for r in fm.transform(df).collect()] == [r["features"] for r in again.transform(df).collect()]


def test_sinks_of_one_name_keep_separate_checkpoints(spark, tmp_path):
    spark.range(7).write.parquet(f"{tmp_path}/in")
    for folder in ("a", "b"):
        stream = spark.readStream.schema("id bigint").parquet(f"{tmp_path}/in")
        sinks.alert_sink(stream, f"{tmp_path}/{folder}/alerts", trigger_once=True).awaitTermination(60)
        assert spark.read.parquet(f"{tmp_path}/{folder}/alerts").count() == 7
    stream = spark.newSession().readStream.schema("id bigint").parquet(f"{tmp_path}/in")
    sinks.alert_sink(stream, f"{tmp_path}/a/alerts", trigger_once=True).awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/a/alerts").count() == 7
    assert np.isfinite(spark.read.parquet(f"{tmp_path}/a/alerts").agg({"id": "sum"}).first()[0])
