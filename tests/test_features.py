import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from flowlens.operators import features as ft


@pytest.mark.parametrize("accuracy", [50, 1000, 100_000])
def test_exact_medians_narrow_bracket(spark, accuracy):
    random.seed(accuracy)
    a = [random.gauss(0, 1) for _ in range(2001)]                 # odd count
    b = [float(random.randint(0, 5)) for _ in range(2000)]        # even count, heavy ties
    c = [None if i % 3 else random.random() for i in range(2001)]  # nulls ignored
    rows = list(zip(a, b + [None], c))
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r["feature"]: r["median"] for r in ft.exact_medians(df, ["a", "b", "c"], accuracy).collect()}
    assert got["a"] == pytest.approx(float(np.median(a)))
    assert got["b"] == pytest.approx(float(np.median(b)))
    assert got["c"] == pytest.approx(float(np.median([x for x in c if x is not None])))


def test_moments_population_std_and_vocab(spark):
    df = spark.createDataFrame([(1.0, "x"), (3.0, None), (None, "y")], "v double, k string")
    fm = ft.fit_features(df, numeric=["v"], categorical=["k"])
    assert fm.medians["v"] == 2.0 and fm.means["v"] == pytest.approx(2.0)
    assert fm.stds["v"] == pytest.approx(np.std([1.0, 3.0, 2.0]))
    assert [r["value"] for r in fm.vocabulary.where("feature = 'k'").orderBy("slot").collect()] == ["unknown", "x", "y"]
    const = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert ft.fit_features(const, numeric=["v"], categorical=[]).stds["v"] == 1.0


def test_a_hundred_thousand_values_make_no_wider_plan(spark, tmp_path, monkeypatch):
    """A vocabulary of 100,000 values stays a table, whatever way it is joined."""
    n = 100_000
    df = spark.range(n).select(F.col("id").cast("double").alias("v"), F.format_string("h%06d", F.col("id")).alias("history"),
                               F.when(F.col("id") % 3 == 0, "tcp").alias("proto"))
    fm = ft.fit_features(df, numeric=["v"], categorical=["proto", "history"])
    assert fm.sizes == {"proto": 2, "history": n} and fm.width == n + 3
    fm.save(spark, str(tmp_path / "fm"))
    again = ft.FeatureModel.load(spark, str(tmp_path / "fm"))
    assert spark.read.parquet(str(tmp_path / "fm" / "vocabulary")).count() == n + 2
    few = df.where("id % 20000 = 7 OR history = 'h000009'").unionByName(
        spark.createDataFrame([(1.0, "unseen", "icmp")], "v double, history string, proto string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (ft.BROADCAST_BYTES, 0):
        monkeypatch.setattr(ft, "BROADCAST_BYTES", limit)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)      # else Spark broadcasts small tables itself
        got = again.transform(few)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastExchange" in plan) == (limit > 0) and len(plan) < 40_000
        for r in got.collect():
            v, hot = r["features"], []
            assert type(v).__name__ == "SparseVector" and v.size == n + 3
            if r["history"] != "unseen":
                hot = [1 + (0 if r["proto"] else 1), 3 + int(r["history"][1:])]
            assert [int(i) for i in v.indices if i > 0] == hot and set(v.values[1:]) <= {1.0}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
