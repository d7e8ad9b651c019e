import pytest

from flowlens.operators import metrics as mt

FIX = [(0.9, 0), (0.9, 1), (0.8, 1), (0.8, 0), (0.4, 1), (0.1, 0)]


def _card(spark, rows, t=0.8, groups=("g",)):
    df = spark.createDataFrame([("a", s, y) for s, y in rows], "g string, score double, y int")
    return mt.scorecard(df, list(groups), threshold=t).first().asDict()


def test_fixture_metrics(spark):
    c = _card(spark, FIX)
    assert (c["tp"], c["fp"], c["fn"], c["tn"]) == (2, 2, 1, 1)
    assert c["accuracy"] == pytest.approx(0.5)
    assert c["precision"] == pytest.approx(0.5)
    assert c["recall"] == pytest.approx(2 / 3)
    assert c["f1"] == pytest.approx(0.571429, abs=1e-6)
    assert c["fpr"] == pytest.approx(2 / 3) and c["fnr"] == pytest.approx(1 / 3)
    assert c["roc_auc"] == pytest.approx(5 / 9)
    assert c["pr_auc"] == pytest.approx(0.6)


def test_single_class_and_no_positive_prediction(spark):
    c = _card(spark, [(0.3, 0), (0.2, 0)], t=0.5)
    assert (c["roc_auc"], c["pr_auc"]) == (0.5, 0.5)
    assert (c["precision"], c["f1"]) == (0.0, 0.0)
    c = _card(spark, [(0.3, 1), (0.2, 0)], t=0.9)
    assert (c["precision"], c["recall"], c["f1"]) == (0.0, 0.0, 0.0)


def test_no_groups(spark):
    c = _card(spark, FIX, groups=())
    assert c["pr_auc"] == pytest.approx(0.6)


def test_auc_monotone_invariance(spark):
    import random
    random.seed(3)
    rows = [(random.random(), random.randint(0, 1)) for _ in range(300)]
    a = _card(spark, rows)
    b = _card(spark, [(s ** 3, y) for s, y in rows])
    assert a["roc_auc"] == pytest.approx(b["roc_auc"]) and a["pr_auc"] == pytest.approx(b["pr_auc"])


def test_model_tie_order(spark):
    card = spark.createDataFrame([("lstm", 0.7), ("lgb", 0.7), ("xgb", 0.5)], "model string, f1 double")
    best = mt.select_model(card, order=["lgb", "xgb", "lstm"]).first()
    assert best["model"] == "lgb"
    best = mt.select_model(card, order=["lstm", "lgb"]).first()
    assert best["model"] == "lstm"


def test_metric_delta_and_pivot(spark):
    card = spark.createDataFrame([("base", "A", 0.5, 0.2), ("x", "A", 0.7, 0.1)],
                                 "model string, dataset string, f1 double, fpr double")
    d = {r["model"]: r for r in mt.metric_delta(card, "model", "base").collect()}
    assert d["base"]["delta_f1"] is None and d["x"]["delta_f1"] == pytest.approx(0.2)
    p = mt.scorecard_pivot(card, ["A"], ids=["model"], metrics=["f1", "fpr"])
    assert p.count() == 4
    m = mt.batch_means(spark.createDataFrame([], "n double"), ["n"]).first()
    assert m["mean_n"] == 0.0
