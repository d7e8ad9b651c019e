import pytest
from pyspark.sql import functions as F

from flowlens.functions.columns import imbalance_ratio, imbalance_severity
from flowlens.operators import labels as lb
from flowlens.operators import profile as pf


@pytest.mark.parametrize("benign,attack,ratio,band", [
    (1500, 1000, "1:1.50", "Low Imbalance"),
    (10000, 1111, "1:9.00", "Severe Imbalance"),
    (40, 10, "1:4.00", "Moderate Imbalance"),
    (100, 10, "1:10.00", "Severe Imbalance"),
    (5, 0, "1:inf", "Extreme Imbalance"),
    (0, 0, "N/A", "N/A"),
])
def test_imbalance_table(spark, benign, attack, ratio, band):
    df = spark.createDataFrame([(benign, attack)], "benign long, attack long")
    r = df.select(imbalance_ratio(F.col("benign"), F.col("attack")).alias("r"),
                  imbalance_severity(F.col("benign"), F.col("attack")).alias("s")).first()
    assert (r["r"], r["s"]) == (ratio, band)


def test_label_rules(spark):
    rows = [("Benign",), (" benign ",), ("BENIGN-x",), ("Malicious",), ("",), ("not benign",), (None,)]
    df = spark.createDataFrame(rows, "label string")
    out = [r["y"] for r in lb.clean_labels(df).collect()]
    assert out == [0, 0, 0, 1, 1, 1]


def test_class_counts_and_weight(spark):
    rows = [("s1", True, 0)] * 6 + [("s1", False, 1)] * 2 + [("s2", True, 0)] * 3
    df = spark.createDataFrame(rows, "split string, is_benign boolean, y int")
    c = {r["split"]: (r["total"], r["benign"], r["attack"]) for r in pf.class_counts(df).collect()}
    assert c == {"s1": (8, 6, 2), "s2": (3, 3, 0)}
    w = {r["split"]: r["pos_weight"] for r in pf.class_weight(df, groups=["split"]).collect()}
    assert w == {"s1": 3.0, "s2": 1.0}


def test_whitelist_and_source_label(spark):
    from flowlens.operators.decisions import whitelist_override
    df = spark.createDataFrame([("192.168.1.100", 1), ("192.168.1.150", 1), ("10.0.0.1", 0)],
                               "src_ip string, pred int")
    assert [r["pred"] for r in whitelist_override(df).collect()] == [0, 1, 0]
    wl = spark.createDataFrame([("10.0.0.1",), ("192.168.1.150",)], "ip string")
    assert sorted(r["pred"] for r in whitelist_override(df, wl).collect()) == [0, 0, 1]
    assert [r["y"] for r in lb.label_by_source(df).collect()] == [0, 1, 0]
