from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlens.operators import metrics as mt
from flowlens.operators import sampling as sm

rows_strategy = st.lists(st.tuples(st.integers(0, 50), st.booleans()), min_size=1, max_size=80)


@settings(max_examples=4, deadline=None)
@given(rows_strategy)
def test_chronological_split_disjoint_cover_ordered(spark, rows):
    data = [(float(t), f"C{i:03d}", b) for i, (t, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "ts double, uid string, is_benign boolean")
    out = sm.chronological_split(df, n_buckets=4).collect()
    n = len(data)
    assert sorted(r["uid"] for r in out) == sorted(d[1] for d in data)        # cover, disjoint
    counts = {s: sum(1 for r in out if r["split"] == s) for s in ("train", "cal", "test")}
    assert counts["train"] == int(0.7 * n) and counts["cal"] == int(0.8 * n) - int(0.7 * n)
    order = sorted(out, key=lambda r: (r["ts"], r["uid"]))
    rank = {"train": 0, "cal": 1, "test": 2}
    assert [rank[r["split"]] for r in order] == sorted(rank[r["split"]] for r in order)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(0, 1)), min_size=1, max_size=60),
       st.floats(0, 1))
def test_confusion_totals(spark, rows, t):
    df = spark.createDataFrame([("g", s, y) for s, y in rows], "g string, score double, y int")
    c = mt.scorecard(df, ["g"], threshold=t).first()
    assert c["tp"] + c["fp"] + c["tn"] + c["fn"] == len(rows)
    assert c["tp"] + c["fn"] == sum(y for _, y in rows)
    assert 0.0 <= c["roc_auc"] <= 1.0 and 0.0 <= c["pr_auc"] <= 1.0
    d = mt.confusion(mt.with_decision(df, t), ["g"]).first()
    assert (d["tp"], d["fp"], d["tn"], d["fn"]) == (c["tp"], c["fp"], c["tn"], c["fn"])
    assert df.where(F.col("score") >= t).count() == c["tp"] + c["fp"]
