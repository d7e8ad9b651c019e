import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlens.operators import sequences as sq


def _rows(spark, n, hosts=1):
    return spark.createDataFrame([(float(i), f"u{i:04d}", f"h{i % hosts}", i, i % 2) for i in range(n)],
                                 "ts double, uid string, host string, x long, y int")


@pytest.mark.parametrize("n,full,padded", [(4, 0, 4), (5, 1, 5), (7, 3, 7)])
def test_window_counts(spark, n, full, padded):
    df = _rows(spark, n)
    assert sq.sequence_windows(df, ["ts", "uid"], ["x"], keep=["uid"]).count() == full
    p = sq.sequence_windows(df, ["ts", "uid"], ["x"], pad=True, keep=["uid"])
    assert p.count() == padded
    assert all(len(r["seq"]) == 5 for r in p.collect())


def test_last_row_label_and_padding(spark):
    df = _rows(spark, 7)
    w = {r["uid"]: r for r in sq.sequence_windows(df, ["ts", "uid"], ["x"], pad=True, keep=["uid", "y"]).collect()}
    assert w["u0000"]["seq"] == [[0.0]] * 4 + [[0.0]]
    assert w["u0001"]["seq"] == [[0.0]] * 3 + [[0.0], [1.0]]
    assert w["u0006"]["seq"] == [[2.0], [3.0], [4.0], [5.0], [6.0]] and w["u0006"]["y"] == 0


@pytest.fixture
def partitions(spark):
    """Sets the number of range partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("n,batch", [(1, 10_000), (7, 3), (150, 10_000)])
def test_slide_equals_plain_window(spark, partitions, n, batch):
    """Two-plan equality: partitions and Arrow batches of a few rows vs the plain global window."""
    partitions(n)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    df = _rows(spark, 300, hosts=3)
    slid = sq.sequence_windows(df, ["ts", "uid"], ["x"], keep=["uid"])
    got = {r["uid"]: [m["x"] for m in r["members"]] for r in slid.collect()}
    w = Window.orderBy("ts", "uid").rowsBetween(-4, 0)
    plain = df.withColumn("m", F.collect_list("x").over(w)).where(F.size("m") == 5)
    want = {r["uid"]: r["m"] for r in plain.collect()}
    assert got == want and len(got) == 296


def test_partitioned_windows(spark):
    df = _rows(spark, 60, hosts=3)
    per = sq.sequence_windows(df, ["ts", "uid"], ["x"], partition_by=["host"], keep=["uid"])
    assert per.count() == 3 * (20 - 4)
    r = {x["uid"]: [m["x"] for m in x["members"]] for x in per.collect()}
    assert r["u0059"] == [47, 50, 53, 56, 59]


def test_warmup_fill(spark):
    df = spark.createDataFrame([(i, 1) for i in range(1, 8)], "pos int, pred int")
    assert [r["pred"] for r in sq.warmup_fill(df, "pos").orderBy("pos").collect()] == [0, 0, 0, 0, 1, 1, 1]
    df = spark.createDataFrame([(i, 1) for i in range(1, 5)], "pos int, pred int")
    assert [r["pred"] for r in sq.warmup_fill(df, "pos").collect()] == [0, 0, 0, 0]


def test_score_windows(spark):
    df = _rows(spark, 12)
    w = sq.sequence_windows(df, ["ts", "uid"], ["x"], keep=["uid"])
    s = sq.score_windows(w.select("uid", "seq"), lambda t: t.mean(axis=(1, 2)), keep=["uid"])
    got = {r["uid"]: r["score"] for r in s.collect()}
    assert got["u0004"] == pytest.approx(2.0) and got["u0011"] == pytest.approx(9.0)


@pytest.mark.parametrize("n,batch", [(2, 10_000), (9, 4), (60, 10_000)])
def test_keys_that_span_partitions(spark, partitions, n, batch):
    """One key with most rows, keys with fewer rows than a window, a null key; both paddings, and
    scores equal to those of the windows as rows."""
    partitions(n)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    rows = [(k, float(i), i * 10, i % 2) for k, m in (("hot", 100), ("one", 1), (None, 7), ("two", 2), ("z", 5)) for i in range(m)]
    df = spark.createDataFrame(rows, "k string, ts double, x long, y int")
    for pad in (False, True):
        got = sq.sequence_windows(df, ["ts"], ["x", "y"], pad=pad, partition_by=["k"], keep=["ts", "y"], member_cols=["ts"])
        want = set()
        for k, i, x, y in rows:
            own = [r for r in rows if r[0] == k and r[1] <= i][-5:]
            if pad or len(own) == 5:
                seq = [(0.0, 0.0)] * (5 - len(own)) + [(float(r[2]), float(r[3])) for r in own]
                want.add((k, i, y, int(i), len(own), tuple((int(r[1]), *r[1:]) for r in own), tuple(seq)))
        assert {(r["k"], r["ts"], r["y"], r["seq_pos"], r["n_real"], tuple(map(tuple, r["members"])), tuple(map(tuple, r["seq"])))
                for r in got.collect()} == want and got.count() == len(want)
        model = lambda t: (t * [1.0, 0.5]).sum(axis=(1, 2)) + t.shape[1]
        a = sq.score_windows(got, model, keep=["k", "ts", "seq_pos"])
        b = sq.score_sequences(df, ["ts"], ["x", "y"], model, pad=pad, partition_by=["k"], keep=["ts"])
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select("k", "ts", "seq_pos", "score").collect()))


def test_one_exchange_of_the_rows(spark):
    s = sq.score_sequences(_rows(spark, 50), ["ts", "uid"], ["x"], lambda t: t.mean(axis=(1, 2)), keep=["uid"])
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and s.count() == 46          # the only one lies before the checkpoint
