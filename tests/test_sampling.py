import pytest
from pyspark.sql import functions as F

from flowlens.operators import sampling as sm
from flowlens.plans.ordering import dense_index, fixed_order, running_sums, segments


def _log(spark, n=500):
    return spark.createDataFrame([(float(i % 97) * 10 + i / 1000, f"C{i}", i % 3 == 0) for i in range(n)],
                                 "ts double, uid string, is_benign boolean")


def test_stratified_exact_counts_and_determinism(spark):
    df = _log(spark)
    s = sm.stratified_sample(df, "is_benign", {True: 40, False: 70})
    c = {r["is_benign"]: r["count"] for r in s.groupBy("is_benign").count().collect()}
    assert c == {True: 40, False: 70}
    again = sm.stratified_sample(df.repartition(7), "is_benign", {True: 40, False: 70})
    assert sorted(r["uid"] for r in s.collect()) == sorted(r["uid"] for r in again.collect())


def test_stratified_too_small_raises(spark):
    with pytest.raises(Exception):
        sm.stratified_sample(_log(spark), "is_benign", {True: 1000}).collect()


def test_splits_cover_disjoint_ordered(spark):
    df = _log(spark)
    ch = sm.chronological_split(df)
    c = {r["split"]: r["count"] for r in ch.groupBy("split").count().collect()}
    assert c == {"train": 350, "cal": 50, "test": 100}
    a = sm.leakage_audit(ch).first()
    assert a["time_ordered"] and a["key_overlap"] == 0
    sh = sm.shuffled_split(df)
    c = {r["split"]: r["count"] for r in sh.groupBy("split").count().collect()}
    assert c == {"train": 350, "test": 150}


def test_dense_index_matches_row_number(spark):
    from pyspark.sql import Window
    df = _log(spark, 333)
    got = {r["uid"]: r["_i"] for r in dense_index(df, ["ts", "uid"], rows_per_partition=40).collect()}
    w = Window.orderBy("ts", "uid")
    want = {r["uid"]: r["i"] for r in df.withColumn("i", F.row_number().over(w) - 1).collect()}
    assert got == want


def test_dense_index_hot_value_and_strata(spark):
    from pyspark.sql import Window
    # a third of the rows share one ts: still exact, spread over range partitions
    rows = [(5.0 if i % 3 == 0 else float(i), f"C{i:04d}", f"s{i % 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "ts double, uid string, st string")
    got = dense_index(df, ["ts", "uid"], strata=["st"], rows_per_partition=25)
    w = Window.partitionBy("st").orderBy("ts", "uid")
    want = {r["uid"]: r["i"] for r in df.withColumn("i", F.row_number().over(w) - 1).collect()}
    assert {r["uid"]: r["_i"] for r in got.collect()} == want


def test_ratio_split_and_union(spark):
    df = _log(spark)
    s = sm.ratio_split(df, "is_benign", 100, {True: 0.6, False: 0.4})
    assert s.count() == 100
    u = sm.union_all(df.where("is_benign"), df.where("not is_benign"))
    assert u.count() == 500
    first = sm.restore_order(s).first()
    assert first["ts"] == min(r["ts"] for r in s.collect())


@pytest.mark.parametrize("fractions", [[0.3, 0.8], [0.05, 0.06], [0.0, 0.2, 0.2, 1.0]])
def test_segments_equal_ranks_however_runs_are_ranked(spark, fractions):
    rows = [(5.0 if i % 3 == 0 else float(i), f"C{i:04d}", i % 4 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "ts double, uid string, st boolean")
    for stratum in (None, "st"):
        ranks = {}
        for ts, uid, st in sorted(rows):
            own = st if stratum else 0
            ranks.setdefault(own, []).append(uid)
        cuts = lambda _, n: [int(f * n) for f in fractions]
        want = {u: sum(c <= i for c in cuts(0, len(own))) for own in ranks.values() for i, u in enumerate(own)}
        for task_rows in (10, 2_000_000):
            got = segments(df, F.col("ts"), ["ts", "uid"], cuts, stratum, task_rows=task_rows)
            assert {r["uid"]: r["segment"] for r in got.collect()} == want


def test_rows_that_agree_in_every_key_are_spread_over_tasks(spark):
    """A third of the rows equal: exact counts, and no partition with more than twice its share."""
    n, parts = 60_000, 12
    df = spark.range(n, numPartitions=6).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("ts"),
                                                F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("uid"))
    sizes = [r["count"] for r in fixed_order(df, ["ts", "uid"], parts).groupBy("_pid").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * n / parts
    idx = dense_index(df, ["ts", "uid"], n_partitions=parts)
    assert idx.agg(F.min("_i"), F.max("_i"), F.countDistinct("_i")).first()[:] == (0, n - 1, n)
    assert idx.where("uid = 'same'").agg(F.max("_i") - F.min("_i")).first()[0] == n // 3 - 1
    for task_rows in (1000, 2_000_000):
        split = sm.shuffled_split(df, task_rows=task_rows)
        assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 42_000, "test": 18_000}
        s = sm.stratified_sample(df.withColumn("st", F.lit("a")), "st", {"a": 31_000}, task_rows=task_rows)
        assert s.count() == 31_000


def test_running_sums_over_groups_that_span_partitions(spark):
    rows = [(g, float(i), i % 5, 1) for g, n in (("a", 70), (None, 3), ("b", 400), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, x double, v bigint, one bigint")
    for parts in (1, 3, 40):
        got = running_sums(df, ["g"], "x", ["v", "one"], n_partitions=parts).collect()
        assert len(got) == len(rows)
        for r in got:
            own = [y for y in rows if y[0] == r["g"] and y[1] >= r["x"]]
            assert (r["v_cum"], r["one_cum"]) == (sum(y[2] for y in own), len(own))
    assert running_sums(df.where("false"), ["g"], "x", ["v"]).count() == 0


def test_null_stratum_is_a_stratum(spark):
    rows = [(float(i), f"C{i:03d}", None if i % 4 == 0 else (i % 2 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "ts double, uid string, grp boolean")
    s = sm.stratified_sample(df, "grp", {None: 10, True: 20, False: 30})
    c = {r["grp"]: r["count"] for r in s.groupBy("grp").count().collect()}
    assert c == {None: 10, True: 20, False: 30}
    idx = dense_index(df, ["ts", "uid"], strata=["grp"], n_partitions=3)
    assert idx.where("grp is null").agg(F.max("_i")).first()[0] == 49
