import random

import duckdb
import numpy as np
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.sql import functions as F

from flowlens.operators import features as ft
from flowlens.operators import models as md
from flowlens.operators import network
from flowlens.plans.conformance import models as queries
from flowlens.plans.conformance.labels import chrono
from flowlens.plans.materialize import materialize, spread


def _data(spark, n=240):
    random.seed(11)
    rows = []
    for i in range(n):
        y = 1 if random.random() < 0.3 else 0
        rows.append((float(i), f"C{i:04d}", y, float(random.random() + 2 * y), float(random.randint(1, 5)),
                     "udp" if (i + y) % 3 == 0 else "tcp"))
    return spark.createDataFrame(rows, "ts double, uid string, y int, duration double, orig_pkts double, proto string")


def test_seeded_reruns_equal_and_winner_roundtrip(spark, tmp_path):
    df = _data(spark)
    train, test = df.where("ts < 160"), df.where("ts >= 160")
    fm = ft.fit_features(train, numeric=["duration", "orig_pkts"], categorical=["proto"])

    def run():
        rows = md.with_class_weight(md.prepare_rows(fm, train), 2.0)
        tr = {"gbt": md.fit_timed("gbt", md.gbt(max_iter=5, depth=3), rows),
              "rf": md.fit_timed("rf", md.rf(trees=5, depth=3), rows)}
        sc = md.candidate_scores(fm, tr, {"A": test, "B": test}, ["ts", "uid"], "uid")
        return tr, md.candidate_scorecards(sc)

    tr, c1 = run()
    _, c2 = run()
    key = lambda r: (r["model"], r["dataset"])
    a = sorted((r.asDict() for r in c1.collect()), key=key)
    b = sorted((r.asDict() for r in c2.collect()), key=key)
    assert a == b and len(a) == 4
    win = md.pick_winner(c1, "B").first()["model"]
    path = str(tmp_path / "winner")
    md.save_model(tr[win].model, path)
    x = md.prepare_rows(fm, test)
    p1 = tr[win].model.transform(x).select("probability").collect()
    p2 = md.load_model(path).transform(x).select("probability").collect()
    assert p1 == p2


def test_sequence_candidate_shapes(spark):
    df = _data(spark, 60)
    fm = ft.fit_features(df, numeric=["duration"], categorical=["proto"])
    seqs = md.prepare_sequences(fm, df, ["ts", "uid"], keep=["uid"])
    assert seqs.count() == 56
    assert len(seqs.first()["features"]) == 5 * fm.width
    m = md.fit_timed("mlp", md.mlp(5 * fm.width, hidden=3, max_iter=5), seqs).model
    s = md.score(m, seqs, "mlp", "A", "uid")
    assert s.where(F.col("score").between(0, 1)).count() == 56


def test_dense_and_sparse_windows_hold_the_same_vectors(spark, monkeypatch):
    df = _data(spark, 60).withColumn("proto", F.when(F.col("ts") < 50, F.col("proto")).otherwise("gre"))
    fm = ft.fit_features(df.where("ts < 50"), numeric=["duration", "orig_pkts"], categorical=["proto"])

    def vectors(by, **zero):
        rows = md.prepare_sequences(fm, df, ["ts", "uid"], keep=["uid"], partition_by=by, **zero).collect()
        return {r["uid"]: (r["features"].toArray().tolist(), r["label"], r["seq_pos"], r["n_real"]) for r in rows}

    def both(*by, **zero):
        with monkeypatch.context() as patch:
            dense = vectors(list(by), **zero)
            patch.setattr(md, "DENSE_WIDTH", 0)
            return dense, vectors(list(by), **zero)

    for by, zero in (((), {}), (("proto",), {}), ((), {"zero_categorical": True, "zero_numeric": True})):
        dense, sparse = both(*by, **zero)
        assert dense == sparse and dense


def test_fit_inputs_are_even_and_as_many_as_the_cores(spark):
    df = _data(spark, 240).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    even = materialize(spread(df))
    train = even.where("ts < 160")
    fm = ft.fit_features(train, numeric=["duration", "orig_pkts"], categorical=["proto"])
    for name in ("gbt", "mlp_seq"):
        inputs = md.training_inputs(name, fm, train, 2.0, ["ts", "uid"], "uid")
        sizes = [r["n"] for r in inputs.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert inputs.rdd.getNumPartitions() <= cores and len(sizes) > 1 and max(sizes) < 0.75 * sum(sizes)
        assert sum(sizes) == (160 if name == "gbt" else 156)


def _network(spark, n=300, parts=1, **params):
    df = _data(spark, n).withColumn("service", F.when(F.col("ts") % 3 == 0, "dns"))
    fm = ft.fit_features(df, numeric=["duration", "orig_pkts"], categorical=["proto", "service"])
    seqs = materialize(md.prepare_sequences(fm, df, ["ts", "uid"], keep=["uid"]).select("features", "label").coalesce(parts))
    return seqs, md.mlp(5 * fm.width, **params)


def test_network_fit_in_blocks_takes_the_steps_of_spark_ml(spark):
    seqs, own = _network(spark, hidden=4, max_iter=12)
    theirs = MultilayerPerceptronClassifier(featuresCol="features", labelCol="label", layers=own.getLayers(), seed=42, maxIter=12, blockSize=1000)
    a, b = own.fit(seqs), theirs.fit(seqs)
    first = theirs.copy({theirs.maxIter: 0}).fit(seqs).weights.toArray()
    assert type(a) is type(b) and (a.getMaxIter(), a.getSeed()) == (12, 42)
    assert np.abs(a.weights.toArray() - b.weights.toArray()).max() < 1e-6 < np.abs(a.weights.toArray() - first).max()


def test_network_fit_holds_a_row_of_overlapping_windows_once(spark):
    seqs, own = _network(spark)
    blocks = own._blocks(seqs).collect()
    row = 8 * own.getLayers()[0] // 5
    assert sum(r["n"] for r in blocks) == 296
    assert sum(len(r["rows"]) for r in blocks) == (296 + 4 * len(blocks)) * row


def test_packed_windows_come_back_whole_whatever_their_order():
    rng = np.random.default_rng(3)
    x = np.lib.stride_tricks.sliding_window_view(rng.normal(size=(40, 3)), 5, axis=0).transpose(0, 2, 1).reshape(-1, 15)
    for own in (x, x[rng.permutation(len(x))], np.repeat(x, 2, axis=0), np.vstack([x[:7], x[20:]]), x[:1], np.zeros((9, 15))):
        rows, starts = network.packed(own, 5)
        assert np.array_equal(network.unpacked(rows, starts, 5), own)
    assert len(network.packed(x, 5)[0]) == 40 and len(network.packed(x, 1)[0]) == len(x)


def test_network_fit_does_not_depend_on_partitions_or_pieces(spark):
    seqs, own = _network(spark, hidden=3, max_iter=8)
    one = own.fit(seqs).weights.toArray()
    many = own.copy({own.blockSize: 7}).fit(seqs.repartition(5)).weights.toArray()
    assert np.abs(one - many).max() < 1e-6


def test_network_fitted_in_blocks_is_saved_and_scored(spark, tmp_path):
    seqs, own = _network(spark, hidden=3, max_iter=3)
    m = md.fit_timed("mlp", own, seqs).model
    md.save_model(m, str(tmp_path / "network"))
    again = md.load_model(str(tmp_path / "network"))
    assert m.transform(seqs).select("probability").collect() == again.transform(seqs).select("probability").collect()


def test_windows_of_the_network_are_not_written_before_its_fit(spark, monkeypatch):
    df = _data(spark, 60)
    fm = ft.fit_features(df, numeric=["duration"], categorical=["proto"])
    written = []
    monkeypatch.setattr(md, "materialize", lambda rows, enabled=True: (written.append(enabled), materialize(rows, enabled))[1])
    assert md.training_inputs("mlp_seq", fm, df, 1.0, ["ts", "uid"], "uid").count() == 56
    md.training_inputs("rf", fm, df, 1.0, ["ts", "uid"], "uid")
    monkeypatch.setattr(md, "DENSE_WIDTH", 0)
    md.training_inputs("mlp_seq", fm, df, 1.0, ["ts", "uid"], "uid")
    assert written == [False, True, True]


def test_support_has_every_candidate(spark, monkeypatch):
    sf, real = "/root/testdata/sf0.001", md.estimator
    fitted, rows = [], {}
    monkeypatch.setattr(md, "estimator", lambda name, fm, small=False: (fitted.append(name), real(name, fm, True))[1])
    for r in chrono(spark, sf).orderBy("ts", "uid").select("split", "y").collect():
        rows.setdefault(r["split"], []).append(r["y"])
    want = {(m, d): (sum(y), len(y) - sum(y)) for m in ("gbt", "rf", "mlp_seq") for d, y in (
        (d, rows[s][4 if m == "mlp_seq" else 0:]) for d, s in (("A", "test"), ("B", "cal")))}
    got = queries.q_candidate_support(spark, sf).collect()
    assert {(r["model"], r["dataset"]): (r["attacks"], r["benign"]) for r in got} == want and len(got) == 6
    assert fitted == ["gbt", "rf", "mlp_seq"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
    assert {(m, d): (a, b) for m, d, a, b in con.execute(queries.ORACLE["candidate_support"]).fetchall()} == want
