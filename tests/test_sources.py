import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T


from flowlens.operators import features as ft
from flowlens.operators import models as md
from flowlens.sources import connlog, sinks

HEADER = ("ts\tuid\tid.orig_h\tid.orig_p\tid.resp_h\tid.resp_p\tproto\tservice\tduration\torig_bytes\t"
          "resp_bytes\tconn_state\tlocal_orig\tlocal_resp\tmissed_bytes\thistory\torig_pkts\torig_ip_bytes\t"
          "resp_pkts\tresp_ip_bytes\ttunnel_parents\tlabel\tdetailed-label")
ROWS = [
    "1545403550.04\tCa\t192.168.1.1\t123\t10.0.0.1\t23\ttcp\t\t2.5\t48.0\t0.0\tS0\t\t\t0\tS\t1\t60\t0\t0\t\tMalicious\tDDoS",
    "1545403551.10\tCb\t192.168.1.1\t124\t10.0.0.2\t80\ttcp\thttp\t\t\t\tSF\t\t\t5792\tShAdDaf\t5\t300\t4\t400\t\tBenign\t",
    "1545403552.00\tCc\t192.168.1.2\t125\t10.0.0.3\t53\tudp\tdns\t-\t-\t-\tOTH\t\t\t0\tD\t1\t70\t0\t0\t\t\t",
]


def test_read_conn_log(spark, tmp_path):
    p = tmp_path / "conn.log"
    p.write_text(HEADER + "\n" + "\n".join(ROWS) + "\n")
    df = connlog.read_conn_log(spark, str(p))
    rows = df.orderBy("ts").collect()
    assert df.columns[2] == "orig_h" and len(rows) == 3
    assert rows[0]["orig_bytes"] == 48.0 and rows[0]["service"] is None
    assert rows[1]["duration"] is None and rows[1]["missed_bytes"] == 5792
    assert rows[2]["duration"] is None and rows[2]["label"] is None


def test_read_zeek_raw(spark, tmp_path):
    p = tmp_path / "raw.log"
    p.write_text("#separator \\x09\n#fields\tts\tuid\tid.orig_h\tproto\tduration\n"
                 "#types\ttime\tstring\taddr\tenum\tinterval\n"
                 "1.5\tC1\t10.0.0.1\ttcp\t0.25 # trailing comment\n"
                 "2.5  C2 10.0.0.2   udp -\n#close\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("ts", T.DoubleType()), T.StructField("duration", T.DoubleType())])
    df = connlog.read_zeek(spark, str(p), schema=schema)
    rows = df.orderBy("ts").collect()
    assert df.columns == ["ts", "uid", "orig_h", "proto", "duration"]
    assert rows[0]["duration"] == 0.25 and rows[1]["duration"] is None and rows[1]["proto"] == "udp"
    assert connlog.read_zeek(spark, str(p), max_rows=1).count() == 1
    q = tmp_path / "nohdr.log"
    q.write_text("a b c\nd e\n")
    assert connlog.read_zeek(spark, str(q)).columns == ["c0", "c1", "c2"]


def test_write_split_roundtrip_and_manifest(spark, tmp_path):
    p = tmp_path / "conn.log"
    p.write_text(HEADER + "\n" + "\n".join(ROWS) + "\n")
    df = connlog.read_conn_log(spark, str(p)).withColumn("is_benign", connlog.F.lit(True))
    out = str(tmp_path / "split_tsv")
    sinks.write_split(df, out, fmt="tsv")
    back = connlog.read_conn_log(spark, out)
    assert back.count() == 3 and "is_benign" not in back.columns
    pq = str(tmp_path / "split_pq")
    sinks.write_split(df, pq, fmt="parquet")
    m = sinks.manifest(spark, {"pq": pq}).collect()
    assert sum(r["rows"] for r in m) == 3 and all(r["bytes"] > 0 for r in m)


def test_pipeline_persistence(spark, tmp_path):
    rows = [(float(i), float(i % 3) if i % 4 else None, "tcp" if i % 2 else None, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "duration double, orig_bytes double, proto string, y int")
    fm = ft.fit_features(df, numeric=["duration", "orig_bytes"], categorical=["proto"])
    assert sorted(map(tuple, fm.vocabulary.collect())) == [("proto", "tcp", 0), ("proto", "unknown", 1)] and fm.width == 4
    path = str(tmp_path / "prep")
    fm.save(spark, path)
    a = fm.transform(df).select("features").collect()
    b = ft.FeatureModel.load(spark, path).transform(df).select("features").collect()
    assert a == b
    unseen = spark.createDataFrame([(1.0, 1.0, "icmp", 0)], df.schema)
    v = fm.transform(unseen).first()["features"].toArray()
    assert list(v[2:]) == [0.0, 0.0]


def test_csv_split_and_scorecard_sink(spark, tmp_path):
    p = tmp_path / "val.csv"
    p.write_text(HEADER.replace("\t", ",") + "\n" + "\n".join(r.replace("\t", ",") for r in ROWS) + "\n")
    df = connlog.read_csv_split(spark, str(p))
    assert df.count() == 3 and df.orderBy("ts").first()["orig_bytes"] == 48.0
    from flowlens.operators.metrics import scorecard
    scored = spark.createDataFrame([("m", 0.9, 1), ("m", 0.2, 0)], "model string, score double, y int")
    out = str(tmp_path / "card")
    sinks.write_scorecard(scorecard(scored, ["model"], threshold=0.5), out)
    back = spark.read.parquet(out).first()
    assert (back["tp"], back["tn"], back["f1"]) == (1, 1, 1.0)


def test_entrypoints_profile_and_calibration(spark, tmp_path):
    from flowlens.plans import entrypoints as ep
    body = []
    for i in range(60):
        lab = "Benign" if i % 3 else "Malicious"
        body.append(f"{1545403550 + i}.5\tC{i:03d}\t192.168.1.1\t{1000 + i}\t10.0.0.1\t23\ttcp\t\t1.0\t1.0\t0.0\t"
                    f"S0\t\t\t0\tS\t1\t60\t0\t0\t\t{lab}\t")
    p = tmp_path / "log.tsv"
    p.write_text(HEADER + "\n" + "\n".join(body) + "\n")
    prof = {r["split"]: r for r in ep.profile_splits(spark, {"cal": str(p)}).collect()}
    assert (prof["cal"]["benign"], prof["cal"]["attack"], prof["cal"]["class_ratio"]) == (40, 20, "1:2.00")
    assert prof["cal"]["severity"] == "Moderate Imbalance" and prof["cal"]["mb"] > 0
    out = str(tmp_path / "cal")
    ep.draw_calibration_set(spark, str(p), out, n_benign=12, n_attack=8)
    back = connlog.read_conn_log(spark, out)
    assert back.count() == 20 and "is_benign" not in back.columns


def test_columns_go_by_each_files_own_header(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    names = HEADER.split("\t")
    (folder / "a.log").write_text(HEADER + "\n" + ROWS[0] + "\n")
    order = list(range(len(names)))[::-1]
    (folder / "b.log").write_text("\t".join(names[i] for i in order) + "\r\n" + "\t".join(ROWS[1].split("\t")[i] for i in order) + "\r\n")
    rows = connlog.read_conn_log(spark, str(folder)).orderBy("ts").collect()
    assert [r["uid"] for r in rows] == ["Ca", "Cb"] and [r["resp_p"] for r in rows] == [23, 80]
    (folder / "c.log").write_text("ts\tuid\n1\tCc\n")
    with pytest.raises(ValueError, match="no column"):
        connlog.read_conn_log(spark, str(folder))


def test_null_markers_of_each_reader_and_rejects(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("ts,uid,label\n1.5,nan,NA\nx,-,\"a,b\"\n-,NULL,-\n")
    schema = T.StructType([T.StructField("ts", T.DoubleType()), T.StructField("uid", T.StringType()), T.StructField("label", T.StringType())])
    got = sorted(map(tuple, connlog.read_csv_split(spark, str(p), schema).collect()), key=repr)
    assert got == sorted([(1.5, None, None), (None, "-", "a,b"), (None, None, "-")], key=repr)
    text = connlog.read_table_text(spark, str(p), schema, sep=",")
    assert {r["column"]: r["rejected"] for r in connlog.rejected_values(text, schema).collect()} == {"ts": 2}


def test_raw_logs_with_different_fields(spark, tmp_path):
    folder = tmp_path / "zeek"
    folder.mkdir()
    (folder / "a.log").write_text("#fields\tts\tuid\n1\tCa\n")
    (folder / "b.log").write_text("#fields\tuid\tid.orig_h\tts\nCb\t10.0.0.1\t2\nCc\t-\t3\n")
    got = connlog.read_zeek(spark, str(folder)).orderBy("ts").select("ts", "uid", "orig_h").collect()
    assert [tuple(r) for r in got] == [("1", "Ca", None), ("2", "Cb", "10.0.0.1"), ("3", "Cc", None)]


def test_repeated_headers_and_quoted_breaks_are_rows(spark, tmp_path):
    schema = T.StructType([T.StructField("ts", T.DoubleType()), T.StructField("uid", T.StringType()), T.StructField("label", T.StringType())])
    (tmp_path / "a b.csv").write_text('ts,uid,label\n1,Ca,"Benign\nor, so"\nts,uid,label\n2,"say ""hi""",x\n')
    (tmp_path / "c[1].csv").write_text("ts,uid,label\n3,Cc,y\n4,Cd\n")
    (tmp_path / "d.csv").write_text("label,uid,ts\nz,Ce,5\n")
    (tmp_path / "empty.csv").write_text("")
    got = sorted(map(tuple, connlog.read_csv_split(spark, str(tmp_path), schema).collect()), key=repr)
    assert got == sorted([(1.0, "Ca", "Benign\nor, so"), (None, "uid", "label"), (2.0, 'say "hi"', "x"), (3.0, "Cc", "y"), (4.0, "Cd", None),
                          (5.0, "Ce", "z")], key=repr)
    assert connlog.read_csv_split(spark, str(tmp_path / "empty.csv"), schema).count() == 0


def test_no_exchange_of_lines_in_a_large_file(spark, tmp_path):
    """The plan of a file beyond the broadcast limit, in many splits: a scan and a projection."""
    path, limits = str(tmp_path / "big"), {"spark.sql.autoBroadcastJoinThreshold": "10k", "spark.sql.files.maxPartitionBytes": "64k"}
    before = {k: spark.conf.get(k) for k in limits}
    rows = spark.range(20_000, numPartitions=1).select(*[F.lit(None).cast("string").alias(c) if c not in ("ts", "uid") else F.col("id").alias(c)
                                                         for c in HEADER.split("\t")])
    sinks.write_split(rows, path)
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        df = connlog.read_conn_log(spark, path)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan and df.rdd.getNumPartitions() > 5
        assert df.agg(F.count("uid"), F.sum("ts")).first()[:] == (20_000, 20_000 * 19_999 / 2)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
