import os

from pyspark.sql import functions as F

from flowlens.operators import sequences as sq
from flowlens.schema import PACKET
from flowlens.sources import sinks
from flowlens.streaming import live


def _packets(spark, rows):
    df = spark.createDataFrame(rows, "arrival_seq long, t double, src_ip string, dst_ip string, proto string, "
                                     "sport int, dport int, payload_len int, pkt_len int")
    return df.select("arrival_seq", F.timestamp_seconds("t").alias("ts"), *df.columns[2:])


def _rows(second, base):
    out = []
    for k in range(7):
        c = f"10.0.0.{k}"
        out.append((base + 2 * k, second + 0.01 * k, c, "10.0.1.1", "tcp", 40000 + k, 80, 0, 60))
        out.append((base + 2 * k + 1, second + 0.01 * k + 0.005, "10.0.1.1", c, "tcp", 80, 40000 + k, 10 * k, 60 + 10 * k))
    return out


def _write(spark, rows, path):
    _packets(spark, rows).select([f.name for f in PACKET.fields]).write.mode("append").parquet(path)


def test_stream_equals_batch_minus_open_window(spark, tmp_path):
    src = str(tmp_path / "pk")
    rows = _rows(100, 0) + _rows(101, 100) + _rows(102, 200)
    _write(spark, rows, src)
    stream = live.stream_flows(sinks.packet_stream(spark, src), "1 second", "0 seconds")
    q = (stream.drop("window").writeStream.format("memory").queryName("flows_s").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck1")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r["first_seq"], r["history"], r["orig_pkts"]) for r in spark.table("flows_s").collect()}
    batch = live.live_flows(spark.read.parquet(src), "1 second")
    want = {(r["first_seq"], r["history"], r["orig_pkts"]) for r in
            batch.where(F.col("window_start") < F.timestamp_seconds(F.lit(102))).collect()}
    assert got == want and len(got) == 14


def test_stream_alerts_late_row_and_restart(spark, tmp_path):
    src, out = str(tmp_path / "pk"), str(tmp_path / "alerts")
    _write(spark, _rows(100, 0) + _rows(101, 100) + _rows(102, 200), src)
    model = sq.logistic_model([0.4, -0.3], -0.2)

    def run():
        q = live.start_alert_stream(sinks.packet_stream(spark, src), out, model, 0.5,
                                    ["orig_pkts", "resp_pkts"], "1 second", "0 seconds",
                                    whitelist=["10.0.0.3"], checkpoint=str(tmp_path / "ck"),
                                    trigger_once=True)
        q.awaitTermination()

    run()
    first = spark.read.parquet(out)
    assert first.count() == 14
    batch = live.live_alerts(live.live_flows(spark.read.parquet(src), "1 second"), model, 0.5,
                             ["orig_pkts", "resp_pkts"], whitelist=["10.0.0.3"])
    want = {(r["first_seq"], r["pred"], r["status"]) for r in
            batch.where(F.col("window_start") < F.timestamp_seconds(F.lit(102))).collect()}
    assert {(r["first_seq"], r["pred"], r["status"]) for r in first.collect()} == want
    # a late packet for the closed second 100 is dropped; restarting adds no duplicates
    _write(spark, [(999, 100.5, "10.9.9.9", "10.0.1.1", "tcp", 1, 80, 0, 60)], src)
    run()
    again = spark.read.parquet(out)
    assert again.count() == 14 and again.where("first_seq = 999").count() == 0
    assert len(os.listdir(str(tmp_path / "ck"))) > 0


def test_state_of_a_flow_is_ten_letters_whatever_it_sends(spark, tmp_path):
    """Two closed windows and an open one, the flow of the last two with 100,000 packets."""
    def many(second, base, n):
        return spark.range(n).select(
            (F.lit(base) + F.col("id")).alias("arrival_seq"), F.timestamp_seconds(F.lit(second) + F.col("id") / (2 * n)).alias("ts"),
            F.when(F.col("id") % 3 == 0, "10.0.0.1").otherwise("10.0.1.1").alias("src_ip"),
            F.when(F.col("id") % 3 == 0, "10.0.1.1").otherwise("10.0.0.1").alias("dst_ip"), F.lit("tcp").alias("proto"),
            F.when(F.col("id") % 3 == 0, 4000).otherwise(80).cast("int").alias("sport"),
            F.when(F.col("id") % 3 == 0, 80).otherwise(4000).cast("int").alias("dport"),
            (F.col("id") % 4).cast("int").alias("payload_len"), F.lit(60).alias("pkt_len"))

    src, sizes = str(tmp_path / "pk"), {}
    for k, (second, n) in enumerate(((100, 20), (101, 100_000), (102, 100_000))):
        many(second, 10**6 * k, n).repartition(3).write.mode("append").parquet(src)
        q = (live.stream_flows(sinks.packet_stream(spark, src), "1 second", "0 seconds").drop("window").writeStream
             .format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        state = spark.read.format("statestore").load(str(tmp_path / "ck"))
        held = [f.name for f in state.schema["value"].dataType.fields if f.dataType.simpleString() == "binary"]
        assert len(held) == 1
        sizes[n, k] = [r[0] for r in state.select(F.octet_length(f"value.{held[0]}")).collect()]
    assert [len(x) for x in sizes.values()] == [1, 1, 1]
    assert len({x[0] for x in sizes.values()}) == 1 and sizes[100_000, 2][0] < 1000
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("first_seq", "history", "orig_pkts", "resp_pkts").collect()}
    batch = live.live_flows(spark.read.parquet(src), "1 second").where(F.col("window_start") < F.timestamp_seconds(F.lit(102)))
    assert got == {tuple(r) for r in batch.select("first_seq", "history", "orig_pkts", "resp_pkts").collect()} and len(got) == 2
    assert all(len(r[1]) == 10 for r in got)


def test_streamed_throughput_equals_batch_minus_open_window(spark, tmp_path):
    src = str(tmp_path / "pk")
    odd = [(900, 100.2, "10.0.0.1", "10.0.1.1", "arp", 0, 0, 0, 60), (901, 100.3, None, "10.0.1.1", "tcp", 1, 2, 0, 60),
           (902, 101.5, "10.0.0.1", "10.0.1.1", None, 0, 0, 0, 60), (903, 103.5, "10.0.0.1", "10.0.1.1", "arp", 0, 0, 0, 60)]
    _write(spark, _rows(100, 0) + _rows(101, 100) + _rows(102, 200) + odd + _rows(104, 300), src)
    q = (live.stream_throughput(sinks.packet_stream(spark, src)).writeStream.format("memory").queryName("throughput_s")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    batch = live.window_throughput(spark.read.parquet(src)).where(F.col("window_start") < F.timestamp_seconds(F.lit(104)))
    cols = ["window_start", "packets", "flows", "pkts_per_s"]
    got = sorted(tuple(r) for r in spark.table("throughput_s").select(cols).collect())
    assert got == sorted(tuple(r) for r in batch.select(cols).collect())
    assert [r[1:3] for r in got] == [(16, 7), (15, 7), (14, 7), (1, 0)]


def test_running_scorecard_equals_that_of_the_alerts_written(spark, tmp_path):
    src, out, bad = str(tmp_path / "pk"), str(tmp_path / "alerts"), ["10.0.0.2", "10.0.0.5"]
    model = sq.logistic_model([0.4, -0.3], -0.2)
    assert live.running_scorecard(spark, out).count() == 0
    for k, second in enumerate((100, 102, 104)):
        _write(spark, _rows(second, 200 * k) + _rows(second + 1, 200 * k + 100), src)
        live.start_alert_stream(sinks.packet_stream(spark, src), out, model, 0.5, ["orig_pkts", "resp_pkts"], trigger_once=True,
                                whitelist=["10.0.0.3"], attackers=bad).awaitTermination()
        written = spark.read.parquet(out)
        want = live.live_scorecard(written, bad).collect()
        card = live.running_scorecard(spark, out)
        assert [r.asDict() for r in card.collect()] == [r.asDict() for r in want]
        assert sum(want[0][c] for c in ("tp", "fp", "tn", "fn")) == written.count() == 14 * k + 7
    assert len(os.listdir(f"{out}/_totals")) == 2


def test_a_batch_run_again_counts_once(spark, tmp_path):
    out, bad = str(tmp_path / "alerts"), ["10.0.0.2"]

    def alerts(flows):
        return flows.select("src_ip", F.lit(0.5).alias("score"), F.lit(1).alias("pred"))

    write = live.alert_batch_writer(out, alerts, bad)
    one = spark.createDataFrame([("10.0.0.2", 1), ("10.0.0.3", 1)], "src_ip string, window int")
    for batch in (0, 0, 1, 1, 2):
        write(one if batch != 1 else one.limit(0), batch)
    r = live.running_scorecard(spark, out).collect()
    assert [(x["tp"], x["fp"], x["tn"], x["fn"]) for x in r] == [(2, 2, 0, 0)]
