"""The reference's tasks from end to end: train, save, another session, evaluate, ablation, stream."""

import functools

from pyspark.sql import functions as F

from flowlens.plans import entrypoints as ep
from flowlens.plans import views
from flowlens.schema import PACKET
from flowlens.sources import sinks
from flowlens.streaming import live

SF = "/root/testdata/sf0.001"


def test_train_save_load_evaluate_and_stream(spark, tmp_path):
    log = views.conn_view(spark, SF)
    part = F.crc32(F.col("uid").cast("binary")) % 4
    paths = {}
    for name, keep in (("train", part < 2), ("a", part == 2), ("b", part == 3)):
        paths[name] = f"{tmp_path}/{name}"
        sinks.write_split(log.where(keep), paths[name])
    card, fm, trained = ep.train_and_select(spark, paths["train"], paths["a"], paths["b"], f"{tmp_path}/model", which=("rf", "mlp_seq"))
    rows = card.collect()
    assert {(r["model"], r["dataset"]) for r in rows} == {(m, d) for m in ("rf", "mlp_seq") for d in ("train", "A", "B")}

    later = spark.newSession()
    fm2, name, model = ep.load_winner(later, f"{tmp_path}/model")
    assert fm2 == fm and [r["model"] for r in rows if r["selected"]] == [name] * 3

    packets = views.packet_view(spark, SF).select([f.name for f in PACKET.fields])
    flows = live.live_flows(packets, "1 day")
    sequence = trained["mlp_seq"].model
    for winner in (ep.md.Scorer(fm2, "mlp_seq", sequence), ep.md.Scorer(fm2, "rf", trained["rf"].model)):
        evaluated = ep.evaluate_model(spark, winner, paths["a"], paths["b"], flows, ["10.0.0.7"])
        assert {"A", "B", "live"} <= set(evaluated.columns) and evaluated.count() > 0
        both = ep.evaluate_model(spark, winner, paths["a"], paths["b"])
        assert {(r["model"], r["dataset"]) for r in both.collect()} == {("final", "A"), ("final", "B")}
        t = ep.md.TREE_T if winner.name == "rf" else ep.md.SEQUENCE_T
        rows = {r["metric"]: r["A"] for r in evaluated.collect()}
        assert rows["recall"] == both.where("dataset = 'A'").first()["recall"] and t in (0.5, 0.9)
    report = ep.ablation_study(spark, paths["train"], paths["a"], family="rf")
    assert report.count() == 5

    by_rows = live.fitted_live_alerts(flows, fm2, trained["rf"].model, 0.5, rows=True)
    by_windows = live.fitted_live_alerts(flows, fm2, sequence, 0.5)
    n = flows.count()
    assert by_rows.count() == by_windows.count() == n
    assert by_windows.where((F.col("seq_pos") < 4) & (F.col("pred") == 1)).count() == 0

    packets.write.parquet(f"{tmp_path}/packets")
    stream = live.start_alert_stream(sinks.packet_stream(spark, f"{tmp_path}/packets"), f"{tmp_path}/alerts", window="1 day",
                                     alerts_of=functools.partial(live.fitted_live_alerts, fm=fm2, model=sequence, t=0.5),
                                     trigger_once=True)
    stream.awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/alerts")
    last = flows.agg(F.max("window_start")).first()[0]
    want = by_windows.where(F.col("window_start") < F.lit(last))
    cols = ["first_seq", "pred", "status"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))

    # the saved winner, loaded by a later session, detects live whatever its family
    loaded = ep.load_winner(later, f"{tmp_path}/model")
    ep.live_detection(later, f"{tmp_path}/packets", f"{tmp_path}/found", loaded, window="1 day", once=True).awaitTermination(120)
    t = ep.md.threshold_of(loaded.name, "live")
    want = live.fitted_live_alerts(flows, fm2, loaded.model, t, rows=not loaded.windows).where(F.col("window_start") < F.lit(last))
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/found").select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
