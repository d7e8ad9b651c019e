import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import FIXTURE_PACKETS, PACKET_DDL
from flowlens.operators.flows import aggregate_flows


def _flows(spark, rows, **kw):
    df = spark.createDataFrame(rows, PACKET_DDL)
    return {r["first_seq"]: r.asDict() for r in aggregate_flows(df, **kw).collect()}


def test_fixture_one_batch(spark):
    f = _flows(spark, FIXTURE_PACKETS)
    assert sorted(f) == [1, 6, 7, 11]          # packets 9 ('other') and 10 (no IP) dropped
    a = f[1]
    assert (a["src_ip"], a["sport"], a["proto"]) == ("10.0.0.1", 50000, "tcp")
    assert abs(a["duration"] - 0.05) < 1e-9 and a["start_time"] == 100.0
    assert (a["orig_pkts"], a["orig_bytes"], a["orig_ip_bytes"]) == (3, 100, 280)
    assert (a["resp_pkts"], a["resp_bytes"], a["resp_ip_bytes"]) == (2, 200, 320)
    assert (a["history"], a["conn_state"], a["service"]) == ("sadDs", "SF", "http")
    b = f[6]
    assert (b["history"], b["conn_state"], b["service"], b["resp_pkts"]) == ("s", "S0", "-", 0)
    c = f[7]
    assert (c["sport"], c["dport"], c["history"], c["conn_state"]) == (0, 0, "sa", "SF")
    assert abs(c["duration"] - 0.01) < 1e-9
    d = f[11]
    assert (d["orig_pkts"], d["orig_bytes"], d["orig_ip_bytes"], d["resp_pkts"]) == (1, 10, 70, 0)
    assert (d["history"], d["conn_state"], d["service"]) == ("d", "OTH", "dns")


def test_fixture_one_second_windows(spark):
    f = _flows(spark, FIXTURE_PACKETS, window="1 second")
    assert sorted(f) == [1, 5, 6, 7, 11]      # late packet 5 makes its own flow in second 99
    assert f[5]["history"] == "s" and f[5]["orig_pkts"] == 1
    assert f[1]["history"] == "sadD" and f[1]["orig_pkts"] == 2


def test_history_cut_after_state(spark):
    # 10 data packets from the initiator, then a zero-payload reply as the 11th letter
    rows = [(i, 100.0 + i / 100, "10.1.1.1", "10.1.1.2", "tcp", 4000, 80, 10, 70) for i in range(1, 11)]
    rows[0] = (1, 100.0, "10.1.1.1", "10.1.1.2", "tcp", 4000, 80, 0, 60)      # 's' first
    rows.append((11, 100.2, "10.1.1.2", "10.1.1.1", "tcp", 80, 4000, 0, 60))  # 'a' 11th
    f = _flows(spark, rows)[1]
    assert f["history"] == "s" + "d" * 9 and len(f["history"]) == 10
    assert f["conn_state"] == "SF"


def test_rank_and_slot_plans_agree(spark):
    random.seed(7)
    rows = []
    for i in range(400):
        a, b = random.randint(1, 6), random.randint(1, 6)
        rows.append((i, 10.0 + i * 0.01, f"10.0.0.{a}", f"10.0.0.{b}", random.choice(["tcp", "udp", "icmp"]),
                     random.choice([80, 53, 1234]), random.choice([80, 443, 999]),
                     random.choice([0, 0, 10]), 60))
    random.shuffle(rows)
    r = _flows(spark, rows, history_plan="rank")
    c = _flows(spark, rows, history_plan="slots")
    assert r == c


packet = st.tuples(st.integers(1, 4), st.integers(1, 4), st.sampled_from(["tcp", "udp", "icmp", "other"]),
                   st.sampled_from([1, 2]), st.sampled_from([1, 2]), st.integers(0, 3))


@settings(max_examples=4, deadline=None)
@given(st.lists(packet, min_size=1, max_size=40), st.randoms())
def test_totals_and_shuffle_invariance(spark, pkts, rnd):
    rows = [(i, float(i), f"h{a}", f"h{b}", pr, sp, dp, pl, 40 + pl)
            for i, (a, b, pr, sp, dp, pl) in enumerate(pkts)]
    kept = [r for r in rows if r[4] != "other"]
    df = spark.createDataFrame(rows, PACKET_DDL)
    out = aggregate_flows(df).agg(F.sum(F.col("orig_pkts") + F.col("resp_pkts")).alias("p"),
                                  F.sum(F.col("orig_ip_bytes") + F.col("resp_ip_bytes")).alias("b")).first()
    assert (out["p"] or 0) == len(kept)
    assert (out["b"] or 0) == sum(r[8] for r in kept)
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    assert _flows(spark, shuffled) == _flows(spark, rows)


def test_flags_proto_key_and_missing_service(spark):
    rows = [(1, 1.0, "10.0.0.1", "10.0.0.2", "tcp", 1000, 2000, 0, 60),
            (2, 1.1, "10.0.0.1", "10.0.0.2", "udp", 1000, 2000, 5, 65),
            (3, 1.2, "10.0.0.2", "10.0.0.1", "tcp", 2000, 1000, 0, 60)]
    assert len(_flows(spark, rows)) == 1                      # endpoint pair only (reference)
    f = _flows(spark, rows, key_includes_proto=True)
    assert sorted(f) == [1, 2]
    assert (f[1]["history"], f[1]["conn_state"]) == ("sa", "SF") and f[2]["history"] == "d"
    assert all(v["service"] == "unknown" for v in _flows(spark, rows, missing_service="unknown").values())
