import hashlib
import random

import pytest

from flowlens.llm import edit_embedding as e
from flowlens.llm import queries

from .conftest import SF, make_docs, rows_of


def walk(text):
    t, out = 0, []
    for ch in text:
        kind = (ord(ch) if ord(ch) < 128 else ord(ch) * 31 & 0xFFFFFFFF) & (e.KINDS - 1)
        n = int(e.STAYS[kind * e.PERIOD + t % e.PERIOD])
        out += [ch] * n
        t += n
    return out


def brute(text):
    y = walk(text)
    level = max(0, len(y) - 1).bit_length()
    return f"{level:02x}:" + "".join(
        "0123456789abcdef"[(ord(y[s]) * 2654435761 & 0xFFFFFFFF) >> 28] if s < len(y) else "." for s in e.STEPS[level])


def test_fingerprints_equal_the_walk_done_by_hand(words):
    r = random.Random(4)
    texts = ["", "a", "ab", "aaaa", "漢字 😀", *(" ".join(r.choice(words) for _ in range(n)) for n in (1, 5, 40, 200, 900))]
    assert e.fingerprints_of(texts) == [brute(t) for t in texts]
    assert e.fingerprints_of(texts[::-1]) == [brute(t) for t in texts[::-1]]


def test_sampled_steps_are_nested():
    for level in range(1, 40):
        own, lower = set(e.STEPS[level].tolist()), set(e.STEPS[level - 1].tolist())
        assert {s for s in own if s < 1 << (level - 1)} <= lower
        assert max(own) < 1 << level and len(own) <= e.SAMPLES


def test_likeness_falls_with_the_edits(words):
    r = random.Random(8)
    text = " ".join(r.choice(words) for _ in range(2000))

    def change(n):
        y = list(text)
        for _ in range(n):
            j, kind = r.randrange(len(y)), r.random()
            if kind < 0.4:
                y[j] = "#"
            elif kind < 0.7:
                y.insert(j, "+")
            else:
                del y[j]
        return "".join(y)

    own, few, some, many, other = e.fingerprints_of([text, change(2), change(200), change(2000), " ".join(r.choice(words) for _ in range(2000))])
    assert e.likeness(own, own) == 1.0
    assert e.likeness(own, few) > 0.9 > e.likeness(own, some) > e.likeness(own, many) > 0.02
    assert e.likeness(own, other) < 0.3
    assert e.likeness(own, few) == e.likeness(few, own)
    assert e.likeness(e.fingerprints_of([""])[0], e.fingerprints_of([""])[0]) == 1.0


def expected(rows):
    rows = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1] or "", x[1] is not None))
    out = []
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + after[:half]
        a, b, c = e.fingerprints_of([text, new, after])
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), a, b, e.likeness(a, b), e.likeness(a, c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_edits_follow_the_order_of_ids(spark, edge_rows, partitions):
    # rows of one id that differ in being null or empty are the same text to the order
    rows = [x for x in edge_rows if x[0] is not None]
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert rows_of(e.with_edits(make_docs(spark, rows).repartition(5))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_null_ids_come_last_and_all_null_ids_work(spark):
    rows = [(1, "first text of all"), (None, "nameless"), (2, "second text here"), (None, "an unnamed one")]
    assert rows_of(e.with_edits(make_docs(spark, rows))) == expected(rows)
    rows = [(None, "b b b b"), (None, "a a a a a"), (None, None)]
    got = rows_of(e.with_edits(make_docs(spark, rows)))
    assert len(got) == 3
    assert rows_of(e.with_edits(make_docs(spark, [(4, "alone it is")]))) == expected([(4, "alone it is")])


def test_empty_table(no_docs):
    assert e.with_edits(no_docs).count() == e.fingerprints(no_docs).count() == e.near_classes(no_docs).count() == 0


def test_near_classes(spark, words):
    r = random.Random(12)
    rows = []
    for k in range(12):
        text = " ".join(r.choice(words) for _ in range(300))
        for j in range(6):
            y = list(text)
            for _ in range(j % 3):
                y[r.randrange(len(y))] = "#"
            rows.append((len(rows), "".join(y)))
    rows += [(500, None), (501, ""), (502, "short")]
    prints, root = e.fingerprints_of([t or "" for _, t in rows]), list(range(len(rows)))
    for i in range(len(rows)):  # all pairs, by the same likeness
        for j in range(i):
            if e.likeness(prints[i], prints[j]) >= e.NEAR and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    assert len(set(root)) < 30
    got = {x["doc_id"]: x["class_id"] for x in e.near_classes(make_docs(spark, rows)).collect()}
    assert got == {i: rows[r][0] for (i, _), r in zip(rows, root)}


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(queries.op8_edit_fingerprints(spark, SF)) == expected(rows)
