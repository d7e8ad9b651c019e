import zlib

import pytest

from flowlens.llm import sharding

from .conftest import make_docs, rows_of


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 99, 100, 101, 257])
def test_permutation_and_its_inverse(n):
    places = [sharding.place_of(r, n, 4) for r in range(n)]
    assert sorted(slot * 4 + shard for shard, slot in places) == list(range(n))
    assert [sharding.row_at(*p, n, 4) for p in places] == list(range(n))


@pytest.mark.parametrize("n", [1, 3, 16, 17, 50])
def test_expressions_equal_the_plain_computation(spark, n):
    got = {r["i"]: r["p"] for r in sharding.permute(spark.range(n).withColumnRenamed("id", "i"), "i", n, "p").collect()}
    want = {r: slot * 3 + shard for r in range(n) for shard, slot in [sharding.place_of(r, n, 3)]}
    assert got == want


def test_edge_rows(spark, edge_docs, edge_rows):
    got = sharding.assignment(edge_docs).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in edge_rows), key=repr)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    sizes = [len(by_shard.get(s, ())) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by_shard.values())


def test_partitioning_and_order_of_input_do_not_matter(spark, edge_rows):
    a = rows_of(sharding.assignment(make_docs(spark, edge_rows)))
    b = rows_of(sharding.assignment(make_docs(spark, edge_rows[::-1]).repartition(7)))
    assert a == b


def test_seed_changes_the_order(spark):
    docs = make_docs(spark, [(i, str(i)) for i in range(50)])
    assert rows_of(sharding.shard(docs, seed=1)) != rows_of(sharding.shard(docs, seed=2))


def test_empty_table_and_native_plan(no_docs, edge_docs):
    assert sharding.assignment(no_docs).count() == 0
    plan = sharding.assignment(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
