import random

import numpy as np
import pytest
import xxhash

from flowlens.llm import components as c
from flowlens.llm import queries, simhash

from .conftest import SF, make_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    words = [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace(
        "\f", " ").split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=2):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    f = np.array(prints, np.uint64)
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


def test_query_equals_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in queries.op7_simhash(spark, SF).collect()}
    prints = [brute_print(t) for _, t in docs]
    roots = brute_components(prints)
    assert {i: (got[i]["fingerprint"], got[i]["component_id"]) for i, _ in docs} == {
        docs[k][0]: (f"{prints[k]:016x}", docs[roots[k]][0]) for k in range(len(docs))}


@pytest.mark.parametrize("n,tile", [(300, 2048), (300, 20), (300, 3), (1, 8)])
def test_links_at_any_tile_size(spark, n, tile):
    r = random.Random(n + tile)
    centres = [r.getrandbits(64) for _ in range(n // 6 + 1)]
    prints = sorted({x ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) if r.random() < 0.7 else x for x in centres for _ in range(6)})
    df = spark.createDataFrame([(i, int(np.uint64(x).view(np.int64))) for i, x in enumerate(prints)], "doc_id bigint, fp bigint")
    got = {r["doc_id"]: r["component_id"] for r in simhash.classes(df, tile=tile).collect()}
    assert [got[i] for i in range(len(prints))] == brute_components(prints)


def test_tile_steps_cover_all_differences_within_the_radius():
    r = random.Random(3)
    for k in (1, 2, 4, 8, 16):
        w, base = 64 // k, 64 // k + 5
        steps = set(simhash.tile_steps(k, 2))

        def code(x):
            return sum(((x >> (i * w)) & ((1 << w) - 1)).bit_count() * base**(k - 1 - i) for i in range(k))

        for _ in range(200):
            x = r.getrandbits(64)
            y = x ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))
            assert abs(code(x) - code(y)) in steps


def test_a_hot_group_of_near_copies(spark):
    centre = 0x0123456789ABCDEF
    prints = sorted({centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)})
    df = spark.createDataFrame([(i, int(np.uint64(x).view(np.int64))) for i, x in enumerate(prints)], "doc_id bigint, fp bigint")
    assert {r["component_id"] for r in simhash.classes(df, tile=64).collect()} == {0}


def test_edge_rows(spark, edge_docs, edge_rows):
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(edge_docs).collect()), key=repr)
    prints = [brute_print(t) for _, t in edge_rows]
    roots, smallest = brute_components(prints), {}
    for (i, _), root in zip(edge_rows, roots):
        if i is not None:
            smallest[root] = min(i, smallest.get(root, i))
    assert got == sorted(((i, f"{p:016x}", smallest.get(root)) for (i, _), p, root in zip(edge_rows, prints, roots)), key=repr)


def test_one_row_of_each_group_stays(spark, edge_docs, edge_rows):
    kept = simhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    prints = [brute_print(t) for _, t in edge_rows]
    roots = brute_components(prints)
    assert len(got) == len(set(roots))
    assert sorted(brute_print(t) for _, t in got) == sorted({p: 0 for p in (prints[k] for k in {
        root: min((k for k in range(len(roots)) if roots[k] == root), key=lambda k: (edge_rows[k][0] is None, edge_rows[k][0] or 0))
        for root in roots}.values())})


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(200, 200), (201, None), (300, 299), (299, 300)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in c.components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {299: 299, 300: 299}


def test_text_without_words_and_short_texts():
    for t in ("", " \t\n", "one", "one two", "A b\x0bC d", "x y z"):
        assert simhash.fingerprint(t) == brute_print(t)


def test_null_text_is_kept_null(spark):
    kept = simhash.drop_near_duplicates(make_docs(spark, [(1, None), (2, ""), (3, "words here")]))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, None), (3, "words here")]
