import math
import random

import numpy as np
import pytest

from flowlens.llm import hard_negatives as hn
from flowlens.llm.base import scratch
from tests.llm.conftest import rows_of

DDL = "vec_id bigint, embedding array<float>, label int, q string, leaf int, score string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 3, "y", 1) for i, v, label in rows], DDL)


def plain(rows):
    own = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        own.append((i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for a, la, qa in own:
        if a is None or a % 50:
            continue
        scored = [(sum(x * y for x, y in zip(qa, q)), i, label) for i, label, q in own]
        for ps, p, _ in sorted((s for s in scored if s[2] == la and s[1] != a), key=order)[:5]:
            fits = sorted((s for s in scored if s[2] != la and 50 * ps <= 100 * s[0] <= 95 * ps), key=order)[:3]
            out += [(a, p, rank, n, ps, ns) for rank, (ns, n, _) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def near(r, centre, spread):
    return [c + r.gauss(0, spread) for c in centre]


@pytest.fixture(scope="module")
def vectors():
    r = random.Random(3)
    centres = [[r.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, near(r, centres[i % 12], 0.3), r.randrange(10)) for i in range(600)]
    copies = [(1000 + i, list(centres[0]), i % 10) for i in range(300)]
    odd = [(2000, None, 1), (2050, [1.0] * 8, None), (2100, [float("nan")] + [1.0] * 7, 1), (2150, [float("inf")] * 8, 1), (2200, [None] + [1.0] * 7, 2),
           (2250, [], 3), (2300, [0.0] * 8, 4), (2350, [1.0, -2.0], 5), (None, [0.5] * 8, 6), (None, centres[3], 6), rows[50], rows[50], rows[100],
           (150, centres[5], 2)]
    return rows + copies + odd


def test_equals_the_contract(spark, vectors):
    found = hn.mine(table(spark, vectors))
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert rows_of(found) == plain(vectors)


@pytest.mark.parametrize("leaf_rows, block", [(20, 7), (100, 2048), (5, 2048)])
def test_any_tree_and_block_gives_the_same(spark, vectors, leaf_rows, block, monkeypatch):
    monkeypatch.setattr(hn, "FANOUT", 4)
    assert rows_of(hn.mine(table(spark, vectors), leaf_rows=leaf_rows, block=block)) == plain(vectors)


def test_intervals_hold_every_row_and_miss_some_leaves(spark, vectors):
    own = hn.participants(table(spark, vectors))
    index = hn.build_index(own, scratch(spark, "tiles"), leaf_rows=20, tile_rows=16)
    tree, rows = index.tree, {}
    for t in index.tiles(spark).collect():
        assert len(t["ids"]) <= 16
        rows.setdefault(t["leaf"], []).append(np.frombuffer(t["vectors"], "<i8").reshape(-1, tree.width))
    assert sum(len(x) for part in rows.values() for x in part) == own.count()
    anchors = np.concatenate([part[0][:1] for part in rows.values()])
    at = np.column_stack([anchors, np.zeros(len(anchors))]).astype(float)
    to_points = [tree.distances(n, at) for n in range(len(tree.points))]
    apart = 0
    for leaf, parts in rows.items():
        x = tree.place(np.concatenate(parts))
        d = np.sqrt(((at[:, None] - x) ** 2).sum(axis=2))
        low, high = tree.interval(leaf, to_points)
        assert (low <= d.min(axis=1) + 1e-6).all() and (high >= d.max(axis=1) - 1e-6).all()
        apart += (low > np.quantile(d, 0.5)).sum()
    assert apart > 0


def test_copies_without_end_are_tiled(spark):
    rows = [(i, [0.5, 0.25], i % 3) for i in range(3000)] + [(5000 + i, [0.4, 0.2 + i / 1000], 4) for i in range(40)]
    index = hn.build_index(hn.participants(table(spark, rows)), scratch(spark, "tiles"), leaf_rows=50)
    assert max(len(t["ids"]) for t in index.tiles(spark).collect()) <= hn.TILE_ROWS
    assert rows_of(hn.mine(table(spark, rows), leaf_rows=50)) == plain(rows)


def test_empty_tables_and_large_numbers(spark):
    assert hn.mine(table(spark, [])).count() == 0
    assert hn.mine(table(spark, [(50, None, 1), (100, [1.0], None)])).count() == 0
    large = [(50 * i, [2.0**20 + i, 3.0 * i], i % 2) for i in range(12)]
    assert rows_of(hn.mine(table(spark, large), leaf_rows=2)) == plain(large)
