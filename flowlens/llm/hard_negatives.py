"""Hard negatives: rows of another label whose score lies in a window below a positive's.

Scores are inner products of whole-number vectors q (each component x becomes floor(256 x)).
They are mapped to distances: with M the largest norm, a row stands at (q, sqrt(M^2 - |q|^2)) and
an anchor at (q, 0), so |anchor - row|^2 = |q_anchor|^2 + M^2 - 2 score, and a window of scores is
an annulus around the anchor.

Index: a multiway tree of hyperplanes.  A node has ``FANOUT`` split points, far apart, from a
sample of at most ``SAMPLE_ROWS`` rows; every row belongs to the subtree of its nearest split
point.  Each split point stores the range of its distances to the rows of every sibling
subtree, over all rows and not the sample.  By the triangle inequality an anchor's distances to
a sibling's rows lie in an interval that follows from that range; a subtree whose interval for
any split point misses the anchor's annulus is left out.  Leaves are exact: they hold the rows
in tiles of at most ``TILE_ROWS``, and scores there are products of whole numbers.

Jobs: one pass counts rows and finds M; a sample is taken; all rows are assigned to leaves and
range-partitioned by (leaf, a row number), so a leaf of any size is split; the tiles are written
and the ranges aggregated.  Anchors come in blocks of ``BLOCK_ANCHORS`` (what tasks are sent),
each against the tiles in three passes: the anchors' own leaves give their first positives a
score to beat, then all leaves that reach it are searched for positives, then all that the
windows meet for negatives.  A task emits a few rows for an anchor or pair, and Spark ranks them.

Cases: rows with a null label, a null vector or a null or non-finite component take no part;
vectors of unequal lengths are filled up with zeros; rows that share an anchor's vec_id are not
its positives; repeated rows count each, repeated anchors are answered each; rows without a
vec_id can be found (after all others of their score) but are no anchors.  Scores must fit in 63
bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.base import discard, scratch

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95                          # a window, in hundredths of the positive's score
ANCHOR_STEP, RELABEL_STEP, LABELS = 50, 7, 10
FANOUT, SAMPLE_ROWS, LEAF_ROWS, TILE_ROWS = 8, 8192, 2048, 1024
BLOCK_ANCHORS = 2048
LEAST = -(1 << 62)
TILE_DDL = "leaf int, ids array<bigint>, labels array<int>, vectors binary"


def participants(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, q) of the rows that take part, labels of every ``RELABEL_STEP``-th id moved."""
    own = rows.select(rows[id_col].cast("bigint").alias("vec_id"), rows[label_col].cast("int").alias("label"),
                      rows[vector_col].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))     # NaN is above infinity
    moved = F.when(F.col("vec_id") % RELABEL_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return own.where(F.col("label").isNotNull() & F.col("v").isNotNull() & finite).select(
        "vec_id", moved.alias("label"), F.transform("v", lambda x: F.floor(x * SCALE)).alias("q"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros to ``width``."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


@dataclass
class Tree:
    """Split points by node; ``child[node, i]`` is a node, or -1 - leaf.  ``near`` and ``far`` are the
    ranges of the distances from split point i to the rows of subtree j."""
    width: int
    norm2: float
    points: list[np.ndarray] = field(default_factory=list)
    child: list[np.ndarray] = field(default_factory=list)
    path: list[list[tuple[int, int]]] = field(default_factory=list)     # by leaf: (node, subtree) from the root
    near: list[np.ndarray] = field(default_factory=list)
    far: list[np.ndarray] = field(default_factory=list)

    def place(self, q: np.ndarray) -> np.ndarray:
        """Rows as points of norm M."""
        q = q.astype(np.float64)
        return np.column_stack([q, np.sqrt(np.maximum(self.norm2 - (q * q).sum(axis=1), 0))])

    def distances(self, node: int, x: np.ndarray) -> np.ndarray:
        p = self.points[node]
        square = (x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * (x @ p.T)
        return np.sqrt(np.maximum(square, 0))

    def grow(self, x: np.ndarray, leaf_rows: int, path: list[tuple[int, int]] = ()) -> int:
        """Split sample points until a leaf holds ``leaf_rows`` of them; the node or -1 - leaf."""
        path, points = list(path), spread(x, FANOUT) if len(x) > leaf_rows else x[:1]
        if len(points) < 2:
            self.path.append(path)
            return -len(self.path)
        node = len(self.points)
        self.points.append(points)
        self.child.append(np.zeros(len(points), np.int64))
        own = self.distances(node, x).argmin(axis=1)
        for j in range(len(points)):
            self.child[node][j] = self.grow(x[own == j], leaf_rows, [*path, (node, j)])
        return node

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """The leaf of each point, and by node the ranges of its split points to the points below."""
        leaf, ranges = np.zeros(len(x), np.int32), {}
        todo = [(0, np.arange(len(x)))] if self.points else []
        while todo:
            node, rows = todo.pop()
            d = self.distances(node, x[rows])
            k, own = d.shape[1], d.argmin(axis=1)
            near, far = np.full((k, k), np.inf), np.full((k, k), -np.inf)
            for j in np.unique(own):
                below = d[own == j]
                near[:, j], far[:, j] = below.min(axis=0), below.max(axis=0)
                to = self.child[node][j]
                if to < 0:
                    leaf[rows[own == j]] = -1 - to
                else:
                    todo.append((int(to), rows[own == j]))
            ranges[node] = near, far
        return leaf, ranges

    def interval(self, leaf: int, to_points: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor, the least and largest distance that its leaf's rows can have, by the
        distances ``to_points[node]`` from the anchors to the split points."""
        n = len(to_points[0]) if to_points else 1
        low, high = np.zeros(n), np.full(n, np.inf)
        for node, j in self.path[leaf]:
            d, near, far = to_points[node], self.near[node][:, j], self.far[node][:, j]
            low = np.maximum(low, np.maximum(d - far, near - d).max(axis=1))
            high = np.minimum(high, (d + far).min(axis=1))
        return low, high


def spread(x: np.ndarray, k: int) -> np.ndarray:
    """Up to ``k`` distinct points, each the farthest from those before."""
    chosen = [x[0]]
    gap = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < k and gap.max() > 1e-9:
        chosen.append(x[gap.argmax()])
        gap = np.minimum(gap, ((x - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


@dataclass
class Index:
    path: str
    tree: Tree
    exact: type             # in which products of vectors are exact

    def tiles(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(TILE_DDL).parquet(self.path)


def build_index(rows: DataFrame, path: str, leaf_rows: int = LEAF_ROWS, tile_rows: int = TILE_ROWS) -> Index:
    """Assign every row of (vec_id, label, q) to a leaf and write the tiles to ``path``."""
    spark = rows.sparkSession
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("width"), F.max(square).alias("norm2")).first()
    tree = Tree(size["width"] or 0, size["norm2"] or 0.0)
    # a score is at most M^2, and so is every sum on the way to it
    exact = np.float64 if tree.norm2 < 1 << 52 else np.int64
    chosen = rows.orderBy(F.xxhash64("vec_id", "q"), "vec_id").limit(SAMPLE_ROWS).select("q").toArrow().column(0).combine_chunks()
    sample = tree.place(_matrix(chosen, tree.width))
    if len(sample):
        tree.grow(sample, max(1, leaf_rows * len(sample) // size["n"]))
    width = tree.width

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column(3), width)
            leaf, _ = tree.assign(tree.place(q))
            packed = pa.array([v.tobytes() for v in q.astype("<i8")], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *(batch.column(i) for i in range(3)), packed],
                                             names=["leaf", "row", "vec_id", "label", "q"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = np.asarray(batch.column(0))
            cuts = np.flatnonzero(np.diff(leaf)) + 1
            for start, stop in zip(np.r_[0, cuts], np.r_[cuts, len(leaf)]):
                for a in range(start, stop, tile_rows):
                    part = batch.slice(a, min(tile_rows, stop - a))
                    yield pa.RecordBatch.from_pydict({
                        "leaf": pa.array([leaf[a]], pa.int32()), "ids": pa.array([part.column(2).to_pylist()], pa.list_(pa.int64())),
                        "labels": pa.array([part.column(3).to_pylist()], pa.list_(pa.int32())),
                        "vectors": pa.array([b"".join(part.column(4).to_pylist())], pa.binary())})

    # the row number splits a leaf of any size, and copies, over several partitions
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "q")
    placed = numbered.mapInArrow(leaves, "leaf int, row bigint, vec_id bigint, label int, q binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parts, "leaf", F.xxhash64("row")).sortWithinPartitions("leaf")
    ordered.mapInArrow(pack, TILE_DDL).write.parquet(path)
    index = Index(path, tree, exact)
    _set_ranges(index, spark)
    return index


def _set_ranges(index: Index, spark: SparkSession) -> None:
    """The ranges of all rows: one row for each node, split point and subtree from each task."""
    tree = index.tree
    tree.near = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.far = [np.full((len(p), len(p)), -np.inf) for p in tree.points]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, far = [x.copy() for x in tree.near], [x.copy() for x in tree.far]
        for batch in batches:
            for packed in batch.column(0):
                q = np.frombuffer(packed.as_py(), "<i8").reshape(-1, tree.width)
                for node, (lo, hi) in tree.assign(tree.place(q))[1].items():
                    near[node], far[node] = np.minimum(near[node], lo), np.maximum(far[node], hi)
        found = [(node, i, j, near[node][i, j], far[node][i, j]) for node in range(len(near))
                 for i, j in zip(*np.nonzero(far[node] >= 0))]
        columns = list(zip(*found)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(map(int, c)), pa.int32()) for c in columns[:3]] + [
            pa.array(list(map(float, c)), pa.float64()) for c in columns[3:]], names=["node", "i", "j", "near", "far"])

    if tree.points and tree.width:
        parts = index.tiles(spark).select("vectors").mapInArrow(run, "node int, i int, j int, near double, far double")
        for r in parts.groupBy("node", "i", "j").agg(F.min("near").alias("near"), F.max("far").alias("far")).collect():
            tree.near[r["node"]][r["i"], r["j"]], tree.far[r["node"]][r["i"], r["j"]] = r["near"], r["far"]


@dataclass
class Wanted:
    """Windows of one block: window w belongs to anchor ``anchor[w]``, asks for its first ``k`` rows
    with ``low[w] <= score <= high[w]`` and of the same or another label."""
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    k: int
    home: np.ndarray | None = None      # search only the anchors' own leaves


def _radius(tree: Tree, norm2: np.ndarray, score: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(norm2 + tree.norm2 - 2.0 * score.astype(np.float64), 0))


def search(index: Index, tiles: DataFrame, want: Wanted) -> DataFrame:
    """(window, id, score): at least the first ``want.k`` rows of each window, ranked below."""
    tree, exact = index.tree, index.exact

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = want.vectors.astype(exact)
        square = (want.vectors.astype(np.float64) ** 2).sum(axis=1)
        at = np.column_stack([want.vectors.astype(np.float64), np.zeros(len(square))])
        to_points = [tree.distances(node, at) for node in range(len(tree.points))]
        slack = 1e-6 * (np.sqrt(tree.norm2) + np.sqrt(square) + 1)
        best = _First(want)
        for batch in batches:
            for leaf, ids, labels, packed in zip(*(batch.column(i) for i in range(4))):
                leaf = leaf.as_py()
                low, high = tree.interval(leaf, to_points)
                a = want.anchor
                meets = ((low - slack)[a] <= _radius(tree, square[a], best.low)) & (
                    (high + slack)[a] >= _radius(tree, square[a], want.high))
                if want.home is not None:
                    meets &= want.home[a] == leaf
                windows = np.flatnonzero(meets & (best.low <= want.high))
                if not len(windows):
                    continue
                q = np.frombuffer(packed.as_py(), "<i8").reshape(len(ids), tree.width).astype(exact)
                anchors, own = np.unique(a[windows], return_inverse=True)
                scores = vectors[anchors] @ q.T
                label, key = np.asarray(labels.values), ids.values
                no_id = np.asarray(key.is_null())
                key = np.asarray(key.fill_null(0))
                if want.same:
                    fits = (label == want.labels[anchors][:, None]) & ((key != want.ids[anchors][:, None]) | no_id)
                else:
                    fits = label != want.labels[anchors][:, None]
                for part in range(0, len(windows), 1024):
                    w, o = windows[part:part + 1024], own[part:part + 1024]
                    s = scores[o]
                    i, j = np.nonzero(fits[o] & (s >= best.low[w][:, None]) & (s <= want.high[w][:, None]))
                    best.add(w[i], s[i, j].astype(np.int64), key[j], no_id[j])
        window, score, key, no_id = best.prune()
        yield pa.RecordBatch.from_arrays([pa.array(window, pa.int32()), pa.array(key, pa.int64(), mask=no_id), pa.array(score, pa.int64())],
                                         names=["window", "id", "score"])

    found = tiles.mapInArrow(run, "window int, id bigint, score bigint")
    order = Window.partitionBy("window").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= want.k)


class _First:
    """The first k rows of each window so far; ``low`` is what a further one must reach."""

    def __init__(self, want: Wanted) -> None:
        self.k, self.low = want.k, want.low.copy()
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size, self.limit = 0, 1 << 16

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.size += len(columns[0])
        if self.size > self.limit:
            self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
        window, score, key, no_id = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((key, no_id, -score, window))
        w = window[order]
        starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]]) if len(w) else np.zeros(0, int)
        place = np.arange(len(w)) - np.repeat(starts, np.diff(np.r_[starts, len(w)]))
        last = order[place == self.k - 1]
        self.low[window[last]] = score[last]
        kept = order[place < self.k]
        self.parts = [(window[kept], score[kept], key[kept], no_id[kept])]
        self.size, self.limit = len(kept), max(self.limit, 2 * len(kept))
        return self.parts[0]


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _mine_block(index: Index, spark: SparkSession, ids: list[int], labels: list[int], vectors: list[list[int]], path: str) -> None:
    """Positives and negatives of one block of anchors, written to ``path``."""
    tree, n = index.tree, len(ids)
    q = np.zeros((n, tree.width), np.int64)
    for i, v in enumerate(vectors):
        q[i, :len(v)] = v
    home, _ = tree.assign(tree.place(q))
    every, most = np.arange(n), np.full(n, -LEAST)

    def want(anchor: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int, home: np.ndarray | None = None) -> Wanted:
        return Wanted(np.array(ids, np.int64), np.array(labels, np.int32), q, anchor, low, high, same, k, home)

    tiles, low = index.tiles(spark), np.full(n, LEAST)
    for r in search(index, tiles, want(every, low, most, True, POSITIVES, home)).where(F.col("rank") == POSITIVES).collect():
        low[r["window"]] = r["score"]
    positives = search(index, tiles, want(every, low, most, True, POSITIVES)).collect()        # a few for each anchor of the block
    score = np.array([r["score"] for r in positives], np.int64)
    windows = want(np.array([r["window"] for r in positives], np.int64), -((-LOW * score) // 100), (HIGH * score) // 100, False, NEGATIVES)
    pairs = [(w, ids[r["window"]], r["id"], r["score"]) for w, r in enumerate(positives)]
    names = spark.createDataFrame(pairs, "window int, anchor_id bigint, positive_id bigint, positive_score bigint")
    negatives = search(index, tiles, windows).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    out = negatives.join(F.broadcast(names), "window")
    out.select(*T.StructType.fromDDL(RESULT).names).write.parquet(path)


def mine(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         block: int = BLOCK_ANCHORS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows
    whose id ``ANCHOR_STEP`` divides."""
    spark = rows.sparkSession
    own = participants(rows, id_col, vector_col, label_col)
    folder = scratch(spark, "negatives")
    index = build_index(own, f"{folder}/tiles", leaf_rows)
    paths: list[str] = []
    ids, labels, vectors = [], [], []

    def answer() -> None:
        paths.append(f"{folder}/found/{len(paths)}")
        _mine_block(index, spark, ids, labels, vectors, paths[-1])
        ids.clear(), labels.clear(), vectors.clear()

    for r in own.where(F.col("vec_id") % ANCHOR_STEP == 0).toLocalIterator():
        ids.append(r["vec_id"]), labels.append(r["label"]), vectors.append(r["q"])
        if len(ids) >= block:
            answer()
    if ids:
        answer()
    discard(spark, f"{folder}/tiles")
    return spark.read.schema(RESULT).parquet(*paths) if paths else spark.createDataFrame([], RESULT)
