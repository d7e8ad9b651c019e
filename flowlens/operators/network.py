"""The fit of the sequence network (K3) with its matrix products in numpy.

``SequencePerceptron`` is Spark ML's ``MultilayerPerceptronClassifier``: its parameters, first
weights, loss, optimiser and model.  Only the sum of the loss and gradient over the windows, which
the optimiser asks for at least once an iteration, is made otherwise:
  * windows are packed once into blocks that hold a row once where a window is the one before it
    moved on by a row (compared, not assumed); a block of other windows holds them whole.  The
    blocks are persisted while the fit runs, a fifth of the windows' bytes;
  * each evaluation is a ``mapPartitions`` over the blocks with the weights in its closure; a task
    returns one row, its sums (an RDD of bytes: reaching Python by Arrow took most of a task);
  * the driver adds the tasks' sums in partition order and takes the next L-BFGS step: as many rows
    as the input has partitions, each as large as the weights.
The loss is the mean over windows.  Spark ML's is the mean of its blocks' means, which is the same
where blocks are full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

#: Entries of a window up to which the fit packs windows; wider ones have Spark ML's own fit, which
#: sums the gradients of tasks on executors.
DENSE_WIDTH = 1024
BLOCKS = "n bigint, rows binary, starts binary, classes binary"


def packed(x: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and, for each window of ``x`` ([n, length * d]), the place of its first row: rows that a
    window shares with the one before it are held once."""
    n, d = len(x), x.shape[1] // length
    new = np.ones(n, bool)
    if length > 1:
        new[1:] = (x[1:, :-d] != x[:-1, d:]).any(axis=1)
    last = np.cumsum(np.where(new, length, 1)) - 1
    rows = np.empty((int(last[-1]) + 1 if n else 0, d))
    rows[last] = x[:, (length - 1) * d:]
    if length > 1:
        rows[last[new][:, None] - np.arange(length - 1, 0, -1)] = x[new].reshape(-1, length, d)[:, :-1]
    return rows, (last - (length - 1)).astype(np.int32)


def unpacked(rows: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The windows ([n, length * d]) that begin at ``starts``."""
    d = rows.shape[1]
    every = np.lib.stride_tricks.as_strided(rows, (len(rows) - length + 1, length * d), rows.strides, writeable=False)
    return every[starts]


def loss_and_gradient(weights: np.ndarray, layers: list[int], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Sums over windows ``x`` of classes ``y``: cross-entropy of a network with sigmoid layers and
    softmax on top, and its gradient, in the order of Spark ML's weights."""
    affine, at = [], 0
    for a, b in zip(layers, layers[1:]):
        affine.append((weights[at:at + a * b].reshape(a, b), weights[at + a * b:at + a * b + b]))
        at += a * b + b
    outs, own = [x], np.arange(len(x))
    with np.errstate(over="ignore"):
        for k, (m, bias) in enumerate(affine):
            z = outs[-1] @ m
            z += bias
            if k < len(affine) - 1:
                np.negative(z, out=z)
                np.exp(z, out=z)
                z += 1
                np.reciprocal(z, out=z)
            outs.append(z)
    delta = outs.pop()
    delta -= delta.max(axis=1, keepdims=True)
    chosen = delta[own, y]
    np.exp(delta, out=delta)
    total = delta.sum(axis=1)
    loss = float((np.log(total) - chosen).sum())
    delta /= total[:, None]
    delta[own, y] -= 1
    grads = []
    for k in reversed(range(len(affine))):
        below = outs[k]
        grads += [delta.sum(axis=0), (below.T @ delta).reshape(-1)]
        if k:
            delta = delta @ affine[k][0].T
            delta *= below
            delta *= 1 - below
    return loss, np.concatenate(grads[::-1])


class _Failed(Exception):
    """A step that the optimiser cannot take."""


def _between(low: tuple, high: tuple) -> float:
    """The minimum of the cubic through two points (place, value, slope), away from their ends."""
    (a, fa, da), (b, fb, db) = sorted((low, high))
    d1 = da + db - 3 * (fa - fb) / (a - b)
    d2 = np.sqrt(max(d1 * d1 - da * db, 0.0))
    t = b - (b - a) * (db + d2 - d1) / (db - da + 2 * d2)
    return float(min(max(t, a + 0.1 * (b - a)), a + 0.9 * (b - a)))


def _line_search(phi: Callable[[float], tuple], start: tuple, t: float) -> float:
    """A step under the strong Wolfe conditions (Nocedal and Wright 3.5 and 3.6, limits as in Breeze);
    ``phi(t)`` is (t, value, slope), and the last place asked for is the one returned."""
    _, value, slope = low = start
    if slope > 0:
        raise _Failed("not a descent direction")
    ends = None
    for i in range(10):
        c = phi(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            ends = low, c
        elif abs(c[2]) <= 0.9 * abs(slope):
            return t
        elif c[2] >= 0:
            ends = c, low
        if ends:
            break
        low, t = c, t * 1.5
    if not ends:
        raise _Failed("line search")
    low, high = ends
    for _ in range(10):
        c = phi(_between(low, high))
        if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
            high = c
            continue
        if abs(c[2]) <= 0.9 * abs(slope):
            return c[0]
        if c[2] * (high[0] - low[0]) >= 0:
            high = low
        low = c
    raise _Failed("zoom")


def _direction(grad: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """L-BFGS: minus the approximate inverse Hessian times ``grad``; newest step first."""
    d, kept = grad.copy(), []
    for s, y in steps:
        kept.append((s @ d) / (s @ y))
        d -= kept[-1] * y
    if steps:
        s, y = steps[0]
        if not s @ y >= 0 or not np.isfinite(d).all():
            raise _Failed("history")
        d *= (s @ y) / (y @ y)
    for (s, y), a in reversed(list(zip(steps, kept))):
        d += (a - (y @ d) / (s @ y)) * s
    return -d


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int, tolerance: float,
             memory: int = 10) -> np.ndarray:
    """L-BFGS with the line search, resets and stopping rules of Spark ML's (Breeze): at most ``rounds``
    iterations; values of the last 20, or the gradient, within ``tolerance`` of no change."""
    value, grad = f(x)
    first, values, steps, failed, done = value, [np.inf], [], False, 0
    while done < rounds:
        if done and abs(value - max(values)) <= tolerance * first or np.linalg.norm(grad) <= max(tolerance * value, 1e-8):
            break
        try:
            d, seen = _direction(grad, steps), {}

            def phi(t: float) -> tuple:
                seen.update(x=x + t * d)
                seen["value"], seen["grad"] = f(seen["x"])
                return t, seen["value"], seen["grad"] @ d

            t = _line_search(phi, (0.0, value, grad @ d), 1.0 if done else 1 / np.linalg.norm(d))
            if t * np.linalg.norm(grad) < 1e-10:
                raise _Failed("step size")
        except _Failed:
            if failed:
                break
            failed, steps = True, []
            continue
        failed, done = False, done + 1
        steps = [(seen["x"] - x, seen["grad"] - grad), *steps][:memory]
        x, value, grad = seen["x"], seen["value"], seen["grad"]
        values = [*values, value][-20:]
    return x


class SequencePerceptron(MultilayerPerceptronClassifier):
    """``MultilayerPerceptronClassifier`` over windows of ``length`` rows, fitted in blocks."""

    length = 1

    def _blocks(self, dataset: DataFrame) -> DataFrame:
        length, layers = self.length, self.getLayers()

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                x, y = batch.column(0).flatten().to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
                if len(x) != n * layers[0] or not np.isin(y, np.arange(layers[-1])).all():
                    raise ValueError(f"a window needs {layers[0]} entries and a class below {layers[-1]}")
                rows, starts = packed(x.reshape(n, -1), length)
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in (
                    rows, starts, y.astype(np.int32)))], names=["n", "rows", "starts", "classes"])

        rows = dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        return rows.mapInArrow(pack, BLOCKS)

    def _sums(self, blocks: RDD, weights: np.ndarray) -> tuple[int, float, np.ndarray]:
        length, layers, chunk = self.length, self.getLayers(), self.getBlockSize()

        def run(own: Iterator[tuple]) -> Iterator[tuple]:
            count, loss, gradient = 0, 0.0, np.zeros(len(weights))
            for n, rows, starts, classes in own:
                rows = np.frombuffer(rows).reshape(-1, layers[0] // length)
                starts, classes = np.frombuffer(starts, np.int32), np.frombuffer(classes, np.int32)
                for at in range(0, n, chunk):
                    x = unpacked(rows, starts[at:at + chunk], length)
                    more, slopes = loss_and_gradient(weights, layers, x, classes[at:at + chunk])
                    loss += more
                    gradient += slopes
                count += n
            yield count, loss, gradient

        parts = blocks.mapPartitions(run).collect()
        return sum(n for n, _, _ in parts), sum(loss for _, loss, _ in parts), sum((g for _, _, g in parts), np.zeros(len(weights)))

    def _with(self, dataset: DataFrame, weights: np.ndarray | None = None) -> MultilayerPerceptronClassificationModel:
        """Spark ML's model with ``weights`` (default: the first weights): its fit without an iteration."""
        one = dataset.sparkSession.createDataFrame([(Vectors.sparse(self.getLayers()[0], {}), 0.0)], [self.getFeaturesCol(), self.getLabelCol()])
        still = self.copy({self.maxIter: 0} | ({} if weights is None else {self.initialWeights: Vectors.dense(weights)}))
        return MultilayerPerceptronClassifier._fit(still, one)

    def _fit(self, dataset: DataFrame) -> MultilayerPerceptronClassificationModel:
        if self.getLayers()[0] > DENSE_WIDTH or self.getLayers()[0] % self.length or self.getSolver() != "l-bfgs":
            return super()._fit(dataset)
        blocks = self._blocks(dataset).rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            def mean(weights: np.ndarray) -> tuple[float, np.ndarray]:
                n, loss, gradient = self._sums(blocks, weights)
                if not n:
                    raise ValueError("a fit needs windows")
                return loss / n, gradient / n

            weights = minimise(mean, self._with(dataset).weights.toArray(), self.getMaxIter(), self.getTol())
        finally:
            blocks.unpersist()
        return self._copyValues(self._with(dataset, weights))
