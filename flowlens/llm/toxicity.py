"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed buckets of its character 3- to 5-grams (lower-cased, a space
at either end), present or absent.  Fitting, on at most ``MAX_TRAIN_ROWS`` labelled rows (those
smallest by md5 of the id):

1. each of a bounded number of tasks counts in how many toxic and other texts each bucket
   occurs;
2. buckets whose chi-square against the label reaches a bound stay, scaled by r = log of the
   ratio of their smoothed shares in the two classes; of the bounds in ``CHI_SQUARES`` the one
   is taken whose model, learned from two thirds of the teaching rows, has the least log loss
   on the other third;
3. a logistic regression with an L2 penalty is fitted to the scaled features by L-BFGS, toxic
   rows weighted by the square root of the class ratio.

Scoring is a map over whole texts with the weights (1 MB) broadcast: the score is the logistic
function of the sum over the text's buckets.

Cases: a null or empty text has the score of its few features, which is near the base rate;
unlabelled, null-labelled and null-id rows teach nothing; without labels of both classes every
score is the share of toxic rows (one half without any); repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.base import id_crc, labelled_texts, map_rows, sample_labels, text_runs, texts

SHORTEST, LONGEST = 3, 5
BITS = 18
MAX_TRAIN_ROWS = 16_384
MIN_TEXTS, CHI_SQUARES = 3, (15.0, 25.0, 40.0)
SMOOTHING, L2 = 0.5, 1e-3
THRESHOLD = 0.7
PART = 1 << 20


def buckets(padded: str) -> np.ndarray:
    """Hashed buckets of all n-grams of a lower-cased, padded text, with repeats."""
    c = np.frombuffer(padded.encode("utf-32-le"), np.uint32)
    out, h = [], c
    for n in range(2, LONGEST + 1):
        if len(h) < 2:
            break
        h = h[:-1] * np.uint32(0x01000193) + c[n - 1:]
        if n >= SHORTEST:
            mixed = (h * np.uint32(0x9E3779B1) + np.uint32(n)) * np.uint32(0x85EBCA6B)
            out.append(mixed >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def present(text: str, wanted: np.ndarray) -> np.ndarray:
    """Distinct buckets of a text among the ``wanted`` ones.  A long text goes part by part, the
    parts overlapping by an n-gram's length."""
    padded = f" {text.lower()} "
    parts = []
    for at in range(0, len(padded), PART):
        found = buckets(padded[at:at + PART + LONGEST - 1])
        parts.append(np.unique(found[wanted[found]]))
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scorer(self) -> Callable[[str], float]:
        weights, bias = self.weights, self.bias
        wanted = weights != 0

        def score(text: str) -> float:
            z = float(weights[present(text, wanted)].sum()) + bias
            return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

        return score


def minimise(f: Callable, x: np.ndarray, rounds: int = 200, memory: int = 8, tolerance: float = 1e-8) -> np.ndarray:
    """L-BFGS with step halving for a smooth convex f that returns value and gradient."""
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    value, grad = f(x)
    for _ in range(rounds):
        d, kept = grad.copy(), []
        for s, y in reversed(steps):
            a = (s @ d) / (y @ s)
            kept.append(a)
            d -= a * y
        if steps:
            s, y = steps[-1]
            d *= (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(kept)):
            d += s * (a - (y @ d) / (y @ s))
        size = 1.0 if steps else min(1.0, 1 / max(np.abs(grad).sum(), 1e-12))
        while True:
            new = x - size * d
            new_value, new_grad = f(new)
            if new_value <= value - 1e-4 * size * (grad @ d) or size < 1e-10:
                break
            size /= 2
        s, y = new - x, new_grad - grad
        done = abs(value - new_value) < tolerance
        x, value, grad = new, new_value, new_grad
        if done:
            break
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-memory:]
    return x


def fit_weights(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on features present[j] * ratio[j]; weights are those of presence."""
    n, flat = len(y), np.concatenate(rows) if rows else np.zeros(0, np.int32)
    row = np.repeat(np.arange(n, dtype=np.int32), [len(x) for x in rows])
    weight = np.where(y == 1, np.sqrt((y == 0).sum() / (y == 1).sum()), 1.0)
    weight /= weight.sum()

    def sums(at, of, values, size):
        out = np.zeros(size)
        for i in range(0, len(flat), PART):
            out += np.bincount(at[i:i + PART], weights=values[of[i:i + PART]], minlength=size)
        return out

    def f(v):
        w, b = v[:-1], v[-1]
        z = sums(row, flat, ratio * w, n) + b
        g = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        value = weight @ (np.logaddexp(0, z) - y * z) + L2 / 2 * (w @ w)
        return value, np.r_[sums(flat, row, g, len(ratio)) * ratio + L2 * w, g.sum()]

    v = minimise(f, np.r_[np.zeros(len(ratio)), np.log((y == 1).sum() / (y == 0).sum())])
    return ratio * v[:-1], float(v[-1])


def _bucket_counts(rows: DataFrame) -> tuple[np.ndarray, int, int]:
    """Texts of either class that have each bucket, and the sizes of the classes.  Each task
    gives one row; ``labelled_texts`` bounds their number."""
    def run(batches):
        counts, size = np.zeros((2, 1 << BITS), np.int32), np.zeros(2, np.int64)
        every = np.ones(1 << BITS, bool)
        for batch in batches:
            label = batch.column(1).to_pylist()
            for start, _, part in text_runs(batch.column(0), 1 << 20):
                for i, t in enumerate(part):
                    toxic = int(label[start + i] > 0)
                    counts[toxic, present(t, every)] += 1
                    size[toxic] += 1
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()]), pa.array([int(size[0])]), pa.array([int(size[1])])],
                                         names=["counts", "others", "toxic"])

    out, n0, n1 = np.zeros((2, 1 << BITS), np.int64), 0, 0
    for r in rows.select("text", "label").mapInArrow(run, "counts binary, others bigint, toxic bigint").toLocalIterator():
        out += np.frombuffer(r["counts"], np.int32).reshape(2, -1)
        n0, n1 = n0 + r["others"], n1 + r["toxic"]
    return out, n0, n1


@dataclass
class Features:
    """Chi-square and log-count ratio of every bucket over some teaching rows."""
    n0: int
    n1: int
    chi: np.ndarray
    ratio: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame) -> Features:
        counts, n0, n1 = _bucket_counts(rows)
        q, p = counts.astype(float)
        n = n0 + n1
        with np.errstate(divide="ignore", invalid="ignore"):
            chi = np.nan_to_num(n * (p * (n0 - q) - q * (n1 - p)) ** 2 / ((p + q) * (n - p - q) * n0 * n1), posinf=0)
        chi[p + q < MIN_TEXTS] = -1
        return cls(n0, n1, chi, np.log((p + SMOOTHING) / (n1 + 2 * SMOOTHING)) - np.log((q + SMOOTHING) / (n0 + 2 * SMOOTHING)))

    @property
    def usable(self) -> bool:
        return bool(self.n0 and self.n1)

    def kept(self, bound: float) -> np.ndarray:
        return np.flatnonzero(self.chi >= bound)

    def fit(self, found: list[np.ndarray], y: np.ndarray, bound: float) -> Model:
        """Weights from rows of present buckets, of which those that reach ``bound`` are features."""
        kept = self.kept(bound)
        place = np.full(1 << BITS, -1, np.int32)
        place[kept] = np.arange(len(kept))
        w, bias = fit_weights([x[x >= 0] for x in (place[f] for f in found)], y, self.ratio[kept])
        weights = np.zeros(1 << BITS, np.float32)
        weights[kept] = w
        return Model(weights, bias)

    def best_bound(self, found: list[np.ndarray], y: np.ndarray, aside: np.ndarray) -> float:
        """The bound whose model of the other rows has the least log loss on the rows set ``aside``."""
        losses = []
        for bound in CHI_SQUARES:
            model = self.fit([f for f, a in zip(found, aside) if not a], y[~aside], bound)
            z = np.array([model.weights[f].sum() + model.bias for f, a in zip(found, aside) if a])
            losses.append(float(np.mean(np.logaddexp(0, z) - y[aside] * z)))
        return CHI_SQUARES[int(np.argmin(losses))]


def fit(docs: DataFrame, labels: DataFrame, keep: Column, *, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on the documents whose labels satisfy ``keep`` (a condition on the label's doc_id)."""
    chosen = sample_labels(labels, label, keep, max_rows, id_col)
    rows = labelled_texts(texts(docs, id_col, text_col), chosen, max_rows)
    whole, part = Features.of(rows), Features.of(rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0))
    if not whole.usable:
        share = (whole.n1 + 1) / (whole.n0 + whole.n1 + 2)
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    any_kept = np.union1d(whole.kept(min(CHI_SQUARES)), part.kept(min(CHI_SQUARES)) if part.usable else []).astype(np.int32)
    place = np.full(1 << BITS, -1, np.int32)
    place[any_kept] = np.arange(len(any_kept))

    def make():
        wanted = place >= 0
        return lambda own: [[place[present(t, wanted)].astype("<i4").tobytes() for t in own]]

    keyed = rows.select(F.struct("doc_id", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("aside")).alias("doc_id"), "text")
    reduced = sorted((r["doc_id"]["doc_id"], r["doc_id"]["label"], r["doc_id"]["aside"], r["found"])
                     for r in map_rows(keyed, "found binary", make).collect())      # at most max_rows
    found = [any_kept[np.frombuffer(f, "<i4")] for _, _, _, f in reduced]
    y, aside = np.array([int(x > 0) for _, x, _, _ in reduced]), np.array([x for _, _, x, _ in reduced])
    del reduced
    bound = part.best_bound(found, y, aside) if part.usable and aside.any() else CHI_SQUARES[len(CHI_SQUARES) // 2]
    return whole.fit(found, y, bound)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        one = shared.value.scorer()
        return lambda part: [[one(t) for t in part]]

    return map_rows(texts(docs, id_col, text_col), "score double", make)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all of its columns, without the rows that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = shared.value.scorer()
        for batch in batches:
            yield pd.Series([one(t or "") < threshold for t in batch], dtype=bool)

    return docs.where(clean(docs[text_col].cast("string")))


def held_out(doc_id: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Rows that never teach: a null id has no fold and counts as not held out."""
    return F.coalesce(id_crc(doc_id) % folds == fold, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): fitted on the labels of rows that are not held out."""
    scored = score(docs, fit(docs, labels, ~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
