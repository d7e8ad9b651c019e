"""Quality: random Fourier features of document statistics, ridge scores, isotonic calibration.

1. A text becomes a few statistics of its characters, words and lines (``statistics``).
2. They are standardised and mapped to cosines of random projections, whose inner products
   approximate a Gaussian kernel.
3. Each task sums the normal equations (Z'Z, Z'y) of its rows; the sums of a bounded number of
   tasks are added and solved with a ridge penalty.
4. On labelled rows that the ridge did not see, the scores are calibrated by pooling adjacent
   violators; between the pooled points the score is interpolated.

Fitting uses at most ``MAX_TRAIN_ROWS`` labelled rows (those smallest by md5 of the id).  Scoring
is one map over whole texts with the model (a few kB) broadcast.

Cases: a null or empty text has zero statistics and the score those give; unlabelled,
null-labelled and null-id rows teach nothing; without labels of both classes every score is
the share of good rows (one half without any); repeated rows get equal scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.base import id_crc, labelled_texts, map_rows, sample_labels, settle, texts

MAX_TRAIN_ROWS = 32_768
FEATURES, SEED = 256, 7
RIDGE = 1e-3
CLIP = 4.0
THRESHOLD = 0.3
CALIBRATION_FOLDS = 4
PART = 1 << 20
NAMES = ("log_chars", "log_words", "log_lines", "word_length", "letters", "digits", "capitals", "marks", "spaces", "beyond_ascii",
         "distinct_words", "top_word", "repeats_next", "distinct_lines", "short_lines", "line_ends", "letterless_words",
         "mark_kinds", "doubled_marks", "first_capitals")


def _classes() -> np.ndarray:
    """Class of a code point, 255 standing for all above it: 0 letter, 1 capital, 2 digit, 3 mark, 4 space."""
    kind = np.full(256, 3, np.uint8)
    for c in range(255):
        ch = chr(c)
        kind[c] = 4 if ch.isspace() else 2 if ch.isdigit() else 1 if ch.isupper() else 0 if ch.isalpha() else 3
    kind[255] = 0
    return kind


KIND = _classes()


def statistics(text: str) -> np.ndarray:
    """The statistics of one whole text, a fixed number of floats."""
    out = np.zeros(len(NAMES))
    if not text:
        return out
    seen = np.zeros(256, np.int64)
    beyond = doubled = 0
    for at in range(0, len(text), PART):  # arrays over a bounded part of a long text
        c = np.frombuffer(text[at:at + PART].encode("utf-32-le"), np.uint32)
        beyond += int((c > 127).sum())
        low = np.minimum(c, 255)
        seen += np.bincount(low, minlength=256)
        marks = KIND[low] == 3
        doubled += int((marks[1:] & (c[1:] == c[:-1])).sum())
    by_kind = np.bincount(KIND, weights=seen, minlength=5)
    words, lines, n = text.split(), text.split("\n"), len(text)
    counts = Counter(words)
    line_counts = Counter(lines)
    w = max(1, len(words))
    full = [x for x in lines if x]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out[:] = (
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), lengths.mean() if len(words) else 0,
        (by_kind[0] + by_kind[1]) / n, by_kind[2] / n, by_kind[1] / n, by_kind[3] / n, by_kind[4] / n, beyond / n,
        len(counts) / w, max(counts.values(), default=0) / w, sum(map(str.__eq__, words, words[1:])) / w,
        len(line_counts) / len(lines), sum(len(x) < 30 for x in full) / max(1, len(full)),
        sum(x[-1] in ".!?" for x in full) / max(1, len(full)), sum(not any(map(str.isalpha, x)) for x in counts) / max(1, len(counts)),
        int(((seen > 0) & (KIND == 3)).sum()) / 16, doubled / n, sum(x[0].isupper() for x in words) / w)
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    points: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        z = np.cos(x @ self.projection + self.shift) * np.sqrt(2 / len(self.shift))
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        # rounded: a product's last digits depend on how many rows are scored together
        return np.clip(np.interp(np.round(self.raw(stats), 9), self.points, self.values), 0, 1)


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: centres of the pooled blocks and their means, both ascending."""
    points, first = np.unique(score, return_inverse=True)
    size = np.bincount(first).astype(float)
    total = np.bincount(first, weights=y)
    blocks: list[list[float]] = []  # sum of labels, rows, sum of scores
    for s, n, t in zip(points, size, total):
        blocks.append([t, n, s * n])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([(b[0] + 0.5) / (b[1] + 1) for b in blocks])


def _matrix(rows: list) -> np.ndarray:
    return np.array(rows, float).reshape(-1, len(NAMES))


def normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(Z'Z, Z'y) over rows (stats, label): each task sums its own, and the tasks' sums are added."""
    shared, size = rows.sparkSession.sparkContext.broadcast(model), len(model.shift) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zz, zy = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            z = shared.value.features(_matrix(batch.column(0).to_pylist()))
            zz += z.T @ z
            zy += z.T @ (np.array(batch.column(1).to_pylist(), float) > 0)
        yield pa.RecordBatch.from_arrays([pa.array([zz.tobytes()]), pa.array([zy.tobytes()])], names=["zz", "zy"])

    zz, zy = np.zeros((size, size)), np.zeros(size)
    for r in rows.select("stats", "label").mapInArrow(run, "zz binary, zy binary").toLocalIterator():
        zz += np.frombuffer(r["zz"]).reshape(size, size)
        zy += np.frombuffer(r["zy"])
    return zz, zy


def fit(docs: DataFrame, labels: DataFrame, keep: Column, *, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on the documents whose labels satisfy ``keep`` (a condition on the label's doc_id)."""
    chosen = sample_labels(labels, label, keep, max_rows, id_col)
    sample = labelled_texts(texts(docs, id_col, text_col), chosen, max_rows)

    def make():
        return lambda part: [[statistics(t).tolist() for t in part]]

    rows = settle(map_rows(sample.select(F.struct("doc_id", "label").alias("doc_id"), "text"), "stats array<double>", make)
                  .select("doc_id.doc_id", "doc_id.label", "stats"))
    sums = rows.select(*(F.struct(F.avg(F.col("stats")[i]), F.stddev_pop(F.col("stats")[i])).alias(f"s{i}") for i in range(len(NAMES))),
                       F.sum((F.col("label") > 0).cast("int")).alias("good"), F.count(F.lit(1)).alias("n")).first()
    n, good = sums["n"], sums["good"] or 0
    random = np.random.default_rng(SEED)
    width = np.sqrt(len(NAMES))
    empty = Model(np.array([sums[f"s{i}"][0] or 0.0 for i in range(len(NAMES))]),
                  np.array([sums[f"s{i}"][1] or 1.0 for i in range(len(NAMES))]),
                  random.normal(0, 1 / width, (len(NAMES), FEATURES)), random.uniform(0, 2 * np.pi, FEATURES),
                  np.zeros(FEATURES + 1), np.array([0.0]), np.array([(good + 1) / (n + 2)]))
    if not good or good == n:
        return empty
    aside = F.crc32(F.concat(F.lit("calibration:"), F.col("doc_id").cast("string")).cast("binary")) % CALIBRATION_FOLDS == 0
    zz, zy = normal_equations(rows.where(~aside), empty)
    empty.weights = np.linalg.solve(zz + RIDGE * n * np.diag(np.r_[np.ones(FEATURES), 0]) / FEATURES + 1e-9 * np.eye(FEATURES + 1), zy)
    checked = rows.where(aside).select("stats", "label").collect()  # a quarter of max_rows at most
    if len({r["label"] > 0 for r in checked}) < 2:
        checked = rows.select("stats", "label").collect()
    empty.points, empty.values = isotonic(empty.raw(_matrix([r["stats"] for r in checked])),
                                          np.array([float(r["label"] > 0) for r in checked]))
    return empty


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda part: [shared.value.score(np.array([statistics(t) for t in part]))]

    return map_rows(texts(docs, id_col, text_col), "score double", make)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all of its columns and the rows that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(batch: pd.Series) -> pd.Series:
        if not len(batch):
            return pd.Series([], dtype=bool)
        return pd.Series(shared.value.score(np.array([statistics(t or "") for t in batch])) >= threshold)

    return docs.where(good(docs[text_col].cast("string")))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that never teach: a null id has no fold and counts as not held out."""
    return F.coalesce(id_crc(doc_id) % 5 == 0, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): fitted on the labels of rows that are not held out."""
    scored = score(docs, fit(docs, labels, ~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
