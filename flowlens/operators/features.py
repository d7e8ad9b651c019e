"""Feature preparation.

Fit = a few aggregate jobs over the training rows:
  * exact medians of the numeric columns by order statistics (counting, ``plans.selection``), like
    the reference's median imputer, yet no column is ever shuffled, sorted or sampled;
  * mean and *population* std of the imputed columns (one partial+final aggregate; Spark ML's
    ``StandardScaler`` uses the sample std and is not used);
  * the vocabulary of the categorical columns after 'unknown' imputation, as an indexed table
    (feature, value, slot): a distributed distinct, numbered in the order of the values.

A fitted model is two numbers a numeric column, the vocabulary table, and its measured size by
column.  Numeric columns become scaled columns (codegen'd arithmetic); a categorical column
becomes its value's slot by a join with the vocabulary, which is broadcast up to
``BROADCAST_BYTES`` and joined by Spark's own choice beyond.  Slots become sparse vectors through
Spark ML's ``OneHotEncoder`` and ``VectorAssembler``, so the work and the plan do not grow with the
number of values.  A row travels as its scaled numbers and slots (``row_values``); vectors are made
where a model needs them.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.plans.materialize import materialize
from flowlens.plans.ordering import TASK_ROWS, dense_index
from flowlens.plans.selection import BINS, order_statistics
from flowlens.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES, UNKNOWN_CATEGORY

#: Vocabulary bytes of a column up to which its lookup is broadcast.
BROADCAST_BYTES = 32 << 20
VOCABULARY = "feature string, value string, slot bigint"


def _long(df: DataFrame, cols: list[str], dtype: str) -> DataFrame:
    return (df.select(*[F.col(c).cast(dtype).alias(c) for c in cols])
            .unpivot([], cols, "feature", "value"))


def exact_medians(df: DataFrame, cols: list[str] = NUMERIC_FEATURES, bins: int = BINS) -> DataFrame:
    """(feature, median) ignoring nulls and NaN; mean of the two middle values for even
    counts, NULL for a column without values."""
    missing = F.lit(None).cast("double")
    wide = df.select(*[F.nanvl(F.col(c).cast("double"), missing).alias(c) for c in cols])
    long = wide.unpivot([], cols, "feature", "value").where(F.col("value").isNotNull())
    found = order_statistics(long, lambda _, n: [(n - 1) // 2, n // 2], "feature", "value", bins)
    rows = [(c, (found[c][1][0].value + found[c][1][-1].value) / 2 if c in found else None) for c in cols]
    return df.sparkSession.createDataFrame(rows, "feature string, median double").coalesce(1)


def category_vocab(df: DataFrame, cols: list[str] = CATEGORICAL_FEATURES,
                   fill: str = UNKNOWN_CATEGORY) -> DataFrame:
    """Distinct (feature, value) after constant imputation (a distributed distinct)."""
    filled = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(fill)).alias(c) for c in cols])
    return _long(filled, cols, "string").distinct()


def indexed_vocabulary(vocab: DataFrame, task_rows: int = TASK_ROWS) -> tuple[DataFrame, dict[str, int], dict[str, int]]:
    """(feature, value, slot), slots from 0 in the order of the values of a feature; and the number
    of values and of bytes of each feature."""
    vocab = materialize(vocab)
    sizes = {r["feature"]: (r["n"], r["b"]) for r in vocab.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + 16).alias("b")).collect()}
    if max((n for n, _ in sizes.values()), default=0) <= task_rows:
        slot = F.row_number().over(Window.partitionBy("feature").orderBy("value")) - 1
        indexed = materialize(vocab.select("feature", "value", slot.cast("bigint").alias("slot")))
    else:
        indexed = dense_index(vocab, ["value"], strata=["feature"], out="slot").select("feature", "value", "slot")
    return indexed, {c: n for c, (n, _) in sizes.items()}, {c: b for c, (_, b) in sizes.items()}


def _sql_double(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def _sql_str(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class FeatureModel:
    medians: dict
    means: dict
    stds: dict
    vocabulary: DataFrame = field(compare=False)
    sizes: dict                     # values of each categorical column
    bytes: dict
    numeric: list = field(default_factory=lambda: list(NUMERIC_FEATURES))
    categorical: list = field(default_factory=lambda: list(CATEGORICAL_FEATURES))
    fill: str = UNKNOWN_CATEGORY

    @classmethod
    def of(cls, spark: SparkSession, medians: dict, means: dict, stds: dict, values: dict, fill: str = UNKNOWN_CATEGORY) -> FeatureModel:
        """A model from given statistics and lists of values, in the order of their slots."""
        rows = [(c, v, k) for c, own in values.items() for k, v in enumerate(own)]
        return cls(medians, means, stds, spark.createDataFrame(rows, VOCABULARY), {c: len(v) for c, v in values.items()},
                   {c: sum(len(x.encode()) + 16 for x in v) for c, v in values.items()}, list(medians), list(values), fill)

    def save(self, spark: SparkSession, path: str) -> None:
        """The statistics as one JSON row and the vocabulary as a table, in any store that Spark
        writes to."""
        text = json.dumps({k: v for k, v in vars(self).items() if k != "vocabulary"})
        spark.createDataFrame([(text,)], "model string").coalesce(1).write.mode("overwrite").parquet(f"{path}/statistics")
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureModel:
        own = json.loads(spark.read.parquet(f"{path}/statistics").first()["model"])
        return cls(vocabulary=spark.read.schema(VOCABULARY).parquet(f"{path}/vocabulary"), **own)

    def size(self, c: str) -> int:
        return self.sizes.get(c, 0)

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(self.size(c) for c in self.categorical)

    @property
    def row_values(self) -> list[str]:
        """Columns that hold a prepared row: scaled numbers, then slots."""
        return [f"f_{c}" for c in self.numeric] + [f"s_{c}" for c in self.categorical]

    # -- SQL text of the fitted transform --------------------------------------------------
    def imputed_sql(self, c: str) -> str:
        return f"coalesce(CAST(`{c}` AS DOUBLE), {_sql_double(self.medians[c])})"

    def scaled_sql(self, c: str) -> str:
        return f"(({self.imputed_sql(c)} - {_sql_double(self.means[c])}) / {_sql_double(self.stds[c])})"

    def category_sql(self, c: str) -> str:
        return f"coalesce(CAST(`{c}` AS STRING), {_sql_str(self.fill)})"

    def scale(self, df: DataFrame, zero: bool = False) -> DataFrame:
        """F1 + F3: adds ``f_<column>`` for each numeric column (F6: zeros)."""
        return df.withColumns({f"f_{c}": F.lit(0.0) if zero else F.expr(self.scaled_sql(c)) for c in self.numeric})

    def slots(self, df: DataFrame, zero: bool = False) -> DataFrame:
        """F2 + F4: adds ``s_<column>`` for each categorical column, the slot of its value, or the
        column's number of values where it is unseen (F6: for all rows)."""
        for c in self.categorical:
            if zero or not self.size(c):
                df = df.withColumn(f"s_{c}", F.lit(self.size(c)).cast("bigint"))
                continue
            own = self.vocabulary.where(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("slot").alias("_slot"))
            own = F.broadcast(own) if self.bytes[c] <= BROADCAST_BYTES else own
            df = (df.join(own, F.expr(self.category_sql(c)) == F.col("_value"), "left")
                  .withColumn(f"s_{c}", F.coalesce("_slot", F.lit(self.size(c)).cast("bigint"))).drop("_value", "_slot"))
        return df

    def prepare(self, df: DataFrame, zero_numeric: bool = False, zero_categorical: bool = False) -> DataFrame:
        """F1-F4 (F6 with the zero flags): adds ``row_values``."""
        return self.slots(self.scale(df, zero_numeric), zero_categorical)

    def assemble(self, df: DataFrame, rows: list[tuple[list[Column], list[Column]]], out: str = "features") -> DataFrame:
        """one vector of several prepared rows, each (scaled numbers, slots): its numbers, then
        its one-hot block.  Sparse where that is smaller."""
        numbers = {f"_n{i}_{j}": x for i, (own, _) in enumerate(rows) for j, x in enumerate(own)}
        usable = [j for j, c in enumerate(self.categorical) if self.size(c)]
        slots = {f"_s{i}_{j}": own[j].cast("double") for i, (_, own) in enumerate(rows) for j in usable}
        wide = df.withColumns(numbers | slots)
        encoded = []
        if slots:
            sizes = [float(self.size(self.categorical[j])) for _ in rows for j in usable]
            made = df.sparkSession.createDataFrame([tuple(sizes)], list(slots))
            encoded = [f"_v{n}" for n in slots]
            wide = OneHotEncoder(inputCols=list(slots), outputCols=encoded, dropLast=True).fit(made).transform(wide)
        cols = [c for i in range(len(rows)) for c in (
            [n for n in numbers if n.startswith(f"_n{i}_")] + [n for n in encoded if n.startswith(f"_v_s{i}_")])]
        return VectorAssembler(inputCols=cols, outputCol=out).transform(wide).drop(*numbers, *slots, *encoded)

    def transform(self, df: DataFrame, zero_numeric: bool = False, zero_categorical: bool = False, out: str = "features") -> DataFrame:
        """Prepared rows with their vector; the numeric block has positions 0-7."""
        rows = self.prepare(df, zero_numeric, zero_categorical)
        own = [F.col(f"f_{c}") for c in self.numeric], [F.col(f"s_{c}") for c in self.categorical]
        return self.assemble(rows, [own], out)

    def row_encoder(self) -> Callable[[np.ndarray], np.ndarray]:
        """F5 inside tasks: ``row_values`` ([n, d]) to the entries of ``assemble``'s vectors ([n, width])."""
        n, width = len(self.numeric), self.width
        blocks = [(n + j, self.size(c)) for j, c in enumerate(self.categorical) if self.size(c)]

        def encode(x: np.ndarray) -> np.ndarray:
            if np.isnan(x).any():
                raise ValueError("a prepared row has a null or NaN value")
            out, at = np.zeros((len(x), width)), n
            out[:, :n] = x[:, :n]
            for j, size in blocks:
                own = np.flatnonzero(x[:, j] < size)
                out[own, at + x[own, j].astype(np.int64)] = 1.0
                at += size
            return out

        return encode

    def window_vectors(self, windows: DataFrame, length: int, out: str = "features") -> DataFrame:
        """The vector of a whole window from ``seq`` (its rows of ``row_values``) and ``n_real``: rows
        before the first real one are zero."""
        n = len(self.numeric)
        rows = []
        for k in range(length):
            row = F.get("seq", F.lit(k))
            real = F.lit(k) >= F.lit(length) - F.col("n_real")
            rows.append(([F.get(row, F.lit(i)) for i in range(n)],
                         [F.when(real, F.get(row, F.lit(n + j))).otherwise(float(self.size(c))) for j, c in enumerate(self.categorical)]))
        return self.assemble(windows, rows, out)


def fit_features(train: DataFrame, numeric: list[str] = NUMERIC_FEATURES,
                 categorical: list[str] = CATEGORICAL_FEATURES,
                 fill: str = UNKNOWN_CATEGORY) -> FeatureModel:
    """F1-F5 fit on the training rows only.  The driver gets a few numbers per column; the vocabulary
    stays a table.  The training rows are read by every statistic, so their lineage is cut once."""
    cols = list(dict.fromkeys(list(numeric) + list(categorical)))
    train = materialize(train.select(*cols))
    med = ({r["feature"]: r["median"] for r in exact_medians(train, numeric).collect()}
           if numeric else {})
    # sklearn drops an all-null column; we keep the width and impute 0.0 there
    med = {c: (med.get(c) if med.get(c) is not None else 0.0) for c in numeric}
    imputed = train.select(*[F.coalesce(F.col(c).cast("double"), F.lit(med[c])).alias(c)
                             for c in numeric])
    row = (imputed.agg(*[F.avg(c).alias(f"m_{c}") for c in numeric],
                       *[F.stddev_pop(c).alias(f"s_{c}") for c in numeric]).first()
           if numeric else {})
    means = {c: float(row[f"m_{c}"] or 0.0) for c in numeric}
    stds = {c: (float(row[f"s_{c}"]) if row[f"s_{c}"] else 1.0) for c in numeric}
    vocabulary, sizes, size_bytes = (indexed_vocabulary(category_vocab(train, categorical, fill)) if categorical
                                     else (train.sparkSession.createDataFrame([], VOCABULARY), {}, {}))
    return FeatureModel(med, means, stds, vocabulary, sizes, size_bytes, list(numeric), list(categorical), fill)


def feature_moments(train: DataFrame, medians: dict, numeric: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """A12 as a table: (feature, mean, std) of the median-imputed columns."""
    imputed = train.select(*[F.coalesce(F.col(c).cast("double"), F.lit(float(medians[c]))).alias(c)
                             for c in numeric])
    long = imputed.unpivot([], numeric, "feature", "value")
    return long.groupBy("feature").agg(F.avg("value").alias("mean"),
                                       F.stddev_pop("value").alias("std"))
