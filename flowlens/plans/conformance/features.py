"""Conformance queries over V1: feature fit/transform (A11-A13, F1-F6), sequence windows
(W1-W3) and Python batch scoring of windows (K5)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowlens.operators import features as ft
from flowlens.operators import sequences as sq
from flowlens.plans.conformance.labels import CHRONO_SQL, CLEAN_SQL, chrono, clean
from flowlens.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES

SEQ_VALUES = ["orig_pkts", "resp_pkts"]
UDF_WEIGHTS, UDF_BIAS = [0.35, -0.5], -1.2


def train(spark, sf):
    return chrono(spark, sf).where(F.col("split") == "train")


def model(spark, sf):
    return ft.fit_features(train(spark, sf))


def _r(cols):
    return [F.round(F.col(c), 6).alias(c) for c in cols]


def q_feature_medians(spark, sf):
    m = ft.exact_medians(train(spark, sf))
    return m.select("feature", F.round("median", 6).alias("median"))


def q_feature_moments(spark, sf):
    t = train(spark, sf)
    med = {r["feature"]: r["median"] for r in ft.exact_medians(t).collect()}
    m = ft.feature_moments(t, med)
    return m.select("feature", *_r(["mean", "std"]))


def q_category_vocab(spark, sf):
    return ft.category_vocab(train(spark, sf))


def q_impute_median(spark, sf):
    m = model(spark, sf)
    c = clean(spark, sf)
    return c.select("uid", *[F.round(F.expr(m.imputed_sql(x)), 6).alias(x) for x in NUMERIC_FEATURES])


def q_impute_constant(spark, sf):
    m = model(spark, sf)
    return clean(spark, sf).select("uid", *[F.expr(m.category_sql(x)).alias(x)
                                            for x in CATEGORICAL_FEATURES])


def q_standardize(spark, sf):
    p = ft.fit_features(train(spark, sf), categorical=[]).scale(clean(spark, sf))
    return p.select("uid", *_r([f"f_{c}" for c in NUMERIC_FEATURES]))


def _hot(m):
    """Where a prepared row's one-hot block has ones: the slots of its values, counted over all
    categorical columns; null for a value that is unseen or zeroed."""
    first, out = 0, []
    for c in CATEGORICAL_FEATURES:
        out.append(F.when(F.col(f"s_{c}") < m.size(c), F.col(f"s_{c}") + first))
        first += m.size(c)
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def q_one_hot(spark, sf):
    m = model(spark, sf)
    p = m.slots(clean(spark, sf))
    return p.select("uid", F.explode(_hot(m)).alias("slot"))


def q_assembled(spark, sf):
    """the vector itself, as (position, value) of its entries beyond the numeric block and the
    sum of the block."""
    m = model(spark, sf)
    v = vector_to_array("features")
    p = m.transform(clean(spark, sf)).select("uid", v.alias("v"))
    n = len(NUMERIC_FEATURES)
    hot = F.filter(F.transform("v", lambda x, i: F.when((i >= n) & (x == 1.0), i)), lambda i: i.isNotNull())
    numbers = [F.round(F.get("v", F.lit(i)), 6).alias(f"v{i}") for i in range(n)]
    return p.select("uid", F.size("v").alias("width"), *numbers, F.array_join(hot.cast("array<string>"), ",").alias("hot"))


def _ablated(spark, sf, **kw):
    m = model(spark, sf)
    p = m.prepare(clean(spark, sf), **kw)
    return p.select("uid", *_r([f"f_{c}" for c in NUMERIC_FEATURES]), F.size(_hot(m)).cast("double").alias("n_hot"))


def q_ablate_numeric(spark, sf):
    return _ablated(spark, sf, zero_numeric=True)


def q_ablate_categorical(spark, sf):
    return _ablated(spark, sf, zero_categorical=True)


def _windows(spark, sf, pad):
    return sq.sequence_windows(clean(spark, sf), ["ts", "uid"], SEQ_VALUES, pad=pad,
                               keep=["uid", "y"], member_cols=["uid"])


def _members(w):
    return F.array_join(F.transform("members", lambda m: m["uid"]), ",").alias("members")


def q_seq_windows_full(spark, sf):
    w = _windows(spark, sf, pad=False)
    s = F.aggregate("seq", F.lit(0.0), lambda a, v: a + v[0]).cast("bigint").alias("sum_orig_pkts")
    return w.select("uid", "y", "n_real", _members(w), s)


def q_seq_windows_padded(spark, sf):
    w = _windows(spark, sf, pad=True)
    s = F.aggregate("seq", F.lit(0.0), lambda a, v: a + v[0]).cast("bigint").alias("sum_orig_pkts")
    return w.select("uid", "n_real", (F.lit(5) - F.col("n_real")).alias("pad"), _members(w), s,
                    F.size("seq").alias("length"))


def q_udf_scores(spark, sf):
    s = sq.score_sequences(clean(spark, sf), ["ts", "uid"], SEQ_VALUES, sq.logistic_model(UDF_WEIGHTS, UDF_BIAS), keep=["uid", "y"])
    return s.select("uid", "y", F.round("score", 6).alias("score"))


QUERIES = {
    "feature_medians": q_feature_medians,
    "feature_moments": q_feature_moments,
    "category_vocab": q_category_vocab,
    "impute_median": q_impute_median,
    "impute_constant": q_impute_constant,
    "standardize": q_standardize,
    "one_hot": q_one_hot,
    "assembled_vector": q_assembled,
    "ablate_numeric": q_ablate_numeric,
    "ablate_categorical": q_ablate_categorical,
    "seq_windows_full": q_seq_windows_full,
    "seq_windows_padded": q_seq_windows_padded,
    "udf_scores": q_udf_scores,
}

# ---- oracle SQL ------------------------------------------------------------------------------

TRAIN = f"SELECT * FROM ({CHRONO_SQL}) s WHERE split = 'train'"
_NUM = NUMERIC_FEATURES
_CAT = CATEGORICAL_FEATURES
MEDIANS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, median(CAST({c} AS DOUBLE)) AS median FROM ({TRAIN}) t" for c in _NUM)
STATS = f"""WITH m AS (SELECT {', '.join(f"median(CAST({c} AS DOUBLE)) AS md_{c}" for c in _NUM)} FROM ({TRAIN}) t),
i AS (SELECT {', '.join(f"coalesce(CAST({c} AS DOUBLE), md_{c}) AS {c}" for c in _NUM)} FROM ({TRAIN}) t, m)
SELECT m.*, {', '.join(f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}" for c in _NUM)}
FROM i, m GROUP BY ALL"""
PREP = f"""SELECT c.uid, {', '.join(f"(coalesce(CAST(c.{x} AS DOUBLE), st.md_{x}) - st.mu_{x}) / st.sd_{x} AS f_{x}" for x in _NUM)},
  {', '.join(f"coalesce(c.{x}, 'unknown') AS c_{x}" for x in _CAT)}
FROM ({CLEAN_SQL}) c, ({STATS}) st"""
VOCAB = " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS feature, coalesce({c}, 'unknown') AS value FROM ({TRAIN}) t" for c in _CAT)
_OFFSETS = " ".join(
    f"WHEN '{c}' THEN " + (" + ".join(f"(SELECT count(*) FROM v WHERE feature = '{p}')" for p in _CAT[:i]) or "0")
    for i, c in enumerate(_CAT))
SLOTS = f"""WITH v AS ({VOCAB})
SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1
  + CASE feature {_OFFSETS} END AS slot FROM v"""
_SEQ_FRAME = "WINDOW f AS (ORDER BY ts, uid ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
SEQ = f"""SELECT uid, y, count(*) OVER f AS n_real, array_to_string(list(uid) OVER f, ',') AS members,
  CAST(sum(orig_pkts) OVER f AS BIGINT) AS sum_orig_pkts,
  avg(CAST(orig_pkts AS DOUBLE)) OVER f AS a_op, avg(CAST(resp_pkts AS DOUBLE)) OVER f AS a_rp
FROM ({CLEAN_SQL}) c {_SEQ_FRAME}"""
_W0, _W1 = (f"CAST({w} AS DOUBLE)" for w in UDF_WEIGHTS)

ORACLE = {
    "feature_medians": f"SELECT feature, round(median, 6) AS median FROM ({MEDIANS}) m",
    "feature_moments": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(mu_{c}, 6) AS mean, round(CASE WHEN sd_{c} = 1.0 THEN 0.0 ELSE sd_{c} END, 6) AS std FROM ({STATS}) s"
        for c in _NUM),
    "category_vocab": VOCAB,
    "impute_median": f"""WITH m AS (SELECT {', '.join(f"median(CAST({c} AS DOUBLE)) AS md_{c}" for c in _NUM)} FROM ({TRAIN}) t)
SELECT uid, {', '.join(f"round(coalesce(CAST({c} AS DOUBLE), md_{c}), 6) AS {c}" for c in _NUM)} FROM ({CLEAN_SQL}) c, m""",
    "impute_constant": f"SELECT uid, {', '.join(f'coalesce({c}, ' + chr(39) + 'unknown' + chr(39) + f') AS {c}' for c in _CAT)} FROM ({CLEAN_SQL}) c",
    "standardize": f"SELECT uid, {', '.join(f'round(f_{c}, 6) AS f_{c}' for c in _NUM)} FROM ({PREP}) p",
    "one_hot": f"""WITH p AS ({PREP}), s AS ({SLOTS})
{' UNION ALL '.join(f"SELECT p.uid, s.slot FROM p JOIN s ON s.feature = '{c}' AND s.value = p.c_{c}" for c in _CAT)}""",
    "assembled_vector": f"""WITH p AS ({PREP}), s AS ({SLOTS}),
h AS ({' UNION ALL '.join(f"SELECT p.uid, s.slot FROM p JOIN s ON s.feature = '{c}' AND s.value = p.c_{c}" for c in _CAT)}),
j AS (SELECT uid, string_agg(CAST(slot + {len(_NUM)} AS VARCHAR), ',' ORDER BY slot) AS hot FROM h GROUP BY uid)
SELECT p.uid, CAST((SELECT count(*) FROM s) + {len(_NUM)} AS INTEGER) AS width, {', '.join(f'round(f_{c}, 6) AS v{i}' for i, c in enumerate(_NUM))},
  coalesce(hot, '') AS hot FROM p LEFT JOIN j USING (uid)""",
    "ablate_numeric": f"""WITH p AS ({PREP}), s AS ({SLOTS})
SELECT p.uid, {', '.join(f'CAST(0.0 AS DOUBLE) AS f_{c}' for c in _NUM)},
  CAST(({' + '.join(f"(SELECT count(*) FROM s WHERE s.feature = '{c}' AND s.value = p.c_{c})" for c in _CAT)}) AS DOUBLE) AS n_hot FROM p""",
    "ablate_categorical": f"SELECT uid, {', '.join(f'round(f_{c}, 6) AS f_{c}' for c in _NUM)}, CAST(0.0 AS DOUBLE) AS n_hot FROM ({PREP}) p",
    "seq_windows_full": f"SELECT uid, y, n_real, members, sum_orig_pkts FROM ({SEQ}) s WHERE n_real = 5",
    "seq_windows_padded": f"""SELECT uid, n_real, 5 - n_real AS pad, members, sum_orig_pkts, 5 AS length FROM ({SEQ}) s""",
    "udf_scores": f"""SELECT uid, y, round(1 / (1 + exp(-({_W0} * a_op + {_W1} * a_rp + CAST({UDF_BIAS} AS DOUBLE)))), 6) AS score
FROM ({SEQ}) s WHERE n_real = 5""",
}
