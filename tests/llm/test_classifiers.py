import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import quality, queries, toxicity

from .conftest import SF, make_docs, rows_of

SF_MORE = "/root/testdata/sf0.01"


def auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    return (rank[y == 1].mean() - rank[y == 0].mean()) / len(y) + 0.5


def corpus(words, n=600):
    """Texts of common words; the bad ones have words from two stems."""
    r = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(20, 200))]
        bad = i % 6 == 0
        if bad:
            for _ in range(max(1, len(text) // 40)):
                text.insert(r.randrange(len(text)), r.choice(["grunzwo", "flebzak"]) + r.choice(words))
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 > 0), int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def labelled(spark, words):
    rows, labels = corpus(words)
    return make_docs(spark, rows), spark.createDataFrame([(*x, "z") for x in labels + [(None, 1, 1), (1, None, None), (9999, 1, 1)]],
                                                         "doc_id bigint, quality int, toxic int, text string")


def test_toxic_stems_are_caught_and_clean_texts_left_alone(labelled):
    docs, labels = labelled
    got = toxicity.score_documents(docs, labels).where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    assert len(got) > 150
    assert np.mean([r["predicted"] for r in got if r["toxic"] == 1]) > 0.9
    assert np.mean([r["predicted"] for r in got if r["toxic"] == 0]) < 0.01


def test_held_out_rows_do_not_teach(spark, labelled):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic"))
                               .otherwise(F.col("toxic")))
    assert rows_of(toxicity.score_documents(docs, labels)) == rows_of(toxicity.score_documents(docs, turned))


@pytest.mark.parametrize("score", [toxicity.score_documents, quality.score_documents])
def test_edge_rows_and_no_labels(spark, edge_docs, edge_rows, no_docs, labelled, score):
    _, labels = labelled
    for known in (labels, labels.limit(0), labels.where("toxic = 0 and quality = 1")):
        got = score(edge_docs, known).collect()
        assert sorted((r["doc_id"] for r in got), key=repr) == sorted((i for i, _ in edge_rows), key=repr)
        assert all(0 <= r["score"] <= 1 for r in got)
        fold = (3, 1) if score is toxicity.score_documents else (5, 0)
        assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % fold[0] == fold[1]) for r in got)
        by_text = {}
        for (i, t), r in zip(sorted(edge_rows, key=repr), sorted(((r["doc_id"], r["score"]) for r in got), key=repr)):
            if i is not None and i != 7:
                by_text.setdefault(t or "", set()).add(r[1])
        assert all(len(x) == 1 for x in by_text.values())
    assert score(no_docs, labels).count() == 0


def test_filters_keep_columns_and_rows_below_the_threshold(spark, edge_docs, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels, ~toxicity.held_out())
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scores.items() if s < toxicity.THRESHOLD}
    good = quality.fit(docs, labels, ~quality.held_out())
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, good).collect()}
    assert {r["doc_id"] for r in quality.keep_good(docs, good).collect()} == {i for i, s in scores.items() if s >= quality.THRESHOLD}
    assert toxicity.drop_toxic(edge_docs, model).count() > 0 and quality.keep_good(edge_docs, good).columns == edge_docs.columns


def test_long_texts_are_read_to_the_end(words):
    every = np.ones(1 << toxicity.BITS, bool)
    text = " ".join(words) * 3 + " the end"
    whole = set(toxicity.present(text, every).tolist())
    part, toxicity.PART = toxicity.PART, 64
    try:
        assert set(toxicity.present(text, every).tolist()) == whole
    finally:
        toxicity.PART = part
    part, quality.PART = quality.PART, 1000
    try:
        in_parts = quality.statistics(text)
    finally:
        quality.PART = part
    assert np.allclose(in_parts, quality.statistics(text), atol=1e-3)


def test_features_approximate_the_gaussian_kernel():
    r = np.random.default_rng(0)
    n = len(quality.NAMES)
    width = np.sqrt(n)
    model = quality.Model(np.zeros(n), np.ones(n), r.normal(0, 1 / width, (n, 4096)), r.uniform(0, 2 * np.pi, 4096), None, None, None)
    x = r.normal(0, 1, (20, n))
    z = model.features(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * width**2))
    assert np.abs(z @ z.T - want).max() < 0.1


def test_partition_sums_equal_one_sum(spark):
    r = np.random.default_rng(1)
    n = len(quality.NAMES)
    model = quality.Model(np.zeros(n), np.ones(n), r.normal(0, 1, (n, 16)), r.uniform(0, 6, 16), None, None, None)
    x, y = r.normal(0, 1, (50, n)), r.integers(0, 2, 50)
    df = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)], "stats array<double>, label int").repartition(5)
    zz, zy = quality.normal_equations(df, model)
    z = model.features(x)
    assert np.allclose(zz, z.T @ z) and np.allclose(zy, z.T @ y)


def test_isotonic_is_ascending_and_pools():
    r = np.random.default_rng(2)
    s = r.normal(0, 1, 500)
    y = (r.random(500) < 1 / (1 + np.exp(-3 * s))).astype(float)
    points, values = quality.isotonic(s, y)
    assert (np.diff(points) > 0).all() and (np.diff(values) > -0.5).all()
    p, v = quality.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert len(p) == 3 and p[1] == 2.5


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: (r["toxic"], r["quality"]) for r in spark.read.parquet(f"{SF_MORE}/labels.parquet").collect()}
    for query, k, least in ((queries.op1_toxicity, 0, 0.85), (queries.op6_quality, 1, 0.97)):
        got = [(r["score"], labels[r["doc_id"]][k]) for r in query(spark, SF_MORE).collect() if r["held_out"] and r["doc_id"] in labels]
        s, y = np.array(got).T
        assert auc(s, y) > least


def test_query_scores_every_document(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert queries.op1_toxicity(spark, SF).count() == queries.op6_quality(spark, SF).count() == n


def plain_buckets(text):
    """Buckets of the 3- to 5-grams of a padded, lower-cased text, one n-gram at a time."""
    s, out = f" {text.lower()} ", set()
    for n in (3, 4, 5):
        for i in range(len(s) - n + 1):
            h = ord(s[i])
            for c in s[i + 1:i + n]:
                h = (h * 0x01000193 + ord(c)) % 2**32
            out.add(((h * 0x9E3779B1 + n) * 0x85EBCA6B % 2**32) >> (32 - 18))
    return out


def test_toxicity_equals_a_plain_version(spark, words, monkeypatch):
    """Buckets, chi-square, log-count ratios, the optimum of the weights and the scores of a query."""
    monkeypatch.setattr(toxicity, "CHI_SQUARES", (8.0,))
    rows, labels = corpus(words, 150)
    rows = [(i, t[:200] if i % 6 else t[:400]) for i, t in rows] + [(1000, None), (1001, ""), (1002, "ab")]
    docs = make_docs(spark, rows)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, known, ~toxicity.held_out())
    found = {i: plain_buckets(t or "") for i, t in rows}
    teach = [(found[i], y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    n1, n0 = sum(y for _, y in teach), sum(1 - y for _, y in teach)
    ratio = {}
    for b in set().union(*(f for f, _ in teach)):
        p, q = sum(b in f for f, y in teach if y), sum(b in f for f, y in teach if not y)
        n, rest = n0 + n1, n0 + n1 - p - q
        if p + q >= 3 and rest and n * (p * (n0 - q) - q * (n1 - p)) ** 2 / ((p + q) * rest * n0 * n1) >= 8:
            ratio[b] = np.log((p + 0.5) / (n1 + 1)) - np.log((q + 0.5) / (n0 + 1))
    assert ratio and set(np.flatnonzero(model.weights)) <= set(ratio)
    w = {b: model.weights[b] / r for b, r in ratio.items()}
    weight = [np.sqrt(n0 / n1) if y else 1.0 for _, y in teach]
    pull = [k / sum(weight) * (1 / (1 + np.exp(-sum(w[b] * ratio[b] for b in f & w.keys()) - model.bias)) - y) for k, (f, y) in zip(weight, teach)]
    gradient = [sum(g * ratio[b] for g, (f, _) in zip(pull, teach) if b in f) + 1e-3 * w[b] for b in w] + [sum(pull)]
    assert np.abs(gradient).max() < 2e-3
    scored = {r["doc_id"]: r for r in toxicity.score_documents(docs, known).collect()}
    for i, f in found.items():
        z = sum(float(model.weights[b]) for b in f if b in ratio) + model.bias
        assert abs(scored[i]["score"] - 1 / (1 + np.exp(-z))) < 1e-5
        assert scored[i]["predicted"] == (scored[i]["score"] >= 0.7)


def test_repeated_ids_do_not_break_the_bound_on_teaching_rows(spark, labelled):
    """100,000 rows of one labelled id under a bound of 10: at most 10 teaching rows, one for the id."""
    docs, labels = labelled
    many = spark.range(100_000).select(F.lit(2).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 7).alias("text"))
    rows = toxicity.texts(many.unionByName(docs.select("doc_id", "text")), "doc_id", "text")
    chosen = toxicity.sample_labels(labels, "toxic", F.col("doc_id") < 12, 10)
    got = toxicity.labelled_texts(rows, chosen, 10).collect()
    assert len(got) == 10 and len({r["doc_id"] for r in got}) == 10
    assert toxicity.labelled_texts(rows, toxicity.sample_labels(labels, "toxic", F.col("doc_id") == 2, 10), 10).count() == 1
    null = spark.createDataFrame([(1, None), (1, None)], "doc_id bigint, text string")
    only = toxicity.labelled_texts(null, toxicity.sample_labels(labels, "toxic", F.col("doc_id") == 1, 10), 10).collect()
    assert len(only) == 1 and only[0]["text"] is None
