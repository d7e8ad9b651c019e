"""The pipeline against a plain version of its stages, one after the other."""

import hashlib
import zlib

import corpus_pipeline
import __spark_entry__ as entry
from flowlens.llm import bpe, toxicity

from .conftest import SF, make_docs
from .test_decontamination import brute as contaminated
from .test_secret_scan import base_spans, entropy_spans
from .test_simhash import brute_components, brute_print


def masked(t):
    out, done = "", 0
    for a, _, z, _ in sorted(base_spans(t) + entropy_spans(t)):
        if a > done or not done:
            out += t[done:a] + "[REDACTED]"
        done = max(done, z)
    return out + t[done:]


def test_pipeline_equals_its_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), ~toxicity.held_out())
    score = model.scorer()
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect() if score(r["text"]) < toxicity.THRESHOLD)
    roots = brute_components([brute_print(t) for _, t in rows])
    rows = [x for k, x in enumerate(rows) if roots[k] == k]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {x[0] for x in contaminated(rows, bench) if x[5]}
    texts = {i: masked(t) for i, t in rows if i not in hit}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert got.keys() == texts.keys()
    import public_tokenizers

    lines = bpe.load_ranks(public_tokenizers.path(bpe.RANK_FILE))
    for i, t in texts.items():
        assert list(got[i]["ids"]) == bpe.encode_text(t, lines, public_tokenizers.PATTERN)
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest() and got[i]["n_tokens"] == len(got[i]["ids"])


def test_stages_keep_the_columns(spark, edge_docs, no_docs, tmp_path):
    for source in (edge_docs, no_docs):
        docs = source
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if k < 4:
                assert out.columns == source.columns
            path = f"{tmp_path}/{id(source)}-{k}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.columns[0] == "doc_id"


def test_lengths_follow_masked_texts(spark):
    docs = make_docs(spark, [(1, "my password=abcdefgh1 ends"), (2, "clean"), (3, None)])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.mask_secrets(spark, docs, SF).collect()}
    assert got == {1: ("my [REDACTED] ends", 18), 2: ("clean", 5), 3: (None, None)}


def test_registration():
    names = [k for k in entry.queries() if k.startswith("op") and k[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "encoding"]
    assert zlib.crc32(b"1") >= 0
