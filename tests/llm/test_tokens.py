import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers

from flowlens.llm import bpe, queries, token_counts

from .conftest import SF, make_docs, rows_of

ODD = ["'s", "'re", " ", "  ", "\n", "\t", " ", "　", "é", "ß", "1", "²", "Ⅷ", "漢字", "😀", "é", "\x1c", "\x85", "a", "don't",
       "<|endoftext|>", "...", "aaaa", "﻿", "\r\n", "'ll", "x" * 50, "ª", "·"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))


@pytest.fixture(scope="module")
def lines():
    return bpe.load_ranks(public_tokenizers.path(bpe.RANK_FILE))


def odd_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_counts_equal_the_library(library):
    import json

    with open(public_tokenizers.path(token_counts.VOCABULARY), encoding="utf-8") as f:
        counter = token_counts.TokenCounter(token_counts.MergeTable(json.load(f)), public_tokenizers.PATTERN)
    texts = odd_texts(400, 1) + ["", "a" * 3000, "ab" * 3000]
    assert counter(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_encoding_in_pieces_equals_the_library(lines):
    whole = bpe.encoder(lines, public_tokenizers.PATTERN)
    for t in odd_texts(400, 2):
        assert bpe.encode_text(t, lines, public_tokenizers.PATTERN, limit=5) == whole.encode_ordinary(t)
        assert "".join(bpe.safe_pieces(t, 3)) == t


def test_long_white_space_is_encoded(lines):
    for t in (" " * 300_000 + "x", "\n" * 200_000, "\t" * 100_000 + " y"):
        assert whole_bytes(lines, bpe.encode_text(t, lines, public_tokenizers.PATTERN)) == t.encode()


def whole_bytes(lines, ids):
    return bpe.encoder(lines, public_tokenizers.PATTERN).decode_bytes(ids)


def test_operators_on_edge_rows(spark, edge_docs, edge_rows, library, lines):
    counted = rows_of(token_counts.count_tokens(edge_docs))
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024)
            for i, t in edge_rows]
    assert counted == sorted(want, key=repr)
    digests = rows_of(bpe.round_trip(edge_docs))
    want = []
    for i, t in edge_rows:
        ids = bpe.encode_text(t or "", lines, public_tokenizers.PATTERN)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert digests == sorted(want, key=repr)


def test_array_ids_decode_too(spark):
    docs = make_docs(spark, [(1, "Some text, twice."), (2, None)])
    coded = bpe.encode(docs)
    assert dict(coded.dtypes)["ids"] == "array<int>"
    assert rows_of(bpe.decode(coded)) == [(1, bytearray(b"Some text, twice.")), (2, bytearray(b""))]


def test_verified_ids(spark, edge_docs):
    plain, checked = bpe.encode(edge_docs), bpe.encode(edge_docs, verify=True)
    assert rows_of(checked.drop("decoded_sha256")) == rows_of(plain)
    assert rows_of(checked.select("doc_id", "decoded_sha256")) == rows_of(bpe.round_trip(edge_docs).select("doc_id", "decoded_sha256"))


def test_empty_table(no_docs):
    assert token_counts.count_tokens(no_docs).count() == 0
    assert bpe.round_trip(no_docs).count() == 0


def test_queries(spark):
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.encoder(
        bpe.load_ranks(public_tokenizers.path(bpe.RANK_FILE)), public_tokenizers.PATTERN)._mergeable_ranks, special_tokens={})
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op10_byte_bpe(spark, SF).collect()}
    assert got.keys() == docs.keys()
    counts = {r["doc_id"]: r["n_tokens"] for r in queries.op5_token_counts(spark, SF).collect()}
    for i, t in docs.items():
        ids = whole.encode_ordinary(t)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["n_tokens"] == len(ids) == counts[i]
