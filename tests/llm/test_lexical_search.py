import math
import re
from collections import Counter

import pytest

from flowlens.llm import lexical_search as ls
from flowlens.llm.base import scratch
from tests.llm.conftest import make_docs, rows_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, k=10):
    """The contract word by word: [(item_id, rank, doc_id, score)]."""
    docs = [(i, Counter(t), len(t)) for i, t in ((i, plain_terms(x)) for i, x in docs) if t]
    n_docs, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in docs:
            m = 100 - 75 + (75 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in plain_terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def as_items(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id bigint, text string, rank string")


@pytest.fixture(scope="module")
def questions(words, edge_rows):
    texts = [" ".join(words[i:i + 12]) for i in range(0, 120, 12)]
    return [*enumerate(texts), (50, None), (51, ""), (52, "...!"), (53, "nosuchterm"), (3, texts[4] + " " + texts[4]),
            (54, edge_rows[5][1].upper()), (55, "漢字 😀 X" + "x" * 69_999), (56, "é É e")]


def test_equals_the_contract(spark, edge_docs, edge_rows, questions):
    found = ls.rank_items(edge_docs, as_items(spark, questions))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(found) == plain(edge_rows, questions)


@pytest.mark.parametrize("limits", [{"STRATUM_DOCS": 2, "BLOCK_ITEMS": 3}, {"BLOCK_TERMS": 5}])
def test_small_strata_chunks_and_blocks_change_nothing(spark, edge_docs, edge_rows, questions, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ls, name, value)
    index = ls.build_index(edge_docs.repartition(3), scratch(spark, "index"), chunk=50)
    assert rows_of(ls.search(index, as_items(spark, questions), k=4)) == plain(edge_rows, questions, 4)


def test_copies_tie_by_id_and_rows_without_one_come_last(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)] + [(None, "same words here"), (500, "other text")] + [(1, "same words here")]
    found = ls.rank_items(make_docs(spark, docs), as_items(spark, [(1, "words")]))
    assert [r["doc_id"] for r in found.orderBy("rank").collect()] == [1, 1, *range(2, 10)]
    few = [(None, "a b"), (2, "a b"), (3, "c")]
    assert rows_of(ls.rank_items(make_docs(spark, few), as_items(spark, [(1, "a")]))) == plain(few, [(1, "a")])


def test_strata_hold_every_posting_once(spark, edge_docs, edge_rows):
    index = ls.build_index(edge_docs, scratch(spark, "index"))
    texts = [plain_terms(t) for _, t in edge_rows]
    assert (index.documents, index.terms) == (sum(map(bool, texts)), sum(map(len, texts)))
    strata = [s for part in ls.unpacked(index.read(spark).toArrow().to_batches()) for s in part.to_pylist()]
    assert sum(len(s["members"]) for s in strata) == sum(len(set(t)) for t in texts)
    assert sum(len(s["doc_ids"]) for s in strata) == index.documents
    for s in strata:
        assert sum(s["groups"]) == len(s["tfs"]) == len(s["sizes"]) and sum(s["sizes"]) == len(s["members"])


def test_empty_tables(spark, no_docs, edge_docs, questions):
    assert ls.rank_items(no_docs, as_items(spark, questions)).count() == 0
    found = ls.rank_items(edge_docs, as_items(spark, []))
    assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]
    assert ls.rank_items(make_docs(spark, [(1, None), (2, " -- ")]), as_items(spark, questions)).count() == 0


def test_scores_beyond_doubles_stay_exact(spark):
    docs = [(1, "a " * 3 + "b"), (2, "a"), (3, "c " * 50), (4, "d")]
    items = [(1, "a b " * 400_000 + "c")]
    assert rows_of(ls.rank_items(make_docs(spark, docs), as_items(spark, items))) == plain(docs, items)
