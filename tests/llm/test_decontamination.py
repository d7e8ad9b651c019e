import hashlib
import re

import pytest

from flowlens.llm import decontamination as d

from .conftest import make_docs, rows_of

WORD = re.compile(d.WORD)
RAISE = str.maketrans(d.LOWER, d.UPPER)
TABLE = str.maketrans(d.UPPER, d.LOWER)


def brute(docs, items):
    win = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(TABLE))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            win.setdefault(tuple(w[k:k + n]), set()).add("" if item is None else str(item))
    out = []
    for i, text in docs:
        w = WORD.findall((text or "").translate(TABLE))
        hit, own = set(), set()
        for n in {len(x) for x in win}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in win:
                    hit.update(range(k, k + n))
                    own |= win[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(words):
    long = " ".join(words[:25])
    return [(1, long), (2, " ".join(words[5:20])), (10, "tiny item"), (3, "one"), (4, None), (5, ""), (6, "..."), (7, long), (7, "Tiny, ITEM!"),
            (None, "nameless item of words")]


@pytest.fixture(scope="module")
def bench(spark, items):
    return spark.createDataFrame([(i, t, "y") for i, t in items], "item_id bigint, text string, win string")


@pytest.fixture(scope="module")
def rows(edge_rows, words):
    return edge_rows + [(200, "Before. " + " ".join(words[:12]).translate(RAISE) + "; after"), (201, " ".join(words[3:12])), (202, "a tiny--item, a nameless item of words"),
                        (203, " ".join(words[:25] + ["gap"] + words[:25])), (204, "ONE"), (203, " ".join(words[10:20]))]


@pytest.mark.parametrize("block_pairs", [1_000_000, 7])
def test_report_equals_brute_force(spark, rows, items, bench, block_pairs):
    got = rows_of(d.report(make_docs(spark, rows), bench, block_pairs=block_pairs))
    assert got == brute(rows, items)


@pytest.mark.parametrize("block_pairs", [1_000_000, 7])
def test_removal(spark, rows, items, bench, block_pairs):
    docs = make_docs(spark, rows)
    hit = {x[0]: x[5] for x in brute([(k, t) for k, (_, t) in enumerate(rows)], items)}
    kept = d.decontaminate(docs, bench, block_pairs=block_pairs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(
        (rows[k] for k in range(len(rows)) if not hit[k]), key=repr)
    cut = d.decontaminate(docs, bench, remove="spans", block_pairs=block_pairs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    texts = {r["doc_id"]: r["text"] for r in cut.collect() if r["doc_id"] in (100, 200, 202, 204)}
    assert texts == {100: None, 200: "Before. ; after", 202: "a , a ", 204: ""}


@pytest.mark.parametrize("piece", [1, 7, 4096])
def test_windows_of_long_items(spark, words, monkeypatch, piece):
    monkeypatch.setattr(d, "PIECE_WORDS", piece)
    texts = {"a": words[:200], "b": words[:10], "c": words[:9], "d": words[:11], "e": words[:17]}
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "item_id string, text string")
    got = {(r["win"], r["item"]) for r in d.windows(bench, "item_id", "text", 10).collect()}
    assert got == {(" ".join(w[k:k + 10]).translate(TABLE), i) for i, w in texts.items() for k in range(max(len(w) - 9, 1))}


def test_one_block_is_held_at_a_time(spark, rows, items, bench, monkeypatch):
    held, most = set(), []
    make = d.WindowBlocks.broadcast

    def counted(self, b):
        block = make(self, b)
        held.add(b)
        most.append(len(held))
        destroy = block.destroy

        def drop(*a, **k):
            held.discard(b)
            destroy(*a, **k)

        block.destroy = drop
        return block

    monkeypatch.setattr(d.WindowBlocks, "broadcast", counted)
    got = d.report(make_docs(spark, rows), bench, block_pairs=9)
    assert len(most) > 2 and max(most) == 1 and not held
    assert rows_of(got) == brute(rows, items)


def test_empty_tables(spark, no_docs, bench):
    assert d.report(no_docs, bench).count() == 0
    docs = make_docs(spark, [(1, "some words"), (2, None)])
    assert [r["contaminated"] for r in d.report(docs, bench.limit(0)).collect()] == [False, False]
    assert d.decontaminate(docs, bench.limit(0)).count() == 2


def test_colliding_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(d.WindowSet, "_hash", staticmethod(lambda ids, at, n, flat=True: (0 * at).astype("u8")))
    known = d.WindowSet([("a b", "1"), ("b a", "2"), ("c d", "3")])
    assert known.find([b"x", b"b", b"a", b"b", b"d"]) == ([(1, 4)], ["1", "2"])
