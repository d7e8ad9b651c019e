"""Benchmark decontamination: a broadcast set of test n-grams scanned over training texts.

Words are runs of letters and digits with A-Z lower-cased; every character beyond ASCII counts
as a letter.  A benchmark item gives its windows of ``n`` consecutive words, or all of its
words as one window if it has fewer.  Windows become numpy arrays of word numbers with a 64-bit
hash each, sorted; a task numbers a text's words by the benchmark's vocabulary, hashes the
windows that consist of known words, looks them up, and compares the word numbers of every
candidate, so a hash that agrees by chance is no hit.

The (window, item) pairs are counted first.  Up to ``BLOCK_PAIRS`` of them are one broadcast and
the scan is a map without a shuffle.  Beyond that they are dealt by hash into blocks of about
that size, taken one after another: a block is broadcast, scans all documents, its hits (not the
texts) are written to the shared folder, and it is released before the next is built.  So the
driver and every executor hold one block at any size of the benchmark; documents are read once
a block, and the hits of all blocks meet in an aggregation by document.  A long item's words are cut
into overlapping pieces of ``PIECE_WORDS`` windows before its windows are spelled out.

Cases: null and empty texts have no words and no hits; items without words have no window; an
item's windows that repeat count once, and an item_id that repeats is one item; a null item_id
is written as an empty string; repeated rows of documents give repeated results.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.base import map_rows, settle, texts

WINDOW = 10
BLOCK_PAIRS = 1_000_000
PIECE_WORDS = 4096
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[bytes]:
    return text.encode().translate(BYTES).split()


def windows(bench: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """Distinct (win, item) pairs of a benchmark: space-joined windows and item ids as text."""
    all_words = F.regexp_extract_all(F.translate(F.col("text"), UPPER, LOWER), F.lit(WORD), F.lit(0))
    items = (bench.select(F.coalesce(bench[id_col].cast("string"), F.lit("")).alias("item"),
                          bench[text_col].cast("string").alias("text"))
             .select("item", all_words.alias("words")).where(F.size("words") > 0))
    last = F.greatest(F.size("words") - n, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last, F.lit(PIECE_WORDS)), lambda i: F.slice(F.col("words"), i + 1, PIECE_WORDS + n - 1))
    pieces = items.select("item", F.explode(cut).alias("words"))
    one = F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", F.slice(F.col("words"), i + 1, n)))
    return pieces.select(F.explode(one).alias("win"), "item").distinct()


class WindowSet:
    """The windows of one block, by length, as sorted hashes over word numbers."""

    def __init__(self, pairs: list[tuple[str, str]]):
        by_window: dict[str, list[str]] = {}
        for win, item in sorted(pairs):
            by_window.setdefault(win, []).append(item)
        self.vocab: dict[bytes, int] = {}
        lengths: dict[int, list] = {}
        for win, items in by_window.items():
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in win.encode().split(b" ")]
            lengths.setdefault(len(ids), []).append((ids, items))
        self.lengths = []
        for n, found in sorted(lengths.items()):
            ids = np.array([x[0] for x in found], np.int64)
            h = self._hash(ids, np.zeros(len(ids), np.int64), n, flat=False)
            order = np.argsort(h, kind="stable")
            self.lengths.append((n, h[order], ids[order], [found[i][1] for i in order]))

    @staticmethod
    def _hash(ids: np.ndarray, at: np.ndarray, n: int, flat: bool = True) -> np.ndarray:
        h = np.zeros(len(at), np.uint64)
        for j in range(n):
            h = (h + (ids[at + j] if flat else ids[:, j]).astype(np.uint64)) * STEP
            h ^= h >> np.uint64(29)
        return h

    def find(self, found: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Hit word ranges [start, end), merged and in order, and the items that occur."""
        ids = np.fromiter(map(self.vocab.get, found, repeat(0)), np.int64, len(found))
        gaps = np.r_[0, np.cumsum(ids == 0)]
        edge, items = None, set()
        for n, hashes, rows, owners in self.lengths:
            if n > len(ids):
                continue
            at = np.flatnonzero(gaps[n:] == gaps[:-n])
            if not len(at):
                continue
            h = self._hash(ids, at, n)
            k = np.searchsorted(hashes, h)
            while True:  # several windows may share a hash
                live = np.flatnonzero(k < len(hashes))
                live = live[hashes[k[live]] == h[live]]
                if not len(live):
                    break
                at, h, k = at[live], h[live], k[live]
                same = np.ones(len(at), bool)
                for j in range(n):
                    same &= rows[k, j] == ids[at + j]
                if same.any():
                    edge = np.zeros(len(ids) + 1, np.int64) if edge is None else edge
                    np.add.at(edge, at[same], 1)
                    np.add.at(edge, at[same] + n, -1)
                    for x in np.unique(k[same]):
                        items.update(owners[x])
                k = k + 1
        if edge is None:
            return [], []
        inside = np.r_[0, np.cumsum(edge[:-1]) > 0, 0].astype(np.int8)
        turn = np.flatnonzero(np.diff(inside))
        return list(zip(turn[::2].tolist(), turn[1::2].tolist())), sorted(items)


class WindowBlocks:
    """The windows of a benchmark in ``count`` blocks of about ``block_pairs`` (window, item) pairs."""

    def __init__(self, bench: DataFrame, id_col: str, text_col: str, n: int, block_pairs: int):
        pairs = settle(windows(bench, id_col, text_col, n))
        self.count = max(1, -(-pairs.count() // block_pairs))
        self.dealt = pairs.withColumn("block", F.pmod(F.xxhash64("win", "item"), F.lit(self.count)))

    def broadcast(self, b: int):
        rows = self.dealt.where(F.col("block") == b).select("win", "item").collect()
        return self.dealt.sparkSession.sparkContext.broadcast(WindowSet([tuple(r) for r in rows]))


SPANS = "array<struct<start:int,end:int>>"


def _scan(rows: DataFrame, block) -> DataFrame:
    def make():
        known = block.value

        def work(part):
            n, spans, items = [], [], []
            for t in part:
                w = words(t)
                s, i = known.find(w)
                n.append(len(w))
                spans.append([{"start": a, "end": b} for a, b in s])
                items.append(i)
            return [n, spans, items]

        return work

    return map_rows(rows, f"n_words bigint, spans {SPANS}, items array<string>", make)


def _text_key() -> Column:
    return F.concat_ws(":", F.xxhash64("text").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit(""))))


def _block_hits(rows: DataFrame, blocks: WindowBlocks) -> DataFrame:
    """(key, doc_id, spans, items) of the documents that some block hits; equal texts of one
    doc_id are one document here.  Hits move, texts don't.  A block's hits are written before the
    next block is built, so one block at a time is held."""
    keyed = rows.select(F.struct("doc_id", _text_key().alias("key")).alias("doc_id"), "text")
    union = None
    for b in range(blocks.count):
        block = blocks.broadcast(b)
        hits = settle(_scan(keyed, block).where(F.size("spans") > 0).dropDuplicates(["doc_id"]))
        block.destroy()
        union = hits if union is None else union.unionByName(hits)
    return union.groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                       F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def merge_spans(spans: Column) -> Column:
    """Union of word ranges as ordered, disjoint ranges."""
    def add(done, x):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
                          F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


def scan(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, item_col: str = "item_id",
         item_text_col: str = "text", n: int = WINDOW, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """(doc_id, n_words, spans, items) of every row: hit word ranges and the items that occur."""
    rows = texts(docs, id_col, text_col)
    blocks = WindowBlocks(bench, item_col, item_text_col, n, block_pairs)
    if blocks.count == 1:
        return _scan(rows, blocks.broadcast(0))
    hits = _block_hits(rows, blocks).select(F.col("doc_id").alias("hit"), "spans", "items")
    counted = _scan(rows.select(F.struct("doc_id", _text_key().alias("key")).alias("doc_id"), "text"),
                    rows.sparkSession.sparkContext.broadcast(WindowSet([]))).select("doc_id", "n_words")
    both = counted.join(hits, F.col("doc_id").eqNullSafe(F.col("hit")), "left")
    return both.select(F.col("doc_id.doc_id").alias("doc_id"), "n_words",
                       merge_spans(F.coalesce("spans", F.array().cast(SPANS))).alias("spans"),
                       F.coalesce(F.array_sort("items"), F.array().cast("array<string>")).alias("items"))


def cut_words(text: str, spans) -> str:
    """The text without the words of the given ranges and what stands between them."""
    at = [m.span() for m in CASED_WORD.finditer(text)]
    out, done = [], 0
    for s in spans:
        out.append(text[done:at[s["start"]][0]])
        done = at[s["end"] - 1][1]
    return "".join(out) + text[done:]


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  item_col: str = "item_id", item_text_col: str = "text", n: int = WINDOW, remove: str = "documents",
                  block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``docs`` with all of its columns, without the documents that hold a benchmark window, or
    with ``remove="spans"`` without those words.  A null text stays null."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is documents or spans")
    blocks = WindowBlocks(bench, item_col, item_text_col, n, block_pairs)
    if blocks.count > 1:
        rows = texts(docs, id_col, text_col)
        hits = _block_hits(rows, blocks).select(F.col("doc_id.doc_id").alias("_hit_id"), F.col("doc_id.key").alias("_hit_key"),
                                                "spans")
        key = F.concat_ws(":", F.xxhash64(docs[text_col].cast("string")).cast("string"),
                          F.md5(F.coalesce(docs[text_col].cast("string"), F.lit(""))))
        same = docs[id_col].eqNullSafe(hits["_hit_id"]) & (key == hits["_hit_key"])
        if remove == "documents":
            return docs.join(hits, same, "left_anti")
        cut = F.pandas_udf(lambda t, s: pd.Series([cut_words(a, merged(b)) if a and b is not None and len(b) else a
                                                  for a, b in zip(t, s)]), "string")
        found = docs.join(hits, same, "left")
        return found.select(*[cut(docs[text_col], hits["spans"]).alias(c) if c == text_col else docs[c] for c in docs.columns])
    block = blocks.broadcast(0)
    if remove == "documents":
        clean = F.pandas_udf(lambda t: pd.Series([not x or not block.value.find(words(x))[0] for x in t], dtype=bool), "boolean")
        return docs.where(clean(docs[text_col]))

    def without(t: str | None) -> str | None:
        spans = block.value.find(words(t))[0] if t else []
        return cut_words(t, [{"start": a, "end": b} for a, b in spans]) if spans else t

    cut = F.pandas_udf(lambda t: pd.Series([without(x) for x in t]), "string")
    return docs.withColumn(text_col, cut(docs[text_col]))


def merged(spans) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda x: (x["start"], x["end"])):
        if out and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append({"start": s["start"], "end": s["end"]})
    return out


def report(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) from ``scan``'s results."""
    found = scan(docs, bench, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + (s["end"] - s["start"]).cast("bigint"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))
