"""Ranked lexical search over a length-stratified index.

A document's score for a term depends on the document only through its normaliser m (a whole
number that follows its length) and the term's frequency tf in it.  The index is built on that:

* documents of equal m form a *stratum* (in rows of at most ``STRATUM_DOCS`` documents);
* inside a stratum a term's postings lie by tf, the largest first;
* so the impact w * (10^9 tf div (1000 tf + 8 m)) is computed once for each tf of a term and not
  for each posting, and the first tf of every term bounds what the stratum can give any query.

A search takes the strata it has read in the descending order of their bounds and leaves out every query whose
bound is below its k-th best score so far; scores inside a stratum are exact: the table of
impacts (terms x documents) times the counts of the terms in the queries.

Jobs: one pass counts documents and terms (both fix m); one pass turns each input split into
strata, written as Parquet (a row holds the strata of some documents, compressed), with no shuffle; for each block of queries (at most ``BLOCK_ITEMS``
queries and about ``BLOCK_TERMS`` terms, which bounds what tasks are sent) one pass over the
index's term lists sums document frequencies and one searches.  A task emits k rows for a query
at most.  Blocks come one after another from an iterator over the queries.

Cases: null and empty texts, and texts without a term, are in no stratum and never found; a
query without a term has no rows; every row is a document of its own, so rows that repeat an id
are ranked separately; rows without an id come after all others of their score; queries that
repeat an id are answered each.  Ids of documents are integers.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.base import discard, scratch

TOP = 10
STRATUM_DOCS = 512
CHUNK_POSTINGS = 1 << 19
READ_POSTINGS = 1 << 18
BLOCK_ITEMS, BLOCK_TERMS = 256, 1 << 14
INDEX_DDL = "strata int, packed binary"

#: Bytes of a term stay (A-Z lower-cased), all others become a space.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
                    for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text: runs of digits, letters and characters beyond ASCII."""
    return (text or b"").translate(_TERM_BYTES).split()


def normaliser(n: int, documents: int, terms: int) -> int:
    return 100 - 75 + (75 * n * documents) // terms


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def packed(strata: pa.RecordBatch) -> bytes:
    """Strata as one compressed value: (m, doc_ids, terms, groups, tfs, sizes, members) each, where a
    term has some tf groups, and a group some members, which are places in doc_ids."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, strata.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(strata)
    return out.getvalue().to_pybytes()


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strata of index rows, in parts that bound a task's arrays."""
    for batch in batches:
        for value in batch.column("packed"):
            yield from _parts(pa.ipc.open_stream(value.as_buffer()).read_next_batch())


@dataclass
class Index:
    """A written index: its folder, the number of documents with a term, and of their terms."""
    path: str
    documents: int
    terms: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(INDEX_DDL).parquet(self.path)


def _bytes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text"))


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with at least one term, and all their terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for batch in batches:
            for text in batch.column(0):
                n = len(terms_of(text.as_py()))
                documents, terms = documents + (n > 0), terms + n
        yield pa.RecordBatch.from_pydict({"documents": [documents], "terms": [terms]})

    rows = docs.select(docs[text_col].cast("string").cast("binary").alias("text")).mapInArrow(run, "documents bigint, terms bigint")
    r = rows.agg(F.sum("documents").alias("documents"), F.sum("terms").alias("terms")).first()
    return r["documents"] or 0, r["terms"] or 0


def _lists(values: np.ndarray | pa.Array, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values, kind))


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    change = np.ones(len(keys[0]), bool)
    change[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(change)


class _Chunk:
    """Postings of some documents of one task, and the strata they form."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.m: list[int] = []
        self.distinct: list[int] = []
        self.vocabulary: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.term, self.tf = array("i"), array("i")

    def add(self, doc_id: int | None, m: int, counts: Counter) -> None:
        self.ids.append(doc_id)
        self.m.append(m)
        self.distinct.append(len(counts))
        self.term.extend(map(self.vocabulary.__getitem__, counts))
        self.tf.extend(counts.values())

    def strata(self) -> pa.RecordBatch:
        m = np.array(self.m, np.int64)
        by_m = np.argsort(m, kind="stable")
        starts = _runs(m[by_m])
        within = np.arange(len(m)) - np.repeat(starts, np.diff(np.r_[starts, len(m)]))
        heads = np.flatnonzero(within % STRATUM_DOCS == 0)          # the first document of each stratum
        per = np.diff(np.r_[heads, len(m)])
        stratum, member = np.empty(len(m), np.int64), np.empty(len(m), np.int32)
        stratum[by_m] = np.repeat(np.arange(len(heads)), per)
        member[by_m] = within % STRATUM_DOCS
        doc = np.repeat(np.arange(len(m)), self.distinct)
        term, tf = np.frombuffer(self.term, np.int32), np.frombuffer(self.tf, np.int32)
        order = np.lexsort((member[doc], -tf, term, stratum[doc]))
        s, term, tf, member = stratum[doc][order], term[order], tf[order], member[doc][order]
        group = _runs(s, term, tf)
        of_term = _runs(s[group], term[group])
        words = pa.array(list(self.vocabulary), pa.binary())
        n = len(heads)
        return pa.RecordBatch.from_arrays([
            pa.array(m[by_m][heads]), _lists(pa.array(self.ids, pa.int64()).take(pa.array(by_m)), per, pa.int64()),
            _lists(words.take(pa.array(term[group][of_term])), np.bincount(s[group][of_term], minlength=n), pa.binary()),
            _lists(np.diff(np.r_[of_term, len(group)]), np.bincount(s[group][of_term], minlength=n), pa.int32()),
            _lists(tf[group], np.bincount(s[group], minlength=n), pa.int32()),
            _lists(np.diff(np.r_[group, len(s)]), np.bincount(s[group], minlength=n), pa.int32()),
            _lists(member, np.bincount(s, minlength=n), pa.int32())],
            names=["m", "doc_ids", "terms", "groups", "tfs", "sizes", "members"])


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                chunk: int = CHUNK_POSTINGS) -> Index:
    """Write the index of all rows to ``path``.  A task holds about ``chunk`` postings at a time."""
    documents, terms = corpus_size(docs, text_col)

    def row(strata: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([strata.num_rows], pa.int32()), pa.array([packed(strata)], pa.binary())],
                                          names=["strata", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Chunk()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                found = terms_of(text.as_py())
                if found:
                    own.add(doc_id.as_py(), normaliser(len(found), documents, terms), Counter(found))
                if len(own.term) >= chunk:
                    yield row(own.strata())
                    own = _Chunk()
        if own.ids:
            yield row(own.strata())

    _bytes(docs, id_col, text_col).mapInArrow(run, INDEX_DDL).write.parquet(path)
    return Index(path, documents, terms)


class _Block:
    """Some queries: their distinct terms and how often each query has each term."""

    def __init__(self) -> None:
        self.ids: list = []
        self.counts: list[Counter] = []
        self.terms: dict[bytes, int] = {}

    def add(self, item_id, found: list[bytes]) -> None:
        self.ids.append(item_id)
        self.counts.append(Counter(found))
        for t in found:
            self.terms.setdefault(t, len(self.terms))

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_ITEMS or len(self.terms) >= BLOCK_TERMS


def _flat(column: pa.Array) -> tuple[np.ndarray | pa.Array, np.ndarray]:
    return column.flatten(), pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _found(batch: pa.RecordBatch, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of strata: the query term of each of their terms (-1: none), the strata's numbers
    of terms, the terms' numbers of tf groups, and the groups' numbers of documents."""
    words, n_terms = _flat(batch.column("terms"))
    query = pc.fill_null(pc.index_in(words, value_set=wanted), -1).to_numpy(zero_copy_only=False)
    return query, n_terms, np.asarray(batch.column("groups").flatten()), np.asarray(batch.column("sizes").flatten())


def document_frequencies(index: DataFrame, terms: list[bytes]) -> np.ndarray:
    """In how many documents each of some terms occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = pa.array(terms, pa.binary()), np.zeros(len(terms), np.int64)
        for part in unpacked(batches):
            query, _, groups, sizes = _found(part, wanted)
            if len(query):
                df = np.add.reduceat(sizes, np.cumsum(groups) - groups)
                np.add.at(total, query[query >= 0], df[query >= 0])
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(own, pa.int32()), "df": pa.array(total[own], pa.int64())})

    counted = index.select("packed").mapInArrow(run, "term int, df bigint")
    out = np.zeros(len(terms), np.int64)
    for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


class _Best:
    """The k best documents of each query so far, and what a further one must reach."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.floor = k, np.ones(items, np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size, self.limit = 0, 4 * k * items

    def add(self, item: np.ndarray, score: np.ndarray, doc_id: np.ndarray, no_id: np.ndarray) -> None:
        self.parts.append((item, score, doc_id, no_id))
        self.size += len(item)
        if self.size > self.limit:
            self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
        item, score, doc_id, no_id = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((doc_id, no_id, -score, item))
        starts = _runs(item[order])
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        kept = order[place < self.k]
        last = order[place == self.k - 1]
        self.floor[item[last]] = score[last]
        self.parts = [(item[kept], score[kept], doc_id[kept], no_id[kept])]
        self.size, self.limit = len(kept), max(self.limit, 2 * len(kept))
        return self.parts[0]


def _searcher(block: _Block, weights: np.ndarray, k: int) -> Callable:
    terms, counts = list(block.terms), block.counts
    place = block.terms
    most = max((sum(n * int(weights[place[t]]) for t, n in c.items()) for c in counts), default=0) * 1_000_000
    kind = np.float64 if most < 1 << 53 else np.int64               # both exact; products of doubles are faster

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(terms, pa.binary())
        table = np.zeros((len(terms), len(counts)), kind)           # terms x queries
        for i, c in enumerate(counts):
            for t, n in c.items():
                table[place[t], i] = n
        best = _Best(len(counts), k)
        for part in unpacked(batches):
            for stratum in _strata(part, wanted, weights, table):
                _visit(stratum, table, best)
        item, score, doc_id, no_id = best.prune()
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc_id, pa.int64(), mask=no_id),
                                          pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return run


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive strata of about ``READ_POSTINGS`` postings, which bounds a task's arrays."""
    part = np.cumsum(pc.list_value_length(batch.column("members")).to_numpy(zero_copy_only=False)) // READ_POSTINGS
    starts = _runs(part) if len(part) else []
    for start, stop in zip(starts, [*starts[1:], len(part)]):
        yield batch.slice(start, stop - start)


def _strata(batch: pa.RecordBatch, wanted: pa.Array, weights: np.ndarray, table: np.ndarray) -> list[dict]:
    """The strata of some that hold a query term, the highest bound first."""
    query, n_terms, groups, sizes = _found(batch, wanted)
    kept = query >= 0
    m = np.repeat(np.asarray(batch.column("m")), n_terms)
    in_group, in_member = np.repeat(kept, groups), np.repeat(np.repeat(kept, groups), sizes)
    tf = np.asarray(batch.column("tfs").flatten())[in_group].astype(np.int64)
    impact = weights[np.repeat(query, groups)[in_group]] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, groups)[in_group]))
    member, value = np.asarray(batch.column("members").flatten())[in_member], np.repeat(impact, sizes[in_group])
    query, groups, sizes = query[kept], groups[kept], sizes[in_group]
    first = np.cumsum(groups) - groups
    per_term = np.add.reduceat(sizes, first) if len(first) else first   # postings of each kept term
    top = impact[first]
    terms_to = np.cumsum(np.bincount(np.repeat(np.arange(len(n_terms)), n_terms)[kept], minlength=len(n_terms)))
    posts_to = np.concatenate([[0], np.cumsum(per_term)])
    ids, n_docs = _flat(batch.column("doc_ids"))
    no_id = np.asarray(ids.is_null())
    ids, docs_to = np.asarray(ids.fill_null(0)), np.cumsum(n_docs)
    out = []
    for i in range(len(n_terms)):
        a, b = terms_to[i - 1] if i else 0, terms_to[i]
        if a == b:
            continue
        bound = top[a:b].astype(table.dtype) @ table[query[a:b]]
        p, q = posts_to[a], posts_to[b]
        d = slice(docs_to[i] - n_docs[i], docs_to[i])
        out.append({"bound": bound, "most": bound.max(), "query": query[a:b], "row": np.repeat(np.arange(b - a), per_term[a:b]),
                    "member": member[p:q], "value": value[p:q], "ids": ids[d], "no_id": no_id[d]})
    return sorted(out, key=lambda s: -s["most"])


def _visit(s: dict, table: np.ndarray, best: _Best) -> None:
    """Exact scores of a stratum's documents for the queries whose bound reaches their floor."""
    items = np.flatnonzero(s["bound"] >= best.floor)
    if not len(items):
        return
    impacts = np.zeros((len(s["query"]), len(s["ids"])), table.dtype)
    impacts[s["row"], s["member"]] = s["value"]
    counts = table[s["query"]] if len(items) > table.shape[1] // 2 else table[np.ix_(s["query"], items)]
    scores = impacts.T @ counts
    if counts.shape[1] != len(items):
        scores = scores[:, items]
    doc, at = np.nonzero(scores >= best.floor[items])
    if len(doc):
        best.add(items[at], scores[doc, at].astype(np.int64), s["ids"][doc], s["no_id"][doc])


def search(index: Index, items: DataFrame, k: int = TOP, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of the index for each row of
    ``items`` with a score above 0, equal scores by ascending doc_id."""
    spark = items.sparkSession
    rows = items.select(items[id_col].alias("item_id"), items[text_col].cast("string").cast("binary").alias("text"))
    out = T.StructType([rows.schema["item_id"], *T.StructType.fromDDL("rank int, doc_id bigint, score bigint").fields])
    folder, paths = scratch(spark, "search"), []

    def answer(block: _Block) -> None:
        strata = index.read(spark)
        df = document_frequencies(strata, list(block.terms))
        weights = np.array([weight(int(x), index.documents) for x in df], np.int64)
        hits = strata.select("packed").mapInArrow(_searcher(block, weights, k), "item int, doc_id bigint, score bigint")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(block.ids)), T.StructType([T.StructField("item", T.IntegerType()), out["item_id"]]))
        # one row for each query of the block
        paths.append(f"{folder}/{len(paths)}")
        best.join(F.broadcast(names), "item").select(*out.names).write.parquet(paths[-1])

    block = _Block()
    for r in rows.toLocalIterator():
        found = terms_of(r["text"])
        if found and index.documents:
            block.add(r["item_id"], found)
        if block.full():
            answer(block)
            block = _Block()
    if block.ids:
        answer(block)
    return spark.read.schema(out).parquet(*paths) if paths else spark.createDataFrame([], out)


def rank_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The best documents of each item, through an index that goes when the search is done."""
    spark = docs.sparkSession
    path = scratch(spark, "lexical-index")
    found = search(build_index(docs, path), items)
    discard(spark, path)
    return found
