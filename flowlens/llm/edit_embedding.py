"""Document fingerprints by a randomised edit embedding.

A walk reads a text's characters while output steps go by: at step t it writes the character it
stands on and moves on if the shared random bit for (t, character) is 1.  Two texts walked with
the same bits fall back into step soon after an edit, so their outputs differ in about as many
places as the edit distance asks for: edit distance becomes Hamming distance.  A character's
stay depends on t and the character alone, so a table of stays replaces the bits and one round
moves all texts of a batch by one character (numpy over texts sorted by length).

The fingerprint samples the output.  For walks of up to 2^l steps the sampled steps form a fixed
set S(l) of at most ``SAMPLES`` steps: all steps while there are few, then half of S(l-1) and as
many from the upper half of the range.  So S(l) below 2^(l-1) is part of S(l-1), and outputs of
any two lengths can be compared at the longer one's steps.  Each sampled character is kept as
four bits; a step after the walk's end is a dot.

``likeness`` of two fingerprints is the share of equal symbols among the sampled steps at which
either walk goes on; of two empty texts it is 1.  ``near_classes`` finds near duplicates: bands
of sampled symbols are the buckets, and every pair of a bucket is verified by its likeness.

Cases: a null or empty text has an empty walk; equal texts have equal fingerprints; for
``with_edits``, rows come in descending order of id (null ids last, rows of one id by text) and
the last one is followed by the first, a single row by itself.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from flowlens.llm.base import map_rows, output_schema, settle, texts
from flowlens.llm.components import components, forest

SEED = 11
PERIOD, KINDS = 1 << 14, 128
SAMPLES = 256
BATCH = 1 << 22
NEAR, BANDS, BAND_SYMBOLS, CHUNK = 0.8, 24, 8, 512
DIGITS = "0123456789abcdef."


def _stays() -> np.ndarray:
    """stays[kind * PERIOD + t]: steps from t until the walk has left a character of that kind."""
    bits = np.random.default_rng(SEED).integers(0, 2, (KINDS, PERIOD), dtype=np.uint8)
    wrapped = np.hstack([bits, bits])
    out = np.zeros(wrapped.shape, np.int32)
    ahead = np.full(KINDS, 1 << 20, np.int32)
    for t in range(2 * PERIOD - 1, -1, -1):
        ahead = np.where(wrapped[:, t] == 1, 1, ahead + 1)
        out[:, t] = ahead
    return np.ascontiguousarray(out[:, :PERIOD]).ravel()


def _sampled_steps(levels: int = 48) -> list[np.ndarray]:
    """S(l) for each l, ascending."""
    random = np.random.default_rng(SEED + 1)
    out = []
    for level in range(levels):
        size = 1 << level
        if size <= SAMPLES:
            out.append(np.arange(size))
        else:
            half = size >> 1
            old = random.choice(out[-1], SAMPLES // 2, replace=False)
            new = half + random.choice(half, SAMPLES // 2, replace=False) if half <= 1 << 16 else np.unique(
                half + random.integers(0, half, SAMPLES // 2))
            out.append(np.sort(np.concatenate([old, new])))
    return out


STAYS = _stays()
STEPS = _sampled_steps()
KEPT = [np.flatnonzero(np.isin(STEPS[i], STEPS[i + 1])) for i in range(len(STEPS) - 1)]


def fingerprints_of(part: list[str]) -> list[str]:
    """Fingerprints of some texts: level and sampled symbols."""
    order = sorted(range(len(part)), key=lambda i: -len(part[i]))
    sizes = np.array([len(part[i]) for i in order], np.int64)
    flat = np.frombuffer("".join(part[i] for i in order).encode("utf-32-le"), np.uint32)
    offset = np.r_[0, np.cumsum(sizes)][:-1]
    kind = (np.where(flat < 128, flat, flat * np.uint32(31)) & np.uint32(KINDS - 1)).astype(np.int32) * np.int32(PERIOD)
    arrive = np.zeros(len(flat), np.int64)
    at = np.zeros(len(part), np.int64)
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left") if len(sizes) else []
    for i, k in enumerate(active):  # the first k texts have a character i
        here, t = offset[:k] + i, at[:k]
        arrive[here] = t
        t += STAYS[kind[here] + (t & (PERIOD - 1))]
    symbol = ((flat * np.uint32(2654435761)) >> np.uint32(28)).astype(np.uint8)
    out = [""] * len(part)
    digits = np.frombuffer(DIGITS.encode(), np.uint8)
    for j, i in enumerate(order):
        end = int(at[j])
        level = max(0, end - 1).bit_length()
        steps = STEPS[level]
        codes = np.full(len(steps), 16, np.uint8)
        inside = steps < end
        if inside.any():
            o, n = offset[j], sizes[j]
            codes[inside] = symbol[o + np.searchsorted(arrive[o:o + n], steps[inside], side="right") - 1]
        out[i] = f"{level:02x}:" + digits[codes].tobytes().decode()
    return out


def _codes(fingerprint: str) -> tuple[int, np.ndarray]:
    return int(fingerprint[:2], 16), np.frombuffer(fingerprint[3:].encode(), np.uint8)


def _raise_to(level: int, codes: np.ndarray, to: int) -> np.ndarray:
    """Symbols at the sampled steps of a higher level: those kept, and dots after the end."""
    for i in range(level, to):
        raised = np.full(len(STEPS[i + 1]), ord("."), np.uint8)
        raised[:len(KEPT[i])] = codes[KEPT[i]]
        codes = raised
    return codes


def likeness(a: str, b: str) -> float:
    """Share of equal symbols of two fingerprints where either walk goes on."""
    (la, ca), (lb, cb) = _codes(a), _codes(b)
    to = max(la, lb)
    ca, cb = _raise_to(la, ca, to), _raise_to(lb, cb, to)
    on = (ca != ord(".")) | (cb != ord("."))
    return float((ca == cb)[on].mean()) if on.any() else 1.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row, without a shuffle."""
    return map_rows(texts(docs, id_col, text_col), "n_chars bigint, fingerprint string",
                    lambda: lambda part: [[len(t) for t in part], fingerprints_of(part)], BATCH)


def edited(text: str, following: str) -> str:
    """The last half of a text's characters replaced by as many first ones of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _block_starts(rows: DataFrame) -> list:
    """Descending ids that start blocks of about equal numbers of rows; as many as the session
    has shuffle partitions, times four.  Only ids are read and moved."""
    n = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("doc_id").where(F.col("doc_id").isNotNull()).repartitionByRange(n, F.col("doc_id").desc())
    found = ids.groupBy(F.spark_partition_id()).agg(F.max("doc_id").alias("m")).collect()
    return sorted({r["m"] for r in found})


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, block, ghost) with each block's rows in one partition in descending order
    of id, closed by the first row of the next block as a ghost.  Texts move once."""
    rows = texts(docs, id_col, text_col)
    starts = _block_starts(rows)
    last = max(0, len(starts) - 1)
    schema = output_schema(rows, "text string, block int, ghost int")
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, block, ghost = [], [], []
            for i, x in enumerate(batch.column(0).to_pylist()):
                up = bisect_left(starts, x) if x is not None and starts else 0  # starts[up] is the least not below x
                here = last - up
                take.append(i), block.append(here), ghost.append(0)
                if (x == starts[up]) if starts else True:
                    take.append(i), block.append(here - 1 if here else last), ghost.append(1)
            chosen = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1).cast(pa.string()), pa.array(block, types[2]),
                                              pa.array(ghost, types[3])], names=schema.names)

    return rows.mapInArrow(run, schema).repartition("block").sortWithinPartitions(
        "block", "ghost", F.col("doc_id").desc_nulls_last(), "text")


EDITS = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
         "near_next double")


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next):
    every text beside its edited version and beside the next text, by their fingerprints."""
    ordered = in_order(docs, id_col, text_col)
    schema = output_schema(ordered, EDITS)
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(id, text, following text); a block's later ghosts are repeats of its first one's id."""
        held = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                doc_id, text, block, ghost = row
                text = text or ""
                if held is not None and held[2] == block:
                    yield held[0], held[1], text
                    held = None
                if not ghost:
                    held = (doc_id, text, block)

    def flush(run: list[tuple]) -> pa.RecordBatch:
        changed = [edited(t, f) for _, t, f in run]
        # a row's following text is the next row's text, but for the last row and at a block's end
        apart = [i for i in range(len(run)) if i + 1 == len(run) or run[i][2] is not run[i + 1][1]]
        prints = fingerprints_of([t for _, t, _ in run] + changed + [run[i][2] for i in apart])
        own, new = prints[:len(run)], prints[len(run):2 * len(run)]
        after = own[1:] + [""]
        for i, p in zip(apart, prints[2 * len(run):]):
            after[i] = p
        cols = [[r[0] for r in run], [len(r[1]) for r in run], [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                own, new, [likeness(a, b) for a, b in zip(own, new)], [likeness(a, b) for a, b in zip(own, after)]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=schema.names)

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, size = [], 0
        for row in pairs(batches):
            run.append(row)
            size += len(row[1])
            if size >= BATCH:
                yield flush(run)
                run, size = [], 0
        if run:
            yield flush(run)

    return ordered.mapInArrow(run_all, schema)


def bands(fingerprint: str) -> list[str]:
    """Bucket names of one fingerprint: bands of symbols at its own and at the next level."""
    level, codes = _codes(fingerprint)
    out = []
    for to in (level, level + 1):
        raised = _raise_to(level, codes, to)
        random = np.random.default_rng([SEED, to])
        if (raised == ord(".")).all():
            out.append(f"{to}:empty")
            continue
        for b in range(BANDS):
            picked = random.choice(len(raised), min(BAND_SYMBOLS, len(raised)), replace=False)
            symbols = raised[picked].tobytes().decode()
            if symbols.strip("."):
                out.append(f"{to}:{b}:{symbols}")
    return out


def near_links(prints: DataFrame, least: float = NEAR) -> DataFrame:
    """(a, b) edges that connect distinct fingerprints which share a band and are at least
    ``least`` alike.  A bucket of any size is dealt into chunks and all pairs of its chunks are
    verified; only a spanning forest of the links leaves a task."""
    distinct = prints.select("fingerprint").distinct()
    named = map_rows(distinct.select(F.col("fingerprint").alias("doc_id"), F.col("fingerprint").alias("text")),
                     "bands array<string>", lambda: lambda part: [[bands(x) for x in part]])
    member = settle(named.select(F.col("doc_id").alias("fingerprint"), F.explode("bands").alias("bucket")))
    sizes = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    sizes = settle(sizes.select(F.col("bucket").alias("of"), F.ceil(F.col("n") / F.lit(CHUNK)).cast("int").alias("chunks")))
    placed = (member.join(sizes, F.col("bucket") == F.col("of"))
              .withColumn("chunk", F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int")))
    dealt = placed.select("bucket", "fingerprint", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).select(
        F.xxhash64("bucket", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("pair"), "fingerprint")

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        found = sorted(set(group["fingerprint"]))
        label = np.arange(len(found))
        for i, a in enumerate(found):
            hits = [j for j in range(i + 1, len(found)) if likeness(a, found[j]) >= least]
            if hits:
                label = forest(len(found), np.full(len(hits), i), np.array(hits), label)
        child = np.flatnonzero(label != np.arange(len(found)))
        return pd.DataFrame({"a": [found[i] for i in child], "b": [found[label[i]] for i in child]}, dtype=object)

    return dealt.groupBy("pair").applyInPandas(verify, "a string, b string")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = NEAR) -> DataFrame:
    """(doc_id, fingerprint, class_id): the smallest doc_id that near-duplicate links reach."""
    prints = settle(fingerprints(docs, id_col, text_col).select("doc_id", "fingerprint"))
    first = settle(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    roots = settle(components(near_links(prints, least)))
    linked = first.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    smallest = settle(linked.groupBy(F.col("root").alias("of")).agg(F.min("first_id").alias("class_id")))
    named = settle(linked.join(smallest, F.col("root") == F.col("of")).select(F.col("fingerprint").alias("name"), "class_id"))
    return prints.join(named, F.col("fingerprint") == F.col("name")).select("doc_id", "fingerprint", "class_id")
