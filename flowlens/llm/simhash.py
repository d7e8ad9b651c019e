"""SimHash near-duplicates by tiled exact comparison.

A fingerprint's bit is 1 if it is set in over half of the XXH64 values (seed 42) of the text's
word shingles.  Distinct fingerprints are compared exactly, in tiles:

* The 64 bits are cut into k equal blocks; a fingerprint's tile is the list of its blocks'
  population counts.  One differing bit changes one count by one, so fingerprints within
  ``radius`` bits lie in tiles whose counts differ by ``radius`` in total at most.  All other
  tile pairs are skipped.
* k follows from the number of fingerprints: the least of 1, 2, 4, 8, 16 with which a tile is
  expected to hold ``TILE`` of them.  Every k gives the same links.
* A tile that holds more than ``TILE`` is dealt by hash into chunks, so no task compares more
  than about TILE x TILE pairs however many fingerprints share their counts.
* Each pair of chunks is one group: numpy exclusive-or and bit counts over blocks of rows.  The
  links found become the edges of a spanning forest at once, so a cluster of m fingerprints
  leaves fewer than 2m edges a group, not m*m.

Cases: texts without words (null, empty, white space) have fingerprint zero and are linked like
any others; equal texts share a fingerprint; null ids count as larger than all others, and a
component of null ids only has a null id; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.base import map_rows, settle, texts
from flowlens.llm.components import components, forest

SHINGLE, RADIUS, HASH_SEED = 3, 2, 42
TILE = 32_768
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(map(len, words), lambda x, n: x + 1 + n))
    last = ends[shingle - 1:] or ends[-1:]
    starts = [0, *(e + 1 for e in ends)]
    ones, total = np.zeros(64, np.int64), len(last)
    for at in range(0, total, 1 << 16):  # a bounded part of a long text at a time
        part = [xxhash.xxh64_intdigest(joined[s:e], HASH_SEED) for s, e in zip(starts[at:at + (1 << 16)], last[at:at + (1 << 16)])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer."""
    def make():
        return lambda part: [np.array([fingerprint(t, shingle) for t in part], np.uint64).view(np.int64)]

    return map_rows(texts(docs, id_col, text_col), "fp bigint", make)


def hex_digits(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def blocks_for(n: int, tile: int) -> int:
    """The least number of blocks with which random fingerprints are expected to meet no more
    than ``tile`` others in their own tile."""
    for k in (1, 2, 4, 8, 16):
        w = 64 // k
        if n * (math.comb(2 * w, w) / 4**w) ** k <= tile:
            break
    return k


def tile_code(fp: Column, k: int, radius: int) -> Column:
    """The k population counts as digits of one number, with room for steps of ``radius``."""
    w, base = 64 // k, 64 // k + 1 + 2 * radius
    mask = F.lit((1 << w) - 1 if w < 64 else -1)
    code = F.lit(0).cast("bigint")
    for i in range(k):
        block = F.shiftrightunsigned(fp, i * w).bitwiseAND(mask) if k > 1 else fp
        code = code * F.lit(base) + F.bit_count(block).cast("bigint")
    return code


def tile_steps(k: int, radius: int) -> list[int]:
    """Differences of the codes of tile pairs within ``radius``, one of each opposite two."""
    base = 64 // k + 1 + 2 * radius
    found = set()
    for picked in itertools.product(range(-k, k + 1), repeat=radius):  # each: no step, or one up or down in a block
        step = [0] * k
        for p in picked:
            if p:
                step[abs(p) - 1] += 1 if p > 0 else -1
        found.add(sum(d * base**i for i, d in enumerate(reversed(step))))
    return sorted(x for x in found if x >= 0)


def compare(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest edges of the links between two tiles of distinct fingerprints."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    at_left, at_right = at[:len(left)], at[len(left):]
    label = np.arange(len(nodes))
    rows = max(1, (1 << 19) // max(1, len(right)))
    for i in range(0, len(left), rows):
        near = np.bitwise_count(left[i:i + rows, None] ^ right[None, :]) <= radius
        x, y = np.nonzero(near)
        if len(x):
            label = forest(len(nodes), at_left[i + x], at_right[y], label)
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b) edges that connect the distinct fingerprints ``fp`` within ``radius`` bits."""
    k = blocks_for(distinct.count(), tile)
    coded = distinct.select("fp", tile_code(F.col("fp"), k, radius).alias("code"))
    sizes = settle(coded.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("chunks")))
    other = sizes.select(F.col("code").alias("other"), F.col("chunks").alias("other_chunks"))
    steps = F.array(*[F.lit(x).cast("bigint") for x in tile_steps(k, radius)])
    pairs = (sizes.withColumn("step", F.explode(steps)).withColumn("other", F.col("code") + F.col("step")).join(other, "other")
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .withColumn("other_chunk", F.explode(F.sequence(F.lit(0), F.col("other_chunks") - 1)))
             .where((F.col("code") != F.col("other")) | (F.col("chunk") <= F.col("other_chunk")))
             .select("code", "chunk", "other", "other_chunk", F.xxhash64("code", "chunk", "other", "other_chunk").alias("pair")))
    # two pairs with one hash would share a group, where all of it is compared: no harm
    sides = settle(pairs.select("code", "chunk", "pair", F.lit(True).alias("is_left")).unionByName(
        pairs.select(F.col("other").alias("code"), F.col("other_chunk").alias("chunk"), "pair", F.lit(False).alias("is_left"))))
    member = coded.join(sizes, "code").select("fp", "code", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int").alias("chunk"))
    dealt = member.join(sides, ["code", "chunk"]).select("pair", "is_left", "fp")

    def work(group: pd.DataFrame) -> pd.DataFrame:
        fp, is_left = group["fp"].to_numpy().view(np.uint64), group["is_left"].to_numpy()
        a, b = compare(np.unique(fp[is_left]), np.unique(fp[~is_left]), radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    # few bytes but much work: as many tasks as the session deals out, not as its bytes ask for
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "pair").groupBy("pair").applyInPandas(work, "a bigint, b bigint")


def classes(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id) of rows (doc_id, fp): the smallest doc_id that links reach."""
    prints = settle(prints)
    first = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    joined = settle(components(links(first, radius, tile)))
    linked = joined.join(first, joined["node"] == first["fp"]).select("fp", "root", "first_id")
    smallest = settle(linked.groupBy("root").agg(F.min("first_id").alias("component_id")))
    linked = linked.join(smallest, "root").select(F.col("fp").alias("linked_fp"), "component_id")
    named = settle(first.join(linked, F.col("fp") == F.col("linked_fp"), "left").select(
        F.col("fp").alias("named_fp"), F.coalesce("component_id", "first_id").alias("component_id")))
    return prints.join(named, F.col("fp") == F.col("named_fp")).select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE,
                    radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    found = classes(fingerprints(docs, id_col, text_col, shingle), radius, tile)
    return found.select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE,
                         radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``docs`` with all of its columns and one row of each component: that with the smallest
    id (null ids last), of rows that share the id the first by text digest, and of rows that
    repeat both any one."""
    text = docs[text_col].cast("string")
    row_key = F.concat_ws(":", F.coalesce(docs[id_col].cast("string"), F.lit("\0")), F.md5(F.coalesce(text, F.lit(""))))
    ident = F.struct(docs[id_col].isNull().alias("none"), docs[id_col].alias("id"), row_key.alias("key"))
    found = classes(fingerprints(docs.select(ident.alias("doc_id"), text.alias("text")), shingle=shingle), radius, tile)
    kept = settle(found.where(F.col("doc_id.key") == F.col("component_id.key"))
                  .groupBy(F.col("doc_id.key").alias("kept_key")).agg(F.count(F.lit(1)).alias("copies")))
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), row_key.alias("key"))
    rows = whole.join(kept, F.col("key") == F.col("kept_key"))
    out = rows.where(F.col("copies") == 1)
    if not kept.where(F.col("copies") > 1).isEmpty():
        out = out.unionByName(rows.where(F.col("copies") > 1).dropDuplicates(["key"]))
    return out.select("row.*")
