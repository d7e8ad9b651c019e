"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order of their keys.  A Feistel network over pairs (l, r) with
0 <= l < a, 0 <= r < b permutes the numbers below a*b, where a and b are close to the square
root of the row count N and a*b is the least such product not below N.  Numbers that land at N
or beyond walk on through the permutation until they come back below N (cycle walking), which
leaves a permutation of exactly 0..N-1.  The image p gives ``shard = p mod shards`` and
``slot = p div shards``: shard sizes differ by one row at most and slots have no gaps.  Anyone
who knows N and the seed can compute a row's place, or the row at a place, without the data
(``place_of``, ``row_at``).

Everything runs in DataFrame expressions.  Texts are reduced to size and checksum in the scan,
so the one range exchange moves a few dozen bytes a row.

Walks: at most a*b - N < a steps.  Only about one number in a walks at all, so the expected
work of all walks is in proportion to N.

Cases: a null text has size 1 and checksum 0; null ids come first; rows that agree in id, size
and checksum are numbered one after the other, which of them first makes no difference to the
result; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.plans.ordering import dense_index

ROUNDS = 6
SEED = 42


def domain(n_rows: int) -> tuple[int, int]:
    """Sides (a, b) of the grid of numbers that the network permutes."""
    a = max(1, math.isqrt(max(n_rows, 1) - 1) + 1)
    return a, max(1, -(-n_rows // a))


def _round_value(seed: int, k: int, x: Column) -> Column:
    """Round function: 48 bits of the MD5 of seed, round and input."""
    text = F.concat(F.lit(f"{seed}:{k}:"), x.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")


def _permuted(x: Column, a: int, b: int, seed: int) -> Column:
    """The whole network as one expression of x."""
    left, right = F.floor(x / F.lit(b)).cast("bigint"), x % F.lit(b)
    for k in range(ROUNDS):
        if k % 2:
            right = (right + _round_value(seed, k, left)) % F.lit(b)
        else:
            left = (left + _round_value(seed, k, right)) % F.lit(a)
    return left * F.lit(b) + right


def permute(df: DataFrame, number: str, n_rows: int, out: str, seed: int = SEED) -> DataFrame:
    """Adds ``out``: the place of each row ``number`` in a permutation of 0..n_rows-1."""
    a, b = domain(n_rows)
    rows = df.withColumns({"_l": F.expr(f"`{number}` div {b}L"), "_r": F.col(number) % F.lit(b)})
    for k in range(ROUNDS):
        rows = (rows.withColumn("_r", (F.col("_r") + _round_value(seed, k, F.col("_l"))) % F.lit(b)) if k % 2 else
                rows.withColumn("_l", (F.col("_l") + _round_value(seed, k, F.col("_r"))) % F.lit(a)))
    rows = rows.withColumn(out, F.col("_l") * F.lit(b) + F.col("_r")).drop("_l", "_r")
    beyond = a * b - n_rows
    if beyond:
        limit = F.lit(n_rows).cast("bigint")
        walked = F.aggregate(F.sequence(F.lit(1), F.lit(beyond)), F.col(out),
                             lambda x, _: F.when(x < limit, x).otherwise(_permuted(x, a, b, seed)))
        rows = rows.withColumn(out, F.when(F.col(out) < limit, F.col(out)).otherwise(walked))
    return rows


def _f(seed: int, k: int, x: int) -> int:
    return int(hashlib.md5(f"{seed}:{k}:{x}".encode()).hexdigest()[:12], 16)


def place_of(row: int, n_rows: int, shards: int, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of a row number, without the data."""
    a, b = domain(n_rows)
    x = row
    while True:
        left, right = divmod(x, b)
        for k in range(ROUNDS):
            if k % 2:
                right = (right + _f(seed, k, left)) % b
            else:
                left = (left + _f(seed, k, right)) % a
        x = left * b + right
        if x < n_rows:
            return x % shards, x // shards


def row_at(shard: int, slot: int, n_rows: int, shards: int, seed: int = SEED) -> int:
    """The row number at a place: the network's rounds backwards."""
    a, b = domain(n_rows)
    x = slot * shards + shard
    while True:
        left, right = divmod(x, b)
        for k in reversed(range(ROUNDS)):
            if k % 2:
                right = (right - _f(seed, k, left)) % b
            else:
                left = (left - _f(seed, k, right)) % a
        x = left * b + right
        if x < n_rows:
            return x


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = 16, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, row_number, shard, slot) of every row."""
    data = F.coalesce(docs[text_col].cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(docs[id_col].alias("doc_id"), (F.octet_length(data) + F.lit(1)).cast("bigint").alias("size"),
                       F.crc32(data).alias("text_crc32"))
    n_rows = docs.count()
    numbered = dense_index(rows, ["doc_id", "size", "text_crc32"], out="row_number")
    placed = permute(numbered, "row_number", n_rows, "_place", seed)
    return placed.select("doc_id", "size", "text_crc32", "row_number",
                         (F.col("_place") % F.lit(shards)).cast("int").alias("shard"),
                         F.expr(f"_place div {shards}L").alias("slot"))


def assignment(docs: DataFrame, shards: int = 16) -> DataFrame:
    """The places of all rows with the law that their shards obey; none grows by itself under
    the law of equal counts, so ``grown_shard`` is null."""
    return shard(docs, shards=shards).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                             F.lit(None).cast("int").alias("grown_shard"))
