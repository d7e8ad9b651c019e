"""Secret scans in DataFrame expressions: patterns, and sliding-window entropy over candidates.

Base patterns give spans by their leftmost non-overlapping matches.  Besides, every run of
token characters long enough for a window is a candidate: windows of ``WINDOW`` characters slide
over it one character at a time, with a count for each symbol that the entering and the leaving
character change by one.  With the counts goes S, the sum of c*log2(c) in fixed point, so the
window's Shannon entropy log2(W) - S/W is known at every step and exactly comparable.  A window
counts as ``hex`` if all of its characters are hexadecimal digits and as ``token`` otherwise;
each class has a threshold.  Windows that reach it are joined into spans of kind ``entropy``,
unless an allow-list pattern matches the span's text.  Base spans are never suppressed.

Positions count code points.  Where Spark gives matches without positions, they follow from the
lengths of the pieces between matches.  All is one projection over the scan: no shuffle, no
Python.

Cases: a null or empty text has no spans; repeated rows give repeated results; other columns of
the input are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.base import texts

# fixed values: kind, pattern, group whose length counts, least length
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (("assign", ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24))
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-"
HEX_DIGITS = 22
CANDIDATE = "[A-Za-z0-9+/_=-]"
WINDOW = 20
THRESHOLDS = {"hex": 3.0, "token": 3.8}
#: Spans that these match are no secrets: no digit, digits only, UUIDs, and texts that say so.
ALLOWED = (r"^[^0-9]*$", r"^[0-9]*$", r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
           r"(?i)example|sample|placeholder|changeme|dummy|xxxx")
UNIT = 1 << 20
SPAN = "struct<start:int,rank:int,end:int,kind:string>"
NO_SPANS = f"array<{SPAN}>"
MARK = "[REDACTED]"


def least_pattern(pattern: str, group: int, least: int) -> str:
    """Where the whole match counts and the pattern ends in a greedy repeated class, the least
    length can be part of the pattern: a match too short has no longer one inside."""
    if group or not pattern.endswith("]+"):
        return pattern
    fixed = pattern.index("[")
    return f"{pattern[:-1]}{{{least - fixed},}}"


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f or a function inside names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def located(text: Column, pattern: str, matches: Column) -> Column:
    """Array of (start, end) of a pattern's matches in a text, given the matched strings."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def found(pieces: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            begin = acc["at"] + F.char_length(F.element_at(pieces, i))
            end = begin + F.char_length(F.element_at(matches, i))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end")))).alias("out"))

        return F.aggregate(F.sequence(F.lit(1), F.size(matches)), zero, step, lambda acc: acc["out"])

    return F.when(F.size(matches) > 0, once(F.split(text, pattern, -1), found)).otherwise(
        F.array().cast("array<struct<start:int,end:int>>"))


def window_spans(candidate: Column) -> Column:
    """Array of (start, end) of the joined windows of one candidate that reach their threshold."""
    weigh = F.array(*[F.lit(round(c * math.log2(c) * UNIT) if c else 0).cast("bigint") for c in range(WINDOW + 1)])
    most = {k: math.floor(WINDOW * UNIT * (math.log2(WINDOW) - t)) for k, t in THRESHOLDS.items()}
    every_symbol = F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(ALPHABET), ch))
    zero = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0).cast("bigint").alias("s"),
                    F.lit(0).alias("others"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def change(counts: Column, s: Column, others: Column, symbol: Column, by: int) -> tuple[Column, Column, Column]:
        before = F.element_at(counts, symbol)
        return (F.transform(counts, lambda c, j: F.when(j + 1 == symbol, c + by).otherwise(c)),
                s + F.element_at(weigh, before + by + 1) - F.element_at(weigh, before + 1),
                others + F.when(symbol > HEX_DIGITS, by).otherwise(0))

    def named(parts: tuple[Column, Column, Column], out: Column) -> Column:
        return F.struct(parts[0].alias("counts"), parts[1].alias("s"), parts[2].alias("others"), out.alias("out"))

    def leave(acc: Column, i: Column, symbols: Column) -> Column:
        gone = change(acc["counts"], acc["s"], acc["others"], F.element_at(symbols, F.greatest(i - WINDOW, F.lit(1))), -1)
        return F.when(i > WINDOW, named(gone, acc["out"])).otherwise(acc)

    def enter(acc: Column, i: Column, symbols: Column) -> Column:
        return named(change(acc["counts"], acc["s"], acc["others"], F.element_at(symbols, i), 1), acc["out"])

    def judge(acc: Column, i: Column) -> Column:
        limit = F.when(acc["others"] == 0, F.lit(most["hex"])).otherwise(F.lit(most["token"]))
        last = F.try_element_at(acc["out"], F.lit(-1))
        begin = i - WINDOW
        joined = F.concat(F.slice(acc["out"], 1, F.size(acc["out"]) - 1), F.array(F.struct(last["start"].alias("start"), i.alias("end"))))
        added = F.concat(acc["out"], F.array(F.struct(begin.alias("start"), i.alias("end"))))
        out = F.when((i < WINDOW) | (acc["s"] > limit), acc["out"]).when(last["end"] >= begin, joined).otherwise(added)
        return named((acc["counts"], acc["s"], acc["others"]), out)

    def over(symbols: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            return once(once(leave(acc, i, symbols), lambda a: enter(a, i, symbols)), lambda a: judge(a, i))

        return F.aggregate(F.sequence(F.lit(1), F.size(symbols)), zero, step, lambda acc: acc["out"])

    return once(every_symbol, over)


def _long_enough(ranges: Column, parts: Column, least: int) -> Column:
    return F.filter(ranges, lambda _, i: F.char_length(F.get(parts, i)) >= least)


def _spans(kind: str, rank: int, ranges: Column) -> Column:
    return F.transform(ranges, lambda r: F.struct(r["start"].alias("start"), F.lit(rank).alias("rank"), r["end"].alias("end"),
                                                  F.lit(kind).alias("kind")))


def with_spans(rows: DataFrame) -> DataFrame:
    """Adds ``base`` and ``entropy`` to rows that have a ``text``: arrays of (start, rank, end,
    kind) in order of start and then of the kinds as listed."""
    whole = F.coalesce(F.col("text"), F.lit(""))
    found, ranges = {}, {}
    for kind, pattern, group, least in BASE:
        used = least_pattern(pattern, group, least)
        found[kind] = F.regexp_extract_all(whole, F.lit(used), F.lit(0))
        if group:
            found[f"{kind}_group"] = F.regexp_extract_all(whole, F.lit(used), F.lit(group))
    candidate = f"{CANDIDATE}{{{WINDOW},}}"
    found["candidates"] = F.regexp_extract_all(whole, F.lit(candidate), F.lit(0))
    rows = rows.withColumns(found)
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        at = located(whole, least_pattern(pattern, group, least), F.col(kind))
        if group:
            at = _long_enough(at, F.col(f"{kind}_group"), least)
        ranges[f"{kind}_at"] = _spans(kind, rank, at)
    texts_of = F.col("candidates")
    inside = F.zip_with(located(whole, candidate, texts_of), texts_of, lambda at, t: F.transform(
        F.filter(window_spans(t), lambda s: ~_allowed(F.substring(t, s["start"] + 1, s["end"] - s["start"]))),
        lambda s: F.struct((at["start"] + s["start"]).alias("start"), (at["start"] + s["end"]).alias("end"))))
    ranges["entropy"] = F.when(F.size(texts_of) > 0, _spans("entropy", len(BASE), F.flatten(inside))).otherwise(
        F.array().cast(NO_SPANS))
    rows = rows.withColumns(ranges)
    base = F.array_sort(F.concat(*[F.col(f"{kind}_at") for kind, *_ in BASE]))
    extra = [c for c in {**found, **ranges} if c != "entropy"]
    return rows.withColumn("base", base).drop(*extra)


def _allowed(text: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | F.rlike(text, F.lit(pattern))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, entropy): spans (start, rank, end, kind) of every row's whole text."""
    return with_spans(texts(docs, id_col, text_col)).select("doc_id", "base", "entropy")


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) from ``scan``'s spans."""
    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [number(kind) for kind, *_ in BASE]
    return scan(docs, **options).select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                                        joined(F.array_sort(F.concat("base", "entropy"))).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = MARK) -> DataFrame:
    """``docs`` with all of its columns, every secret's characters replaced by ``mark``; spans
    that overlap or touch are one.  A text without secrets stays as it is."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = with_spans(docs.select(row, docs[text_col].cast("string").alias("text")))
    spans, text = F.array_sort(F.concat("base", "entropy")), F.col("text")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.when(s["start"] > acc["at"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"])).otherwise("")
        new = (s["start"] > acc["at"]) | (acc["at"] == 0)
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(new, F.concat(acc["out"], before, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    masked = F.when(F.size(spans) > 0, clean).otherwise(text)
    return rows.select(*[masked.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
