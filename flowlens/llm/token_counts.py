"""Token counts by rank-synchronous merging over ragged numpy arrays.

A text's pre-tokens are sequences of byte symbols.  All sequences of a batch lie behind one
another in one flat array with a row number for each symbol.  A round looks up the rank of
every adjacent pair, takes the lowest rank of each sequence, and joins all of that pair's
occurrences in all sequences at once, from the left where they overlap.  A sequence without a
ranked pair leaves with its number of symbols.  In the vocabulary's merge list a pair comes
after the merges that make its parts (checked on loading), so joining a sequence's occurrences
of its lowest pair at once equals joining them one by one.

Pre-tokens repeat, so a task merges each distinct one once and remembers its count; the memory
is emptied when it holds ``REMEMBERED`` entries.  The operator is a map over rows: no shuffle.

Cases: a null or empty text has 0 tokens; special strings inside a text count as one token, as
the library's defaults have it; repeated rows give repeated results; null doc_ids stay null.
"""

from __future__ import annotations

import json
import re

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from flowlens.llm.base import map_rows, texts
from flowlens.llm.bpe import safe_pieces

VOCABULARY = "byte_bpe_50k.json"
REMEMBERED = 500_000
LONGEST = 64
NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself for
    visible Latin-1 characters, and code points from 256 on for the others in turn."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in visible else next(others)) for b in range(256)]


def narrow_pattern(pattern: str) -> re.Pattern:
    """The same pattern for text within Latin-1, its classes written out, for the standard
    library's engine, which is about twice as fast there."""
    chars, mark = [chr(c) for c in range(256)], chr(0xE000)
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        members = "".join(re.escape(c) for c in chars if regex.fullmatch(name, c))
        pattern = pattern.replace(name, f"{mark}{members}{mark}")
    outside = "".join(re.escape(c) for c in chars if regex.fullmatch(r"\S", c))
    pattern = pattern.replace(r"\S", f"{mark}{outside}{mark}")
    # a class inside [...] is only its members; alone, it needs brackets of its own
    parts, inside = [], False
    for i, piece in enumerate(pattern.split(mark)):
        if i % 2:
            parts.append(piece if inside else f"[{piece}]")
        else:
            parts.append(piece)
            opened, closed = piece.rfind("["), piece.rfind("]")
            inside = opened > closed if max(opened, closed) >= 0 else inside
    return re.compile("".join(parts))


def latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class MergeTable:
    """Merges of a byte-level BPE vocabulary in arrays: pair keys, their ranks and results."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary without a normalizer is needed")
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1
        self.start = np.array([vocab[s] for s in byte_symbols()], dtype=np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        born = {int(m): rank for rank, m in reversed(list(enumerate(made)))}
        for rank, (a, b) in enumerate(pairs):
            if max(born.get(vocab[a], -1), born.get(vocab[b], -1)) >= rank:
                raise ValueError(f"merge {rank} comes before a merge that makes one of its parts")
        self._place(keys, made)
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.specials = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _place(self, keys: np.ndarray, made: np.ndarray) -> None:
        """Put the pairs into an open-addressing table about a tenth full."""
        self.bits = max(8, int(len(keys) * 10).bit_length())
        n = 1 << self.bits
        self.keys = np.full(n, -1, np.int64)
        self.rank = np.full(n, NONE)
        self.made = np.zeros(n, np.int64)
        slot, todo = self._home(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            self.keys[slot[free]] = keys[free]  # of several for one slot the last stays
            won = free[self.keys[slot[free]] == keys[free]]
            self.rank[slot[won]], self.made[slot[won]] = won, made[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) % n

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NONE: not a merge) and its place in the table."""
        key = left * self.size + right
        at = self._home(key)
        found = self.keys[at]
        todo = np.flatnonzero((found != key) & (found != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) % len(self.keys)
            found = self.keys[at[todo]]
            todo = todo[(found != key[todo]) & (found != -1)]
        return self.rank[at], at

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols left of each sequence of bytes."""
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        out = sizes.copy()
        symbol = self.start[np.frombuffer(b"".join(tokens), np.uint8)]
        row = np.repeat(np.arange(len(tokens)), sizes)
        while len(symbol) > 1:
            rank, at = self.ranks(symbol[:-1], symbol[1:])
            rank[row[:-1] != row[1:]] = NONE
            lowest = np.full(len(tokens), NONE)
            np.minimum.at(lowest, row[:-1], rank)
            hit = np.flatnonzero((rank != NONE) & (rank == lowest[row[:-1]]))
            if not len(hit):
                break
            # occurrences that overlap stand side by side: take every other one of such a run
            first = np.flatnonzero(np.r_[True, np.diff(hit) != 1])
            place = np.arange(len(hit)) - np.repeat(first, np.diff(np.r_[first, len(hit)]))
            hit = hit[place % 2 == 0]
            symbol[hit] = self.made[at[hit]]
            out -= np.bincount(row[hit], minlength=len(tokens))
            keep = lowest[row] != NONE  # other sequences are done
            keep[hit + 1] = False
            symbol, row = symbol[keep], row[keep]
        return out


class TokenCounter:
    """Counts tokens of texts; one for each task."""

    def __init__(self, table: MergeTable, pattern: str):
        self.table, self.pattern, self.known = table, regex.compile(pattern), {}
        self.narrow = narrow_pattern(pattern)

    def _learn(self, tokens: set[str]) -> dict[str, int]:
        new = list(tokens.difference(self.known))
        return dict(zip(new, self.table.counts([t.encode() for t in new]).tolist())) if new else {}

    def __call__(self, part: list[str]) -> list[int]:
        runs: list[tuple[int, list[str]]] = []
        out = [0] * len(part)
        held = 0
        for i, text in enumerate(part):
            pieces = [text]
            if self.table.specials is not None and self.table.specials.search(text):
                pieces = self.table.specials.split(text)
                out[i] += len(pieces) - 1
            for piece in pieces:
                for stretch in safe_pieces(piece):
                    found = (self.narrow if latin(stretch) else self.pattern).findall(stretch)
                    runs.append((i, found))
                    held += len(found)
                    if held > 500_000:
                        self._settle(runs, out)
                        runs, held = [], 0
        self._settle(runs, out)
        return out

    def _settle(self, runs: list[tuple[int, list[str]]], out: list[int]) -> None:
        distinct: set[str] = set()
        for _, found in runs:
            distinct.update(found)
        counted = self._learn(distinct)
        if len(self.known) + len(counted) > REMEMBERED:
            self.known = {}
            counted = self._learn(distinct)
        long = {t: n for t, n in counted.items() if len(t) > LONGEST}
        self.known.update(counted)
        for i, found in runs:
            out[i] += sum(map(self.known.__getitem__, found))
        for t in long:
            del self.known[t]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, limit: int = 1024,
                 vocabulary_path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row: UTF-8 bytes, tokens, and whether
    there are more than ``limit``.  The vocabulary is read on the driver and broadcast; its
    size does not depend on the data."""
    with open(vocabulary_path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(MergeTable(json.load(f)))

    def make():
        counter = TokenCounter(shared.value, pattern)

        def work(part):
            n = counter(part)
            return [[len(t.encode()) for t in part], n, [x > limit for x in n]]

        return work

    return map_rows(texts(docs, id_col, text_col), "n_bytes bigint, n_tokens bigint, over_limit boolean", make)
