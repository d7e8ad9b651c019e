"""Byte-level BPE encoding and decoding with the tiktoken library.

``encode`` maps each whole text to the ids that the library gives for a rank file, each match
of the split pattern on its own and without special tokens; ``decode`` maps ids back to raw
bytes.  Both are maps over the rows: no shuffle, and memory for one batch of texts.

The library's pattern engine recurses on long runs of white space, so a text longer than
``PIECE`` characters is split first, at places where no match can reach across:

* between a letter, digit or plain mark and white space: a match holds white space only at its
  start or throughout;
* between a letter and a digit, in either order: a match holds one class besides its space.

Neither side's matches look across such a place.  A stretch without one (a run of a single
class, in practice) is matched with the same pattern by another engine and every match is
encoded as a whole.

Cases: a null or empty text has no ids; ids are kept per row, so repeated rows give repeated
results; null doc_ids stay null; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.base import map_rows, output_schema, texts

RANK_FILE = "byte_bpe_50k.tiktoken"
PIECE = 1 << 15
SAFE = regex.compile(r"(?<=[\p{L}\p{N}.,;:!?)\]])(?=[ \t\r\n])|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")
REACH = 1 << 12


def safe_pieces(text: str, limit: int = PIECE) -> Iterator[str]:
    """Split a text into pieces of about ``limit`` characters, cut at safe places only; a piece
    is longer where there is no safe place."""
    start, n = 0, len(text)
    while n - start > limit:
        look = start + limit
        cut = None
        while cut is None and look < n:  # the first safe place from there on, a stretch at a time
            cut = SAFE.search(text, look, min(n, look + REACH))
            look += REACH - 2
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    if start < n:
        yield text[start:]


def load_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


#: Takes a whole string as a single match.
WHOLE = r"(?s:.+)"


@functools.lru_cache(maxsize=3)
def encoder(rank_lines: bytes, pattern: str) -> tiktoken.Encoding:
    """The library's encoder by ``pattern``, made once in a worker."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_lines.splitlines())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_text(text: str, rank_lines: bytes, pattern: str, limit: int = PIECE) -> list[int]:
    split = encoder(rank_lines, pattern)
    if len(text) <= limit:
        return split.encode_ordinary(text)
    ids: list[int] = []
    for piece in safe_pieces(text, limit):
        if len(piece) <= 2 * limit:
            ids += split.encode_ordinary(piece)
        else:
            whole = encoder(rank_lines, WHOLE)
            for match in regex.finditer(pattern, piece):
                ids += whole.encode_ordinary(match.group())
    return ids


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rank_path: str | None = None,
           pattern: str = public_tokenizers.PATTERN, packed: bool = False, verify: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row.  ``verify`` decodes the ids in the same task, raises
    where the bytes are not the text's, and adds their ``decoded_sha256``.  ``ids`` is an array of ints, or with ``packed`` the
    ids as little-endian unsigned 32-bit integers, the usual form of token shards.  The rank
    file is read on the driver and broadcast: its size does not depend on the data."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load_ranks(rank_path or public_tokenizers.path(RANK_FILE)))

    def make():
        lines = shared.value

        def work(part):
            ids, digests = [], []
            for t in part:
                own = encode_text(t, lines, pattern)
                if verify:
                    raw = encoder(lines, pattern).decode_bytes(own)
                    if raw != t.encode():
                        raise ValueError(f"ids do not decode to the text that begins {t[:50]!r}")
                    digests.append(hashlib.sha256(raw).hexdigest())
                ids.append(np.array(own, dtype="<u4"))
            cols = [[len(x) for x in ids], [x.tobytes() if packed else x.astype("i4") for x in ids]]
            return [*cols, digests] if verify else cols

        return work

    kind = "binary" if packed else "array<int>"
    checked = ", decoded_sha256 string" if verify else ""
    return map_rows(texts(docs, id_col, text_col), f"n_tokens bigint, ids {kind}{checked}", make)


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", *, rank_path: str | None = None,
           pattern: str = public_tokenizers.PATTERN, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, decoded): the raw bytes of each row's ids (null: none), in either form that
    ``encode`` gives.  Bytes, since ids need not end at a character's end.  ``keep`` names
    columns of ``tokens`` that go along."""
    spark = tokens.sparkSession
    shared = spark.sparkContext.broadcast(load_ranks(rank_path or public_tokenizers.path(RANK_FILE)))
    rows = tokens.select(tokens[id_col].alias("doc_id"), tokens[ids_col].alias("_coded"), *(tokens[c] for c in keep))
    schema = output_schema(rows, "decoded binary")
    for c in keep:
        schema.add(tokens.schema[c])
    names = schema.names

    def run(batches):
        split = encoder(shared.value, pattern)
        for batch in batches:
            out = []
            for x in batch.column(1):
                x = x.as_py() or []
                out.append(split.decode_bytes(np.frombuffer(x, "<u4").tolist() if isinstance(x, bytes) else x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), *batch.columns[2:]],
                                             names=names)

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of both directions' results."""
    coded = encode(docs, packed=True)
    both = decode(coded, keep=("n_tokens", "ids"))
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
