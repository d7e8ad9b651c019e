"""WARC archives compressed record by record with an embedded Zstandard dictionary.

An archive starts with a skippable frame (magic 0x184D2A5D) whose content is the dictionary;
then each WARC record is a Zstandard frame of its own, so a reader can start at any record.
A writer task takes its records in the order of their payload digests, so the order does not
depend on which block of a shuffle arrives first, and the first records are a random sample of
the archive.  It trains the dictionary on those, up to ``SAMPLE_BYTES`` (the bound of the sample;
it affects size alone), and holds no more than those in memory; records after them are
compressed as they come.

Equal payloads are stored once: the page with the smallest id is a ``response`` record and the
others are ``revisit`` records that name it.  Digests are computed in the scan; the smallest id
of each digest that occurs more than once comes from an aggregation over (digest, id) alone,
and the pages join it by digest.  Both sides of that join are plain exchanges, so Spark splits
a digest that holds a large part of the pages.

Files go through ``pyarrow.fs``, which resolves the target's URI in each task (shared folder or
object store), under a temporary name first and then by a rename to the partition's name: a
repeated or speculative task replaces an archive by an equal one.

Cases: a null payload is empty; pages below ``min_bytes`` are all responses; rows that repeat
the smallest id with the same payload are all responses; a null id is never the smallest, and a
payload that only null ids have is a response each time; a null url is left out; the table may
be empty, which gives no archive and no record.
"""

from __future__ import annotations

import base64
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.base import discard, settle

SKIPPABLE = 0x184D2A5D
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
ID_PREFIX = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SUFFIX = ".warc.zst"
MANIFEST = "archive string, records bigint, bytes bigint, dictionary_bytes bigint"
RECORD = ("archive string, record_id string, record_type string, target_uri string, warc_date string, "
          "payload_digest string, payload_bytes bigint, refers_to string, payload binary, digest_ok boolean")


def base32_of_hex(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode().rstrip("=")


def record_id(page_id: str | None) -> str:
    return ID_PREFIX + quote(page_id, safe="") if page_id is not None else "urn:nopage"


def page_of(uri: Column) -> Column:
    """The page id (text) inside a record id; null where there is none."""
    inside = F.regexp_extract(uri, f"^<?{ID_PREFIX}(.*?)>?$", 1)
    return F.when(uri.contains(ID_PREFIX), F.try_url_decode(inside))


def _field(value: str) -> str:
    """A header value: control characters are percent-encoded, and so is '%' itself."""
    return quote(value, safe="".join(chr(c) for c in range(32, 127) if chr(c) != "%")) if not value.isascii() or any(
        c < " " or c == "%" or c == "\x7f" for c in value) else value


def build_record(page_id: str | None, url: str | None, digest: str, size: int, first: str | None, payload: bytes,
                 date: str) -> bytes:
    """One WARC record; ``first`` names the response that a revisit refers to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if first is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <{record_id(page_id)}>",
            f"WARC-Date: {date}", *([f"WARC-Target-URI: {_field(url)}"] if url is not None else []),
            f"WARC-Payload-Digest: sha1:{digest}",
            *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(first)}>"] if first is not None else []),
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from sample records; where they are too few or too small to train on, the
    sample itself serves as one."""
    if not samples:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:
        raw = b"".join(samples)[-size:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(raw) >= 8 else None


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def write_archive(records: Iterator[bytes], uri: str, sample_bytes: int, dictionary_bytes: int,
                  level: int) -> tuple[int, int, int] | None:
    """Write one archive; (records, bytes, dictionary bytes), or None if there is no record."""
    held, size = [], 0
    for r in records:
        held.append(r)
        size += len(r)
        if size >= sample_bytes:
            break
    if not held:
        return None
    d = train(held, dictionary_bytes)
    content = d.as_bytes() if d else b""
    packer = zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=True)
    target, path = open_fs(uri)
    folder, _, name = path.rpartition("/")
    target.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
    n, total = 0, 8 + len(content)
    with target.open_output_stream(temporary, compression=None) as f:
        f.write(struct.pack("<II", SKIPPABLE, len(content)) + content)
        for source in (held, records):
            for r in source:
                frame = packer.compress(r)
                f.write(frame)
                n, total = n + 1, total + len(frame)
            held = []
    target.move(temporary, path)
    return n, total, len(content)


def read_archive(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of one archive, one record in memory at a time."""
    source, path = open_fs(uri)
    with source.open_input_stream(path, compression=None) as f:
        magic, size = struct.unpack("<II", f.read(8))
        if magic != SKIPPABLE:
            raise ValueError(f"{uri} does not start with a dictionary frame")
        content = f.read(size)
        d = zstandard.ZstdCompressionDict(content) if content else None
        reader = zstandard.ZstdDecompressor(dict_data=d).stream_reader(f, read_across_frames=True)
        rest = b""

        def take(until: bytes | None, n: int = 0) -> bytes | None:
            nonlocal rest
            parts, have = [rest], len(rest)
            while (until not in rest) if until else have < n:
                more = reader.read(1 << 17)
                if not more:
                    if until and not rest:
                        return None
                    raise ValueError(f"{uri} ends inside a record")
                if until:
                    rest += more
                else:
                    parts.append(more)
                    have += len(more)
            if until:
                got, _, rest = rest.partition(until)
            else:
                whole = b"".join(parts)
                got, rest = whole[:n], whole[n:]
            return got

        while (head := take(b"\r\n\r\n")) is not None:
            lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines[1:])
            block = take(None, int(headers["Content-Length"]))
            if take(None, 4) != b"\r\n\r\n":
                raise ValueError(f"{uri}: a record does not end where it should")
            yield headers, block


def first_pages(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(digest, first_id): the smallest id of every digest that several pages share."""
    shared = (pages.where(F.col("size") >= min_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    return settle(shared.select(F.col("digest").alias("first_digest"), "first_id"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", *,
                   min_bytes: int = 0, sample_bytes: int = SAMPLE_BYTES, dictionary_bytes: int = DICTIONARY_BYTES,
                   level: int = LEVEL, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archives now; returns their manifest (archive, records, bytes, dictionary_bytes),
    which is kept beside them.  ``path`` is a folder that driver and executors share."""
    payload = F.coalesce(pages[payload_col].cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"),
                        F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"), payload.alias("payload"))
    first = first_pages(rows, min_bytes)
    same = (F.col("digest") == F.col("first_digest")) & (F.col("size") >= min_bytes)
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    ready = rows.join(first, same, "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "digest", "size",
        F.when(revisit, F.col("first_id")).cast("string").alias("first"), F.when(~revisit, F.col("payload")).alias("payload"))
    ready = ready.sortWithinPartitions("digest", "page_id", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                cols = batch.columns
                for i in range(batch.num_rows):
                    page, url, digest, size, first_id, body = (c[i].as_py() for c in cols)
                    yield build_record(page, url, base32_of_hex(digest), size, first_id, body or b"", date)

        uri = f"{path}/part-{TaskContext.get().partitionId():06d}{SUFFIX}"
        done = write_archive(records(), uri, sample_bytes, dictionary_bytes, level)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([uri]), *(pa.array([x], pa.int64()) for x in done)],
                                             names=["archive", "records", "bytes", "dictionary_bytes"])

    ready.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")
    return pages.sparkSession.read.parquet(f"{path}/manifest")


def read_archives(spark: SparkSession, archives: DataFrame, payloads: bool = True, verify: bool = True) -> DataFrame:
    """Records of the archives that a manifest names, an archive a task at a time (a text file
    list would do as well).  ``verify`` recomputes the digests of responses; ``payloads=False``
    leaves the payload out."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        types = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.binary(), pa.bool_()]

        def flush(held):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held, size = [], 0
                for h, block in read_archive(uri):
                    http, _, body = block.partition(b"\r\n\r\n")
                    length = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))[15:])
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = h["WARC-Type"] == "response"
                    ok = base32_of_hex(hashlib.sha1(body).hexdigest()) == digest if response and verify else None
                    url = h.get("WARC-Target-URI")
                    held.append((uri, h["WARC-Record-ID"], h["WARC-Type"], unquote(url) if url is not None else None,
                                 h["WARC-Date"], digest, length, h.get("WARC-Refers-To"),
                                 body if payloads and response else None, ok))
                    size += len(body) if payloads else 0
                    if len(held) >= 2000 or size > 1 << 24:
                        yield flush(held)
                        held, size = [], 0
                if held:
                    yield flush(held)

    files = archives.select("archive")
    n = max(1, files.count())
    tasks = min(n, 4 * spark.sparkContext.defaultParallelism) if n < 4096 else n // 16
    return files.repartition(tasks, "archive").mapInArrow(run, RECORD)


def pages_read_back(pages: DataFrame, path: str, keep: bool = True) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as the archives written
    from ``pages`` hold them; a response whose payload does not match its digest is an error.
    With ``keep=False`` the rows (no payloads) are written and the archives removed."""
    spark = pages.sparkSession
    records = read_archives(spark, write_archives(pages, path), payloads=False)
    kind = pages.schema["page_id"].dataType
    checked = F.when(F.col("digest_ok").isNull() | F.col("digest_ok"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest in "), "record_id")))
    found = records.select(page_of(F.col("record_id")).cast(kind).alias("page_id"), "payload_bytes",
                           checked.alias("payload_digest"), "record_type",
                           page_of(F.col("refers_to")).cast(kind).alias("refers_to"))
    if keep:
        return found
    found = settle(found)
    discard(spark, path)
    return found
