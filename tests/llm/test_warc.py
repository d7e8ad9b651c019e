import base64
import hashlib
import struct

import pytest
import zstandard

from flowlens.llm import queries, warc

from .conftest import SF

ROWS = [(5, "http://a/5", "same"), (3, "http://a/3", "same"), (9, "http://a/9", "same"), (1, None, None), (2, "http://é/ü?\r\nx%41", ""),
        (4, "u", "large " * 60_000), (6, "u", "été 😀"), (7, "u", "single"), (None, "v", "same"), (None, "w", "no id"), (8, "u", "a\r\n\r\nWARC/1.1\r\n"),
        (3, "http://a/3", "same")]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        data = html or ""
        of = first.get(data)
        revisit = len(data.encode()) >= least and of is not None and i != of and sum((x[2] or "") == data for x in rows) > 1
        out.append((i, len(data.encode()), digest(data), "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=repr)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id bigint, url string, html string, digest string, first_id string")


def test_read_back(spark, tmp_path):
    got = warc.pages_read_back(pages(spark, ROWS), f"file:{tmp_path}/w")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(ROWS)


@pytest.mark.parametrize("least", [0, 5, 10**6])
def test_payloads_and_urls_survive(spark, tmp_path, least):
    manifest = warc.write_archives(pages(spark, ROWS), f"{tmp_path}/w", min_bytes=least, sample_bytes=1000)
    records = warc.read_archives(spark, manifest).collect()
    want = expected(ROWS, least)
    assert sorted(r["record_type"] for r in records) == sorted(w[3] for w in want)
    kept = sorted(bytes(r["payload"]).decode() for r in records if r["record_type"] == "response")
    assert set(kept) == {h or "" for _, _, h in ROWS} and all(r["digest_ok"] for r in records if r["record_type"] == "response")
    assert sorted({r["target_uri"] for r in records if r["target_uri"]}) == sorted({u for _, u, _ in ROWS if u})
    assert manifest.agg({"records": "sum"}).first()[0] == len(ROWS)


def test_archive_layout(spark, tmp_path):
    many = [(i, f"http://h/{i}", f"<html><body>page {i} with the same frame around it</body></html>" * 5) for i in range(400)]
    manifest = warc.write_archives(pages(spark, many).coalesce(1), f"{tmp_path}/w").collect()
    frames = 0
    for m in manifest:
        data = open(m["archive"].removeprefix("file:"), "rb").read()
        assert len(data) == m["bytes"]
        magic, size = struct.unpack("<II", data[:8])
        assert magic == warc.SKIPPABLE and size == m["dictionary_bytes"] > 0
        packed, rest = zstandard.ZstdCompressionDict(data[8:8 + size]), data[8 + size:]
        while rest:  # every record is a frame that the dictionary alone opens
            d = zstandard.ZstdDecompressor(dict_data=packed).decompressobj()
            record = d.decompress(rest)
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            rest, frames = d.unused_data, frames + 1
    assert frames == len(many)


def test_equal_pages_give_equal_archives(spark, tmp_path):
    many = [(i, f"http://h/{i}", f"<p>{i % 90}</p>" * (1 + i % 40)) for i in range(500)] + [(7, "again", "x"), (None, None, "x")]
    found = []
    for k, rows in enumerate((many, many[::-1])):
        m = warc.write_archives(pages(spark, rows).coalesce(1), f"{tmp_path}/{k}", sample_bytes=2000).collect()
        found.append(sorted(open(x["archive"].removeprefix("file:"), "rb").read() for x in m))
    assert found[0] == found[1] and found[0]


def test_archives_are_removed_when_not_kept(spark, tmp_path):
    path = tmp_path / "w"
    got = warc.pages_read_back(pages(spark, ROWS), f"file:{path}", keep=False)
    assert not path.exists()
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(ROWS)


def test_a_damaged_payload_is_noticed(spark, tmp_path):
    path = f"{tmp_path}/x{warc.SUFFIX}"
    bad = warc.build_record("1", "u", "A" * 32, 4, None, b"text", "1970-01-01T00:00:00Z")
    warc.write_archive(iter([bad]), path, 10, 1000, 3)
    archives = spark.createDataFrame([(path,)], "archive string")
    assert [r["digest_ok"] for r in warc.read_archives(spark, archives).collect()] == [False]


def test_empty_table(spark, tmp_path):
    got = warc.pages_read_back(pages(spark, []), f"{tmp_path}/w")
    assert got.count() == 0 and got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_query(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op2_warc(spark, SF).collect()), key=repr) == expected(rows)
