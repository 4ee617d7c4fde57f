import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import warc

SCHEMA = "page_id long, url string, html string"
BIG = "<p>größe</p>" * 30_000


def pages():
    long = "x" * 100
    rows = [
        (5, "http://a/5", long), (3, "http://a/3", long), (9, None, long), (4, "http://a/4", "x" * 99), (6, "http://a/6", "x" * 99),
        (1, "http://a/\r\nWARC/1.1", None), (2, "http://a/2", ""), (7, "http://a/7", BIG), (8, "http://a/8", BIG), (None, None, None),
        (None, "u", long), (10, "u", "a\r\n\r\nWARC/1.1\r\nb" * 10), (3, "http://a/3", long), (11, "é", "\U0001f600é"),
    ]
    return rows + [(100 + i, "u", f"page {i} " * 30) for i in range(40)]


def slow(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(first.get(data, i), i)
    count = {}
    for _, _, html in rows:
        count[(html or "").encode()] = count.get((html or "").encode(), 0) + 1
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = data in first and count[data] > 1 and first[data] != i
        out.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[data] if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame(pages(), SCHEMA)
    return df.select("*", *[F.lit("own").alias(c) for c in ("digest", "payload", "chunk", "first", "n", "data")])


def test_round_trip(table, tmp_path):
    got = warc.round_trip(table, str(tmp_path)).collect()
    shown = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(shown, key=str) == slow(pages())


def test_chunks_carry_running_digests(table, tmp_path):
    archives = warc.write(warc.chunked(table, chunk=1000), str(tmp_path))
    assert archives.agg(F.sum("records")).first()[0] == len(pages())
    rows = warc.read(archives, chunk=4096).where("page_id = 7").orderBy("chunk").collect()
    data, check = b"", hashlib.sha256()
    for i, r in enumerate(rows):
        assert r.chunk == i and len(r.data) == r.chunk_bytes <= 4096
        check.update(r.data)
        data += r.data
        assert r.digest == check.hexdigest() and r.payload_bytes == len(data)
    assert data == BIG.encode() and [r.last for r in rows] == [False] * (len(rows) - 1) + [True]


def test_archives_are_plain_warc(table, tmp_path):
    archives = warc.write(warc.chunked(table), str(tmp_path))
    records = 0
    for row in archives.collect():
        with gzip.open(row.archive) as f:
            while version := f.readline():
                assert version == b"WARC/1.1\r\n"
                head = {}
                while (line := f.readline()) != b"\r\n":
                    name, _, value = line.decode().partition(": ")
                    head[name] = value.strip()
                block = f.read(int(head["Content-Length"]))
                assert f.read(4) == b"\r\n\r\n" and block.startswith(b"HTTP/1.1 200 OK\r\n")
                body = block.partition(b"\r\n\r\n")[2]
                if head["WARC-Type"] == "response":
                    assert "sha256:" + hashlib.sha256(body).hexdigest() == head["WARC-Payload-Digest"]
                else:
                    assert not body and "WARC-Refers-To" in head
                records += 1
    assert records == len(pages())


def test_damage_is_found(table, tmp_path):
    archives = warc.write(warc.chunked(table.where("page_id = 7")).coalesce(1), str(tmp_path))
    path = archives.where("records > 0").first().archive
    whole = gzip.open(path).read()
    with gzip.open(path, "wb") as f:
        f.write(whole.replace(b"gr\xc3\xb6", b"gra\xb6", 1))
    with pytest.raises(Exception, match="damaged"):
        warc.read(archives).collect()
    with open(path, "wb") as f:
        f.write(gzip.compress(whole)[:-400])
    with pytest.raises(Exception, match="ends within"):
        warc.read(archives).collect()


def test_empty_table(table, tmp_path):
    assert warc.round_trip(table.limit(0), str(tmp_path)).count() == 0
