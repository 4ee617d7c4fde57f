"""WARC archives written and read as tables of chunks.

A page becomes rows (record, chunk number, bytes) of at most ``CHUNK`` payload bytes.
Writers stream the chunks of their partition into archives, one gzip member per
record; readers stream the archives back into such rows, each with the digest of the
payload up to there. Neither side holds a whole record: digests, compression and
parsing all carry their state from chunk to chunk.

Payloads that occur more than once are stored once: of records with equal payloads
of at least ``REVISIT_FROM`` bytes the one with the smallest page id is a response,
the others are revisits that name it.

Archives go through a file system that pyarrow opens from the folder's address. A
task writes under a name of its own attempt and returns the archive's address when it
is complete; only returned archives are read, so what a lost executor leaves behind
does no harm.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import materialise

CHUNK = 64 * 1024
REVISIT_FROM = 100
ARCHIVE_BYTES = 1 << 30  # compressed size from which a task begins another archive
LEVEL = 1

ARCHIVES = "archive string, records long, bytes long"
CHUNKS = (
    "archive string, record_id string, record_type string, page_id long, url string, refers_to long, chunk int, "
    "chunk_bytes long, payload_bytes long, digest string, last boolean, data binary"
)


def chunked(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Pages as rows of payload chunks, with digest, record type and the page each revisit refers to.

    Payloads are shuffled only if Spark finds the table of repeated digests too large
    to broadcast; what decides about revisits are digests and ids.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).select("*", F.sha2("payload", 256).alias("digest"), F.length("payload").cast("long").alias("payload_bytes"))
    repeated = (
        rows.where(F.col("payload_bytes") >= REVISIT_FROM)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    typed = rows.join(repeated, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("payload_bytes") / chunk).cast("int"))
    stored = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    numbers = F.sequence(F.lit(0), F.when(revisit, F.lit(1)).otherwise(pieces) - 1)
    return typed.select(
        "page_id", "url", "digest", "payload_bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"), stored.alias("stored"), F.explode(numbers).alias("chunk"),
    ).select(
        "page_id", "url", "digest", "payload_bytes", "record_type", "refers_to", "chunk",
        F.substring("stored", F.col("chunk") * chunk + 1, F.lit(chunk)).alias("data"),
    )


def record_id(page_id: int | None, digest: str) -> str:
    """The same page and payload always make the same record id."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}"


def _headers(row: dict) -> tuple[bytes, bytes]:
    """WARC header and the HTTP header that begins the block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = len(http) + (row["payload_bytes"] if row["record_type"] == "response" else 0)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <{record_id(row['page_id'], row['digest'])}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {block}",
    ]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in row["url"]))
    if row["page_id"] is not None:
        lines.append(f"Page-ID: {row['page_id']}")
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{record_id(row['refers_to'], row['digest'])}>")
        lines.append(f"Refers-To-Page-ID: {row['refers_to']}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode(), http


def _opened(address: str):
    """File system and path of an address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(address)


def write(chunks: DataFrame, folder: str) -> DataFrame:
    """Write chunk rows into archives below ``folder``: (archive, records, bytes).

    A record's chunks must follow each other in one partition, as ``chunked`` leaves
    them. The result is checkpointed: archives are written once.
    """

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, path = _opened(folder)
        system.create_dir(path, recursive=True)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        sink, member, check, left, made, done = None, None, None, 0, 0, []

        def close() -> None:
            nonlocal sink
            if sink is not None:
                done[-1][2] = sink.tell()
                sink.close()
                sink = None

        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                row = {c: batch.column(k)[i].as_py() for k, c in enumerate(names)}
                if row["chunk"] == 0:
                    if sink is not None and sink.tell() >= ARCHIVE_BYTES:
                        close()
                    if sink is None:
                        made += 1
                        file = f"{name}-{made:04d}.warc.gz"
                        sink = system.open_output_stream(f"{path}/{file}", compression=None)
                        done.append([f"{folder.rstrip('/')}/{file}", 0, 0])
                    member, check = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), hashlib.sha256()
                    for part in _headers(row):
                        sink.write(member.compress(part))
                    left = row["payload_bytes"] if row["record_type"] == "response" else 0
                check.update(row["data"])
                sink.write(member.compress(row["data"]))
                left -= len(row["data"])
                if left == 0:
                    if row["record_type"] == "response" and check.hexdigest() != row["digest"]:
                        raise ValueError("a record's chunks are not in order")
                    sink.write(member.compress(b"\r\n\r\n") + member.flush())
                    done[-1][1] += 1
                    left = -1
        close()
        yield pa.record_batch([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["archive", "records", "bytes"])

    return materialise(chunks.mapInArrow(archive, ARCHIVES))


class _Stream:
    """Decompressed bytes of an archive, taken line by line or in pieces of bounded size."""

    def __init__(self, source):
        self.source, self.inflate, self.held = source, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        """Hold at least one more byte, or tell that the archive is over."""
        while True:
            if self.inflate.eof:  # the next member
                rest = self.inflate.unused_data or self.source.read(CHUNK)
                if not rest:
                    return False
                self.inflate = zlib.decompressobj(31)
            else:
                rest = self.inflate.unconsumed_tail or self.source.read(CHUNK)
                if not rest:
                    raise ValueError("the archive ends within a record")
            found = self.inflate.decompress(rest, CHUNK)
            if found:
                self.held += found
                return True

    def line(self) -> bytes | None:
        while b"\r\n" not in self.held:
            if not self._more():
                return None
        found, _, self.held = self.held.partition(b"\r\n")
        return found

    def take(self, n: int) -> bytes:
        """At most n bytes, at least one."""
        if not self.held and not self._more():
            raise ValueError("the archive ends within a record")
        found, self.held = self.held[:n], self.held[n:]
        return found

    def exactly(self, n: int) -> bytes:
        parts = []
        while n:
            parts.append(self.take(n))
            n -= len(parts[-1])
        return b"".join(parts)


def _fields(stream: _Stream) -> tuple[dict[str, str], int]:
    """Header fields up to the empty line, and the bytes they and that line take."""
    found, size = {}, 2
    while line := stream.line():
        size += len(line) + 2
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found, size


def read(archives: DataFrame, with_data: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of archives (column ``archive``), see ``CHUNKS``.

    ``digest`` and ``payload_bytes`` cover the payload up to and with the chunk, those of
    a record's ``last`` chunk all of it; for a revisit, which has no bytes, they are the
    ones that its headers name. Without data only the digests travel on.
    """
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in CHUNKS.split(", ")]

    def records(address: str) -> Iterator[tuple]:
        system, path = _opened(address)
        with system.open_input_stream(path, compression=None) as source:
            stream = _Stream(source)
            while (version := stream.line()) is not None:
                if not version.startswith(b"WARC/"):
                    raise ValueError(f"no record where one should begin in {address}")
                head, _ = _fields(stream)
                kind, left = head["warc-type"], int(head["content-length"])
                if kind not in ("response", "revisit"):  # other records are passed over
                    while left:
                        left -= len(stream.take(min(left, chunk)))
                    stream.exactly(4)
                    continue
                page, refers = head.get("page-id"), head.get("refers-to-page-id")
                common = (
                    address, head["warc-record-id"].strip("<>"), kind, None if page is None else int(page), head.get("warc-target-uri"),
                    None if refers is None else int(refers),
                )
                status = stream.line()
                http, size = _fields(stream)
                left -= len(status) + 2 + size
                if kind == "revisit":
                    yield (*common, 0, 0, int(http["content-length"]), head["warc-payload-digest"].removeprefix("sha256:"), True, b"")
                else:
                    number, total, check = 0, 0, hashlib.sha256()
                    while True:
                        data = stream.exactly(min(left, chunk))
                        left -= len(data)
                        total += len(data)
                        check.update(data)
                        digest = check.hexdigest()
                        if not left and digest != head["warc-payload-digest"].removeprefix("sha256:"):
                            raise ValueError(f"a damaged record in {address}")
                        yield (*common, number, len(data), total, digest, not left, data if with_data else None)
                        number += 1
                        if not left:
                            break
                stream.exactly(4)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def out() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * len(names)
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            for address in batch.column(0).to_pylist():
                for row in records(address):
                    rows.append(row)
                    held += row[7] if with_data else 0
                    if len(rows) >= 2000 or held >= 64 * CHUNK:
                        yield out()
                        rows, held = [], 0
        yield out()

    # one row per archive, each to a task of its own; a number that is asked for is not merged
    return archives.select("archive").repartition(max(1, archives.count())).mapInArrow(parse, CHUNKS)


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page, read the archives back, and return one row per record read.

    NULL html is an empty payload, stored as a response; pages that share the smallest
    id of their payload are all responses; a NULL id never is a payload's first; records
    without url lack that header; an empty table gives an empty result. Columns besides
    page_id, url and html are not read.
    """
    archives = write(chunked(pages), folder)
    return read(archives, with_data=False).where("last").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to", "record_id", "archive"
    )
