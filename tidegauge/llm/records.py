"""Token ids in length-delimited binary records with a separate offset index.

A data file is a run of frames: length of the data (8 bytes), masked checksum of
those 8 bytes (4), the data, masked checksum of the data (4). Numbers are
little-endian, checksums CRC-32C, rotated and offset as is usual for this framing, so
that any reader of such record files can walk the frames. The data of a record are a
version, flags, the document's id, and its token ids in two or four bytes each. Beside
each data file lies its index: 16 bytes a record, where its frame begins and how long
its data are, so that records can be read in any order without walking the file.

Documents are put in order by ranges of their ids, sorted range by range, and each
range is tokenised and written where it was sorted. A task writes under a name of its
own attempt and returns it when its files are complete; only returned files are read,
so what a lost executor leaves behind does no harm.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import as_text, materialise
from tidegauge.llm.packing import word_ids

END_ID = 2
FILE_BYTES = 256 << 20  # from here on a task begins another data file
BLOCK = 1 << 20  # bytes that are checked or written together
HEAD = "<BBq"  # version, flags, doc_id
HAS_ID, WIDE = 1, 2  # flags: there is a doc_id, token ids have four bytes

FILES = "part int, number int, file string, index string, records long, tokens long, bytes long"
RECORDS = "file string, record long, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
ENTRIES = "file string, record long, offset long, length long"

# ------------------------------------------------------------------ checksums

# Fixed values of the format: CRC-32C's polynomial (bits reversed) and the mask.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
LANE = 64  # bytes of a record that one row of the checksum matrix holds


def _after_zeros() -> list[np.ndarray]:
    """Tables of what 1, 2, 4, ... zero bytes do to a checksum state, by the state's bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = (one >> 1) ^ np.where(one & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    states = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    tables = [one[states & 255] ^ (states >> 8)]
    for _ in range(40):
        tables.append(_step(tables[-1], tables[-1]))
    return tables


def _step(table: np.ndarray, state: np.ndarray) -> np.ndarray:
    return table[0][state & 255] ^ table[1][(state >> 8) & 255] ^ table[2][(state >> 16) & 255] ^ table[3][state >> 24]


ZEROS = _after_zeros()
BY_BYTE = ZEROS[0][0].tolist()


def _shifted(state: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Each state after so many zero bytes."""
    state = state.copy()
    for bit in range(int(zeros.max(initial=0)).bit_length()):
        some = (zeros >> bit) & 1 == 1
        state[some] = _step(ZEROS[bit], state[some])
    return state


def _from_nothing(parts: Sequence[bytes]) -> np.ndarray:
    """States of all parts, begun at 0: rows of LANE bytes in step, then joined.

    A state begun at 0 stays 0 over zero bytes, so a part's first row is filled up on
    its left; a row's state counts as moved on by all the rows behind it.
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    rows = np.maximum(1, -(-sizes // LANE))
    ends = np.cumsum(rows)
    lanes = np.zeros(int(ends[-1]) * LANE, np.uint8)
    for part, end in zip(parts, (ends * LANE).tolist()):
        lanes[end - len(part) : end] = np.frombuffer(part, np.uint8)
    words = np.ascontiguousarray(lanes.view("<u4").reshape(-1, LANE // 4).T)
    state = np.zeros(words.shape[1], np.uint32)
    for word in words:
        state = _step(ZEROS[2], state ^ word)
    behind = np.repeat(ends, rows) - 1 - np.arange(len(state))
    return np.bitwise_xor.reduceat(_shifted(state, behind * LANE), ends - rows)


def crc32c(payloads: Sequence[bytes]) -> np.ndarray:
    """CRC-32C of each payload, in blocks of bounded size."""
    parts = [p[at : at + BLOCK] for p in payloads for at in range(0, max(1, len(p)), BLOCK)]
    found, group, held = [], [], 0
    for part in parts:
        group.append(part)
        held += len(part) + LANE
        if held >= BLOCK:
            found.append(_from_nothing(group))
            group, held = [], 0
    if group:
        found.append(_from_nothing(group))
    states = np.concatenate(found) if found else np.zeros(0, np.uint32)
    counts = np.array([max(1, -(-len(p) // BLOCK)) for p in payloads], np.int64)
    sizes = np.array([len(p) for p in parts], np.int64)
    if len(parts) > len(payloads):  # long payloads: each block counts as moved on by the ones behind it
        ends = np.repeat(np.cumsum(np.add.reduceat(sizes, np.cumsum(counts) - counts)), counts)
        states = _shifted(states, ends - np.cumsum(sizes))
        states = np.bitwise_xor.reduceat(states, np.cumsum(counts) - counts)
    whole = np.array([len(p) for p in payloads], np.int64)
    return states ^ _shifted(np.full(len(payloads), 0xFFFFFFFF, np.uint32), whole) ^ np.uint32(0xFFFFFFFF)


def length_in(head: bytes, where: str) -> int:
    """The length that a frame's first twelve bytes name; it is checked before it is trusted."""
    state = 0xFFFFFFFF
    for byte in head[:8]:
        state = BY_BYTE[(state ^ byte) & 255] ^ (state >> 8)
    if len(head) < 12 or masked(np.array([state ^ 0xFFFFFFFF], np.uint32)).astype("<u4").tobytes() != head[8:]:
        raise ValueError(f"a damaged length in {where}")
    return struct.unpack_from("<Q", head)[0]


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


# --------------------------------------------------------------------- frames


def serialized(doc_id: int | None, ids: np.ndarray, wide: bool) -> bytes:
    flags = (0 if doc_id is None else HAS_ID) | (WIDE if wide else 0)
    return struct.pack(HEAD, 1, flags, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()


def parsed(data: bytes) -> tuple[int | None, np.ndarray]:
    version, flags, doc_id = struct.unpack_from(HEAD, data)
    if version != 1:
        raise ValueError(f"unknown version {version} of a record")
    ids = np.frombuffer(data, "<u4" if flags & WIDE else "<u2", offset=struct.calcsize(HEAD))
    return (doc_id if flags & HAS_ID else None), ids.astype("<u4")


def frames(payloads: Sequence[bytes]) -> list[bytes]:
    sizes = [struct.pack("<Q", len(p)) for p in payloads]
    checks = masked(crc32c([*sizes, *payloads])).astype("<u4")
    mine, n = checks.tobytes(), 4 * len(payloads)
    return [s + mine[4 * i : 4 * i + 4] + p + mine[n + 4 * i : n + 4 * i + 4] for i, (s, p) in enumerate(zip(sizes, payloads))]


def checked(found: Sequence[tuple[bytes, bytes]], where: str) -> list[bytes]:
    """The data of frames given as (data, checksum); damaged data raise."""
    data = [d for d, _ in found]
    if (masked(crc32c(data)) != np.frombuffer(b"".join([c for _, c in found]), "<u4")).any():
        raise ValueError(f"a damaged record in {where}")
    return data


def _opened(address: str):
    """File system and path of an address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(address)


class _Files:
    """What one task writes: data files, each with its index beside it."""

    def __init__(self, folder: str):
        task = TaskContext.get()
        self.system, self.path = _opened(folder)
        self.system.create_dir(self.path, recursive=True)
        self.folder, self.part, self.sink, self.done = folder.rstrip("/"), task.partitionId(), None, []
        self.name = f"part-{self.part:06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"

    def add(self, payloads: list[bytes], tokens: list[int]) -> None:
        for frame, count in zip(frames(payloads), tokens):
            if self.sink is not None and self.at + len(frame) > FILE_BYTES:
                self.close()
            if self.sink is None:
                file = f"{self.name}-{len(self.done):04d}.records"
                self.sink = self.system.open_output_stream(f"{self.path}/{file}", compression=None)
                self.index = self.system.open_output_stream(f"{self.path}/{file}.index", compression=None)
                self.at = 0
                self.done.append([self.part, len(self.done), f"{self.folder}/{file}", f"{self.folder}/{file}.index", 0, 0, 0])
            self.sink.write(frame)
            self.index.write(struct.pack("<QQ", self.at, len(frame) - 16))
            self.at += len(frame)
            here = self.done[-1]
            here[4:] = [here[4] + 1, here[5] + count, self.at]

    def close(self) -> None:
        if self.sink is not None:
            self.sink.close()
            self.index.close()
            self.sink = None


def write(documents: DataFrame, vocabulary: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write all documents in ascending doc_id order; one row for each data file, see ``FILES``.

    Files in the order of (part, number) hold the documents in order, NULL ids first and
    rows of one id by the hash of their text. The result is checkpointed: files are
    written once.
    """

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, files = word_ids(vocabulary), _Files(folder)
        wide = words.tokenizer.get_vocab_size() > 65536 or end_id > 65535
        end = np.array([end_id], "<u4").tobytes()
        payloads, tokens, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(b"".join(map(words.__getitem__, text.as_py().encode().split())) + end, "<u4")
                payloads.append(serialized(doc_id, ids, wide))
                tokens.append(len(ids))
                held += len(payloads[-1])
                if held >= BLOCK:
                    files.add(payloads, tokens)
                    payloads, tokens, held = [], [], 0
        files.add(payloads, tokens)
        files.close()
        names = [c.split()[0] for c in FILES.split(", ")]
        types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array([d[k] for d in files.done], t) for k, t in enumerate(types)], names=names)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), as_text(F.col("text").cast("string")).alias("text"))
    tie = F.xxhash64("text")  # an id that very many rows have is spread over ranges by its texts
    ranged = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
    ordered = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    return materialise(ordered.mapInArrow(tokenised, FILES))


def with_starts(files: DataFrame) -> DataFrame:
    """Files with the number of token ids in all files before: a running sum over one row per file."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every record of the files, each file walked by a task of its own, see ``RECORDS``.

    ``start`` counts the token ids of all records before, in the files' order. Lengths,
    checksums and the number of records and ids are verified; a difference raises.
    """
    names = [c.split()[0] for c in RECORDS.split(", ")]
    types = [pa.string(), *[pa.int64()] * 5, pa.binary()]

    def walk(file: str, start: int, records: int, tokens: int) -> Iterator[list[tuple]]:
        system, path = _opened(file)
        number, at = 0, start
        with system.open_input_stream(path, compression=None, buffer_size=BLOCK) as source:
            more = True
            while more:
                group, held = [], 0
                while held < BLOCK:
                    head = source.read(12)
                    if not head:
                        more = False
                        break
                    size = length_in(head, file)
                    data, check = source.read(size), source.read(4)
                    if len(data) < size or len(check) < 4:
                        raise ValueError(f"{file} ends within a record")
                    group.append((data, check))
                    held += size + 16
                rows = []
                for data in checked(group, file):
                    doc_id, ids = parsed(data)
                    raw = ids.tobytes()
                    rows.append((file, number, doc_id, at, len(ids), zlib.crc32(raw), raw if with_ids else None))
                    number, at = number + 1, at + len(ids)
                yield rows
        if (number, at - start) != (records, tokens):
            raise ValueError(f"{file} should hold {records} records with {tokens} ids")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for rows in walk(row["file"], row["start"], row["records"], row["tokens"]):
                    columns = zip(*rows) if rows else [[]] * len(names)
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    # one row for each file, in one partition behind the running sum: dealt one by one
    dealt = with_starts(files).select("file", "start", "records", "tokens").repartition(max(1, files.count()))
    return dealt.mapInArrow(parse, RECORDS)


def entries(files: DataFrame) -> DataFrame:
    """The offset indexes as a table, see ``ENTRIES``; to be shuffled before ``fetch``."""
    names = [c.split()[0] for c in ENTRIES.split(", ")]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, index in zip(*(batch.column(c).to_pylist() for c in ("file", "index"))):
                system, path = _opened(index)
                number = 0
                with system.open_input_stream(path, compression=None, buffer_size=BLOCK) as source:
                    while raw := source.read(16 * 10_000):
                        found = np.frombuffer(raw, "<u8").reshape(-1, 2).astype(np.int64)
                        numbers = np.arange(number, number + len(found))
                        number += len(found)
                        columns = [pa.array([file] * len(found)), pa.array(numbers), pa.array(found[:, 0]), pa.array(found[:, 1])]
                        yield pa.record_batch(columns, names=names)

    return files.select("file", "index").repartition(max(1, files.count())).mapInArrow(listed, ENTRIES)


def fetch(wanted: DataFrame) -> DataFrame:
    """Records named by index entries, in the entries' order: (file, record, doc_id, ids)."""

    def sought(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources = {}
        for batch in batches:
            group, rows, held = [], [], 0

            def out() -> pa.RecordBatch:
                found = [parsed(d) for d in checked(group, "the files of an index")] if group else []
                columns = [
                    pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([d for d, _ in found], pa.int64()), pa.array([i.tobytes() for _, i in found], pa.binary()),
                ]
                return pa.record_batch(columns, names=["file", "record", "doc_id", "ids"])

            for file, record, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "record", "offset", "length"))):
                if file not in sources:
                    if len(sources) >= 64:  # open files of a task
                        sources.pop(next(iter(sources))).close()
                    system, path = _opened(file)
                    sources[file] = system.open_input_file(path)
                sources[file].seek(offset)
                frame = sources[file].read(length + 16)
                if length_in(frame[:12], file) != length:
                    raise ValueError(f"the index of {file} names another length")
                group.append((frame[12:-4], frame[-4:]))
                rows.append((file, record))
                held += len(frame)
                if held >= BLOCK:
                    yield out()
                    group, rows, held = [], [], 0
            yield out()
        for source in sources.values():
            source.close()

    return wanted.select("file", "record", "offset", "length").mapInArrow(sought, "file string, record long, doc_id long, ids binary")


def round_trip(documents: DataFrame, vocabulary: str, folder: str) -> DataFrame:
    """Write every document, read the files back, one row per record: doc_id, start, n_tokens, ids_crc32.

    NULL and empty texts are the end id alone; a NULL doc_id stays NULL and comes first;
    rows with equal ids are records of their own, by the hash of their text; an empty table
    gives no files and an empty result. Columns besides doc_id and text are not read.
    """
    return read(write(documents, vocabulary, folder), with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")
