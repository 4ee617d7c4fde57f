import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.rows import documents, prose
from tidegauge.llm import records
from tidegauge.llm.common import vocabulary

VOCABULARY = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def plain_crc(data):
    state = 0xFFFFFFFF
    for byte in data:
        state ^= byte
        for _ in range(8):
            state = (state >> 1) ^ (0x82F63B78 if state & 1 else 0)
    return state ^ 0xFFFFFFFF


def test_checksums(monkeypatch):
    assert records.crc32c([b"123456789"]).tolist() == [0xE3069283]  # the check value of CRC-32C
    payloads = [os.urandom(n) for n in (0, 1, 63, 64, 65, 128, 999, 1000, 1001, 5000, 2)]
    wanted = [plain_crc(p) for p in payloads]
    assert records.crc32c(payloads).tolist() == wanted
    monkeypatch.setattr(records, "BLOCK", 1000)  # long payloads go block by block
    assert records.crc32c(payloads).tolist() == wanted
    assert records.crc32c([]).tolist() == []


def walk(path):
    """The frames of a file by the format alone: (offset, data)."""
    raw, at, out = open(path, "rb").read(), 0, []
    while at < len(raw):
        size = int.from_bytes(raw[at : at + 8], "little")
        for begin, n in ((at, 8), (at + 12, size)):
            crc = plain_crc(raw[begin : begin + n])
            mask = (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF
            assert int.from_bytes(raw[begin + n : begin + n + 4], "little") == mask
        out.append((at, raw[at + 12 : at + 12 + size]))
        at += size + 16
    return out


def test_files_hold_the_documents_in_order(spark, tokenizer, tmp_path, monkeypatch):
    rows = [((i * 7) % 200, prose(i, (i * 13) % 90), None, None, None) for i in range(200)]
    files = records.write(documents(spark, rows), VOCABULARY, f"file://{tmp_path}/a")
    listed = files.orderBy("part", "number").collect()
    by_id = {r[0]: ids_of(tokenizer, r[1]) for r in rows}
    seen = []
    for f in listed:
        found = walk(f.file.removeprefix("file://"))
        index = np.fromfile(f["index"].removeprefix("file://"), "<u8").reshape(-1, 2).tolist()
        assert index == [[at, len(data)] for at, data in found] and f.records == len(found)
        for _, data in found:
            doc_id, ids = records.parsed(data)
            assert (ids == by_id[doc_id]).all()
            seen.append(doc_id)
    assert seen == sorted(by_id)
    got = records.read(files).collect()
    starts = dict(zip(sorted(by_id), np.cumsum([0] + [len(by_id[i]) for i in sorted(by_id)]).tolist()))
    assert {(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in got} == {(i, starts[i], len(x), x.tobytes()) for i, x in by_id.items()}
    # shuffled reads by the index alone
    shuffled = records.fetch(records.entries(files).orderBy(F.rand(3))).collect()
    assert {(r.doc_id, bytes(r.ids)) for r in shuffled} == {(i, x.tobytes()) for i, x in by_id.items()} and len(shuffled) == 200


def test_damage_is_found(spark, tmp_path):
    rows = [(i, prose(i, 20), None, None, None) for i in range(5)]
    files = records.write(documents(spark, rows).coalesce(1), VOCABULARY, f"file://{tmp_path}/a")
    path = files.where("records > 1").first().file.removeprefix("file://")
    raw = open(path, "rb").read()
    for at in (0, 9, 30, len(raw) - 1):
        open(path, "wb").write(raw[:at] + bytes([raw[at] ^ 1]) + raw[at + 1 :])
        with pytest.raises(Exception, match="damaged"):
            records.read(files).collect()
    open(path, "wb").write(raw[: walk_end(raw)])
    with pytest.raises(Exception, match="should hold"):
        records.read(files).collect()


def walk_end(raw):
    return int.from_bytes(raw[:8], "little") + 16


def test_files_are_bounded(spark, tmp_path, tokenizer):
    rows = [(i, prose(i, 50), None, None, None) for i in range(60)]
    system = records._opened(f"file://{tmp_path}")[0]
    assert system is not None
    payloads = [records.serialized(r[0], ids_of(tokenizer, r[1]), False) for r in rows]
    files = object.__new__(records._Files)
    files.system, files.path, files.folder, files.part, files.sink, files.done, files.name = system, str(tmp_path), f"file://{tmp_path}", 0, None, [], "x"
    before, records.FILE_BYTES = records.FILE_BYTES, 1000
    try:
        files.add(payloads, [1] * 60)
        files.close()
    finally:
        records.FILE_BYTES = before
    assert len(files.done) > 3 and all(d[6] <= 1000 for d in files.done) and sum(d[4] for d in files.done) == 60
    frames = [data for d in files.done for _, data in walk(d[2].removeprefix("file://"))]
    assert frames == payloads


def test_edge_rows(edge, none, tokenizer, tmp_path):
    got = records.round_trip(edge, VOCABULARY, f"file://{tmp_path}/a").collect()
    rows = [(r.doc_id, ids_of(tokenizer, r.text)) for r in edge.collect()]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in rows)
    at, last = 0, -1
    for r in sorted(got, key=lambda r: r.start):  # gapless, NULL ids first, then ascending
        assert r.start == at and (-1 if r.doc_id is None else r.doc_id) >= last
        at, last = at + r.n_tokens, -1 if r.doc_id is None else r.doc_id
    empty = records.round_trip(none, VOCABULARY, f"file://{tmp_path}/b")
    assert empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and empty.count() == 0


def test_one_id_with_most_rows_is_spread(spark, tokenizer, tmp_path):
    rows = [(7, prose(i, 6), None, None, None) for i in range(900)] + [(i, "x", None, None, None) for i in range(100)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or ranges this small are joined again
    try:
        files = records.write(documents(spark, rows), VOCABULARY, f"file://{tmp_path}/a").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(f.records for f in files) < 600 and sum(f.records for f in files) == 1000
