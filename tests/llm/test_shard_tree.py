import math
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.rows import documents
from tidegauge.llm import shard_tree


def test_law_and_slots(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text é "), F.col("id")).alias("text"))
    got = shard_tree.assign(rows, 24).collect()
    assert {r.shard for r in got} == set(range(24))
    for r in got[:200]:
        data = f"text é {r.doc_id}".encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    for s in range(24):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots))) and 90 < len(slots) < 250
    moved = [r for r in got if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {24} and 80 < len(moved) < 260


def test_a_weight_moves_rows_within_its_subtrees_only(spark):
    ids = spark.range(3000).select(F.col("id").alias("doc_id"))
    before, after = shard_tree.tree_of(24), shard_tree.tree_of(24, {5: 3.0})
    pairs = ids.select(shard_tree.shard_of(F.col("doc_id"), before).alias("a"), shard_tree.shard_of(F.col("doc_id"), after).alias("b")).where("a <> b").collect()
    region = {s for s in range(8)}
    assert pairs and all(r.b in region for r in pairs)  # only into the region that grew
    assert all(r.b in {4, 5, 6, 7} for r in pairs if r.a in region)  # within it only into the rack that grew
    assert all(r.b == 5 for r in pairs if r.a in {4, 6, 7})  # within that only into the shard that grew


def test_shares_follow_weights(spark):
    ids = spark.range(20000).select(F.col("id").alias("doc_id"))
    tree = shard_tree.tree_of(10, {0: 4.0})
    n = {r["s"]: r["n"] for r in ids.groupBy(shard_tree.shard_of(F.col("doc_id"), tree).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n[0] / 20000 == pytest.approx(4 / 13, abs=0.02) and n[9] / 20000 == pytest.approx(1 / 13, abs=0.01)
    with pytest.raises(ValueError):
        shard_tree.tree_of(0)
    with pytest.raises(ValueError):
        shard_tree.tree_of(3, {1: 0.0})


def test_edge_rows(edge, none):
    got = shard_tree.assign(edge, 24)
    rows = got.collect()
    assert len(rows) == edge.count()
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id == 0} == {(8, 0)}
    assert shard_tree.assign(none, 24).count() == 0


def plain_shard(doc_id, node):
    """The walk down the tree in plain Python: at every level the child with the earliest time wins."""
    while node.children:
        times = []
        for i, child in enumerate(node.children):
            seed = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
            u = ((xxhash.xxh64_intdigest(child.name.encode(), seed) >> 11) + 0.5) * 2.0**-53
            times.append((-math.log(u) / child.weight, i))
        node = node.children[min(times)[1]] if len(times) > 1 else node.children[0]
    return node.shard


def test_as_a_plain_walk_says(spark, edge):
    rows = [(i * i * 7919 - 5, "x" * (i % 50), None, None, None) for i in range(3000)]
    for df, shards, weights in ((documents(spark, rows), 24, None), (documents(spark, rows), 7, {0: 5.0, 6: 0.25}), (edge, 24, None)):
        got = shard_tree.assign(df, shards, weights).collect()
        now, grown = shard_tree.tree_of(shards, weights), shard_tree.tree_of(shards + 1, weights)
        slots = {}
        for r in got:
            assert (r.shard, r.grown_shard) == (plain_shard(r.doc_id, now), plain_shard(r.doc_id, grown))
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(got) == df.count()
