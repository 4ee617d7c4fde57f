"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves of a tree of regions, racks and shards, each with a weight.
A row walks down the tree: at every level each child draws an exponential time
from a hash of the row's key and the child's name, divided by the child's weight,
and the first one wins. A child is chosen in proportion to its weight, and a draw
never depends on the siblings, so that a changed weight moves rows only into or
out of the subtree that holds it.

Everything is a DataFrame expression: one hash per child on the walked path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import number_within, uniform

SHARDS_PER_RACK = 4
RACKS_PER_REGION = 2


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; ``shard`` is set on leaves only."""

    name: str
    own_weight: float = 0.0
    shard: int | None = None
    children: tuple["Node", ...] = field(default=())

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree_of(shards: int, weights: dict[int, float] | None = None) -> Node:
    """Shards 0 .. shards - 1 in racks of four, racks in regions of two.

    ``weights`` sets single shards (1 if not named). A leaf's name is its number,
    and an inner node's that of its place, so that a tree with more shards keeps
    every node of a smaller one. Since regions fill up in order, a shard beyond
    full regions opens a region of its own: rows then move into that shard alone.
    """
    if shards < 1:
        raise ValueError("a tree needs at least one shard")
    given = weights or {}
    if any(not w > 0 for w in given.values()):
        raise ValueError("weights must be above 0")
    leaves = [Node(f"shard{i}", float(given.get(i, 1.0)), i) for i in range(shards)]
    racks = [
        Node(f"rack{i // SHARDS_PER_RACK}", children=tuple(leaves[i : i + SHARDS_PER_RACK]))
        for i in range(0, shards, SHARDS_PER_RACK)
    ]
    regions = [
        Node(f"region{i // RACKS_PER_REGION}", children=tuple(racks[i : i + RACKS_PER_REGION]))
        for i in range(0, len(racks), RACKS_PER_REGION)
    ]
    return Node("root", children=tuple(regions))


def shard_of(key: Column, node: Node) -> Column:
    """The shard of a key. NULL keys share one shard, which hashing decides like any other."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return shard_of(key, node.children[0])
    draws = [
        F.struct((-F.log(uniform(key, F.lit(c.name))) / F.lit(c.weight)).alias("time"), F.lit(i).alias("child"))
        for i, c in enumerate(node.children)
    ]
    first = F.array_min(F.array(*draws))["child"]
    if all(not c.children for c in node.children):
        return F.element_at(F.array(*[F.lit(c.shard) for c in node.children]), first + 1)
    # the draw is made once: a one-element array carries it into the branches
    def walk(child: Column) -> Column:
        branch = F.lit(None).cast("int")
        for i, c in reversed(list(enumerate(node.children))):
            branch = F.when(child == i, shard_of(key, c)).otherwise(branch)
        return branch

    return F.transform(F.array(first), walk)[0]


def assign(documents: DataFrame, shards: int, weights: dict[int, float] | None = None) -> DataFrame:
    """A shard and a slot for every document, and its shard were there one more.

    Law ``key``: ``doc_id`` and the tree decide alone. ``slot`` numbers a shard's rows
    gapless from 0, in parts by hash, so that no shard is sorted in one task.
    NULL texts count no bytes and have the CRC 0; rows with equal ids (NULL ids too)
    go to one shard and get slots of their own; an empty table gives an empty result.
    Other columns of ``documents`` are not read.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    rows = documents.select(
        "doc_id",
        (F.length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree_of(shards, weights)).cast("int").alias("shard"),
        shard_of(F.col("doc_id"), tree_of(shards + 1, weights)).cast("int").alias("grown_shard"),
    )
    buckets = max(1, int(documents.select("doc_id").count() ** 0.5))
    # by the row, not by the id alone: repeated ids are spread as well
    bucket = F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(buckets))
    return number_within(rows, ["shard"], [F.col("doc_id"), F.col("text_crc32"), F.col("size")], bucket, "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
