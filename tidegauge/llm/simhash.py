"""Near-duplicates by SimHash, found with a Gray-ordered hierarchical index.

Each text becomes 64 bits: bit b is set if it is set in over half of the hashes of
its word shingles. Documents whose fingerprints differ in at most two bits are
linked, and a class holds what links reach.

1. Documents shrink to their different fingerprints, by partial aggregation; copies
   never meet each other again.
2. Two fingerprints at most two bits apart agree on at least two of four 16-bit
   blocks. Each fingerprint goes to its six pairs of blocks, so that every linked
   pair meets in a small group. A group of over ``HEAVY`` fingerprints is dealt out
   once more in the same way by the four 8-bit blocks of its other 32 bits; what
   then agrees has 16 free bits, so no group exceeds 65 536 different fingerprints.
3. A group is sorted by Gray rank, which puts fingerprints with few differing bits
   side by side. Runs of them become nodes that keep the bits all members share;
   a parent takes over the bits its children share. A search adds up the differences
   from the root down and leaves a whole node once they exceed two.
4. Groups return spanning links only. Classes come from label propagation with
   pointer jumping on those links, checkpointed at each step.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm import shingles
from tidegauge.llm.common import materialise, settle, spare

RADIUS = 2
SHINGLE = 3
SEED = 42
HEAVY = 4096
FANOUT = 8
QUERIES_AT_ONCE = 2048


def fingerprint_of(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of one whole text as a signed 64-bit number; without words 0."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        digests = xxhash.xxh64_digest(line, SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(line[a:b], SEED) for a, b in spans])
    hashes = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        set_bits += np.unpackbits(hashes[at : at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes)).tobytes(), "big", signed=True)


def fingerprint(text: Column) -> Column:
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")

    return simhash(text)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical index over groups of fingerprints, each group in Gray order.

    Level 0 holds the fingerprints; a node above covers ``FANOUT`` nodes of its group.
    ``shared`` marks the bits on which all fingerprints below agree, ``own`` those of
    them that the parent does not share already.
    """

    def __init__(self, codes: np.ndarray, groups: np.ndarray):
        order = np.lexsort((gray_rank(codes), groups))
        self.order, self.codes, groups = order, codes[order], groups[order]
        first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
        size = np.diff(np.r_[first, len(groups)])
        self.group = np.repeat(np.arange(len(first)), size)
        alike, anyof = self.codes, self.codes
        self.levels = [{"alike": alike, "shared": np.full(len(codes), ~np.uint64(0)), "child": None, "last": np.arange(len(codes))}]
        while size.max(initial=1) > 1 or len(self.levels) == 1:
            up = -(-size // FANOUT)
            child = np.concatenate([np.arange(f, f + s, FANOUT) for f, s in zip(first, size)]) if len(first) else first
            ends = np.r_[child[1:], len(alike)]
            alike, anyof = np.bitwise_and.reduceat(alike, child), np.bitwise_or.reduceat(anyof, child)
            self.levels.append(
                {"alike": alike, "shared": ~(alike ^ anyof), "child": child, "end": ends, "last": self.levels[-1]["last"][ends - 1]}
            )
            size, first = up, np.r_[0, np.cumsum(up)[:-1]]
        for below, above in zip(self.levels, self.levels[1:]):
            parent = np.repeat(np.arange(len(above["child"])), above["end"] - above["child"])
            below["own"] = below["shared"] & ~above["shared"][parent]
        self.levels[-1]["own"] = self.levels[-1]["shared"]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions (in the given order) of pairs of one group at most ``radius`` bits apart."""
        for at in range(0, len(self.codes), QUERIES_AT_ONCE):
            query = np.arange(at, min(at + QUERIES_AT_ONCE, len(self.codes)))
            node, apart = self.group[query], np.zeros(len(query), np.int64)
            for depth in range(len(self.levels) - 1, -1, -1):
                level = self.levels[depth]
                apart = apart + np.bitwise_count((self.codes[query] ^ level["alike"][node]) & level["own"][node])
                near = (apart <= radius) & (level["last"][node] > query)  # each pair once
                query, node, apart = query[near], node[near], apart[near]
                if depth:
                    width = level["end"][node] - level["child"][node]
                    within = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                    node = np.repeat(level["child"][node], width) + within
                    query, apart = np.repeat(query, width), np.repeat(apart, width)
            yield self.order[query], self.order[node]


def spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For 0 .. n - 1, the smallest number that the pairs connect it with."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            low = np.minimum(label[a], label[b])
            if np.array_equal(low, label[a]) and np.array_equal(low, label[b]):
                break
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while not np.array_equal(label, label[label]):
                label = label[label]
    return label


def _group_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of the groups of one partition, sorted by group; a group may span batches."""

    def found(rows: pd.DataFrame, number: np.ndarray) -> pd.DataFrame:
        size = np.bincount(number)
        rows, number = rows[size[number] > 1], number[size[number] > 1]
        if not len(rows):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        signed = rows["fp"].to_numpy(np.int64)
        by_value = np.argsort(signed, kind="stable")  # the smallest of a class stands first
        label = spanning(len(rows), GrayIndex(signed[by_value].view(np.uint64), number[by_value]).links(RADIUS))
        moved = label != np.arange(len(rows))
        return pd.DataFrame({"a": signed[by_value][moved], "b": signed[by_value][label[moved]]})

    settle()
    keys, rest = ["combo", "key", "sub", "subkey"], None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        values = rows[keys].to_numpy(np.int64)
        number = np.cumsum(np.r_[True, (values[1:] != values[:-1]).any(axis=1)]) - 1 if len(rows) else np.zeros(0, np.int64)
        done = number < number[-1] if len(rows) else np.zeros(0, bool)
        rest = rows[~done]
        if done.any():
            yield found(rows[done].reset_index(drop=True), number[done])
    if rest is not None and len(rest):
        yield found(rest.reset_index(drop=True), np.zeros(len(rest), np.int64))


def _pairs_of_blocks(code: Column, width: int, skip: tuple[Column, Column] | None = None) -> list[Column]:
    """Structs (number of the pair, the pair's bits) for the pairs of the four lowest blocks of ``width`` bits."""
    block = [F.shiftrightunsigned(code, i * width).bitwiseAND(F.lit((1 << width) - 1)) for i in range(4)]
    return [
        F.struct(F.lit(i).alias("combo"), F.shiftleft(block[a], width).bitwiseOR(block[b]).alias("key"))
        for i, (a, b) in enumerate(combinations(range(4), 2))
    ]


def links(codes: DataFrame) -> DataFrame:
    """Spanning links (a, b) between the different fingerprints ``fp``."""
    keyed = codes.select("fp", F.explode(F.array(*_pairs_of_blocks(F.col("fp"), 16))).alias("k")).select("fp", "k.combo", "k.key")
    heavy = keyed.groupBy("combo", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HEAVY).drop("n")
    marked = keyed.join(heavy.withColumn("heavy", F.lit(True)), ["combo", "key"], "left")
    # of a heavy group, the two blocks that are not part of its key lie side by side
    block = [F.shiftrightunsigned("fp", i * 16).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    other = F.lit(None).cast("long")
    for i, (a, b) in enumerate(combinations(range(4), 2)):
        c, d = [x for x in range(4) if x not in (a, b)]
        other = F.when(F.col("combo") == i, F.shiftleft(block[c], 16).bitwiseOR(block[d])).otherwise(other)
    again = F.array(*[F.struct(s["combo"].alias("sub"), s["key"].alias("subkey")) for s in _pairs_of_blocks(F.col("other"), 8)])
    once = F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("subkey")))
    rows = marked.withColumn("other", other).select(
        "fp", "combo", "key", F.explode(F.when(F.col("heavy"), again).otherwise(once)).alias("s")
    )
    keys = ["combo", "key", "sub", "subkey"]
    grouped = rows.select("fp", "combo", "key", "s.sub", "s.subkey").repartition(*keys).sortWithinPartitions(*keys)
    return grouped.mapInPandas(_group_links, "a long, b long").distinct()


def classes(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of the links reaches: (node, root)."""
    both = materialise(edges.select("a", "b").unionAll(edges.select(F.col("b"), F.col("a"))))
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")).select("node", "root"))
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("heard"))
        # kept, so that the side of a large class's root is a shuffle of its own, which Spark can split
        lower = materialise(
            labels.join(heard, labels["node"] == heard["a"]).select("node", F.col("root").alias("old"), F.least("root", "heard").alias("root"))
        )
        up = lower.select(F.col("node").alias("at"), F.col("root").alias("up"))
        stepped = materialise(
            lower.join(up, lower["root"] == up["at"], "left").select("node", "old", F.coalesce("up", "root").alias("root"))
        )
        labels = stepped.select("node", "root")
        if stepped.where("root <> old").limit(1).count() == 0:
            return labels


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    NULL and empty texts and texts of blanks have the fingerprint zero and are linked
    like others; shorter texts than a shingle hash as a whole. Repeated rows share a
    class; a NULL ``doc_id`` names a class only if it holds nothing else. An empty
    table gives an empty result. Columns besides doc_id and text are not read.
    """
    marked = materialise(documents.select("doc_id", fingerprint(F.col("text")).alias("fp")))
    codes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    nodes = classes(links(codes))
    rooted = nodes.join(codes, nodes["node"] == codes["fp"]).select("fp", "root", "first")
    least = materialise(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    of_fp = codes.join(rooted.join(least, "root").select("fp", "component_id"), "fp", "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id")
    )
    of_fp = materialise(of_fp)  # both sides of the join are then shuffles that Spark can split where a copy is common
    return marked.join(of_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _fingerprint_and_bands(text: Column) -> Column:
    @F.pandas_udf("fp long, bands array<long>")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        settle()
        known = shingles.Words()
        for texts in batches:
            bands = [shingles.keys(shingles.shingles(t, known)) for t in texts]
            yield pd.DataFrame({"fp": np.array([fingerprint_of(t) for t in texts], np.int64), "bands": bands})

    return both(text)


def representatives(documents: DataFrame) -> DataFrame:
    """One document of each class of near-duplicates, all columns kept.

    Texts are linked if their fingerprints are, or if they share at least
    ``shingles.ALIKE`` of their five-word shingles. A class is what links reach,
    whatever the ids: different texts with one id or with none are classes of their own. Of a class the document with the
    smallest id stays, one without an id only if no other has one; of several with
    that id the shortest text, then the first in order.
    """
    marked = documents.select("doc_id", F.length("text").alias("len"), F.xxhash64("text").alias("th"), _fingerprint_and_bands(F.col("text")).alias("s"))
    marked = materialise(marked.select("doc_id", "len", "th", "s.fp", "s.bands"))
    nodes = classes(links(marked.select("fp").distinct()).unionAll(shingles.links(documents, marked)).distinct())
    rooted = marked.join(nodes, marked["fp"] == nodes["node"], "left").select("doc_id", "len", "th", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted)
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "len")
    least = rooted.groupBy("root").agg(F.min(place).alias("least"))
    # texts of one class, id and length differ at most in order
    tied = rooted.join(least, "root").where(place.eqNullSafe(F.col("least"))).groupBy("root", "doc_id", "len", "th").agg(F.count(F.lit(1)).alias("n"))
    of_root = tied.groupBy("root").agg(F.sum("n").alias("tied"))
    chosen = materialise(tied.join(of_root, "root").select("root", "doc_id", "len", "th", "tied"))
    root, nth = spare(documents, "root"), spare(documents, "nth")
    same = (
        F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
        & F.length("a.text").eqNullSafe(F.col("b.len"))
        & (F.xxhash64("a.text") == F.col("b.th"))
    )

    def rows(which: str) -> DataFrame:
        return documents.alias("a").join(chosen.where(which).alias("b"), same).select("a.*", F.col("b.root").alias(root))

    # most classes have one such row, which is not shuffled again; both joins share the shuffle of the documents
    first = F.row_number().over(Window.partitionBy(root).orderBy("text"))
    several = rows("tied > 1").withColumn(nth, first).where(F.col(nth) == 1).drop(nth)
    return rows("tied = 1").unionAll(several).drop(root)
