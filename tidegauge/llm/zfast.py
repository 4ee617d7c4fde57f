"""Conversation prefix trie, built from z-fast tries.

A conversation is a sequence of turns, a turn is known by a digest of its role and text,
and each prefix by a digest chained over its turns: 16 bytes, whatever the length of
the texts. Conversations are dealt by ranges of their first turns' digests, so that
those with a common prefix meet, however many there are.

In a task the conversations of a range go into a z-fast trie: a compacted trie whose
nodes are found by a hash of their handle, the prefix whose length is the number in
the node's span that most powers of two divide. A conversation's exit node is located
by fat binary search: about log2(turns) look-ups, not one for each turn. Conversations
come in batches, equal ones together. At the end edges are expanded: every prefix on
them becomes a row.

A node below which all conversations lie in one range is complete there. Only prefixes
that a range shares with a neighbour, those on the way to its first or its last
conversation, are partial: their counts are added up over ranges, and what lies below
them is summed along their own small tree by pointer doubling. The root is one of them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import as_text, materialise

TURNS_PER_RANGE = 200_000
FIRST_TURNS = 16  # digests that ranges are cut by
IDS_PER_BLOCK = 512  # conversations whose ids travel together to one digest
DIGEST = 16
ROOT = b"\0" * DIGEST
PERIOD, HEADS = 100, 6  # of the rebuilt conversations

NODES = (
    "key binary, parent binary, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, chars long, ends_sha256 string, first_end long, ends string"
)

# ------------------------------------------------------------------- the trie


def two_fattest(above: int, upto: int) -> int:
    """The number in (above, upto] that the highest power of two divides."""
    return upto & -(1 << ((above ^ upto).bit_length() - 1))


class Node:
    """An edge and the node at its end; ``keys`` and ``chars`` are those of some conversation through it."""

    __slots__ = ("top", "extent", "keys", "chars", "below", "ends", "parent")

    def __init__(self, top: int, extent: int, keys: list[bytes], chars: list[int], parent: Node | None):
        self.top, self.extent, self.keys, self.chars, self.parent = top, extent, keys, chars, parent
        self.below: dict[bytes, Node] = {}  # by the key of the first prefix on the edge
        self.ends: list[int] = []

    @property
    def handle(self) -> bytes:
        return self.keys[two_fattest(self.top, self.extent)]


class ZFastTrie:
    """A compacted trie over chains of prefix keys (key 0 is the root's), with a table of handles."""

    def __init__(self):
        self.root = Node(-1, 0, [ROOT], [0], None)
        self.handles: dict[bytes, Node] = {}
        self.look_ups = 0

    def locate(self, keys: list[bytes]) -> tuple[Node, int]:
        """The exit node of a conversation, and how many of its turns the trie holds.

        The conversation leaves the trie at that depth, on the node's edge or at its end.
        """
        node, low, high = self.root, 0, len(keys) - 1
        while low < high:
            length = two_fattest(low, high)
            self.look_ups += 1
            found = self.handles.get(keys[length])
            if found is None:
                high = length - 1
            elif found.extent < len(keys) and found.keys[found.extent] == keys[found.extent]:
                node, low = found, found.extent
            else:  # it leaves on this very edge, at or behind the handle
                return found, self._common(found, keys, length)
        if node.extent + 1 < len(keys) and (child := node.below.get(keys[node.extent + 1])) is not None:
            return child, self._common(child, keys, node.extent + 1)
        return node, node.extent

    @staticmethod
    def _common(node: Node, keys: list[bytes], known: int) -> int:
        """Turns shared with a node's edge, at least ``known``: equal keys are equal prefixes."""
        low, high = known, min(node.extent, len(keys) - 1)
        while low < high:
            middle = (low + high + 1) // 2
            if node.keys[middle] == keys[middle]:
                low = middle
            else:
                high = middle - 1
        return low

    def insert(self, keys: list[bytes], chars: list[int], ids: list[int]) -> None:
        node, depth = self.locate(keys)
        if depth < node.extent:  # within an edge: its upper part becomes a node
            upper = Node(node.top, depth, node.keys, node.chars, node.parent)
            del self.handles[node.handle]
            node.parent.below[node.keys[node.top + 1]] = upper
            upper.below[node.keys[depth + 1]] = node
            node.top, node.parent = depth, upper
            self.handles[node.handle] = node
            self.handles[upper.handle] = upper
            node = upper
        if depth < len(keys) - 1:
            leaf = Node(depth, len(keys) - 1, keys, chars, node)
            node.below[keys[depth + 1]] = leaf
            self.handles[leaf.handle] = leaf
            node = leaf
        node.ends += ids

    def insert_batch(self, conversations: list[tuple[int, list[bytes], list[int]]]) -> None:
        """Conversations (id, digests of turns, characters of turns); equal ones are looked up once."""
        alike: dict[bytes, tuple[list[bytes], list[int], list[int]]] = {}
        for conv_id, digests, chars in conversations:
            key, keys = ROOT, [ROOT]
            for digest in digests:
                key = hashlib.blake2b(digest, key=key, digest_size=DIGEST).digest()
                keys.append(key)
            alike.setdefault(key, (keys, [0, *chars], []))[2].append(conv_id)
        for keys, chars, ids in alike.values():
            self.insert(keys, chars, ids)

    def nodes(self) -> list[Node]:
        """All nodes, each before those below it."""
        out = [self.root]
        for node in out:
            out.extend(node.below.values())
        return out


def expanded(trie: ZFastTrie, borders: tuple[list[bytes], ...]) -> Iterator[tuple]:
    """A row (see ``NODES``) for every prefix; those of a border may be shared with other ranges.

    A partial row has the range's own part: its conversations, its complete children, and
    the leaves and savings below those. Ids that end at it come in blocks, as further rows.
    """
    shared = [{b[d] for b in borders if len(b) > d} for d in range(FIRST_TURNS + 1)]

    def partial(node: Node, depth: int) -> bool:
        return node.keys[min(depth, FIRST_TURNS)] in shared[min(depth, FIRST_TURNS)]

    nodes, least, members, passed, rows = trie.nodes(), {}, {}, {}, {}
    for node in reversed(nodes):
        below = node.below.values()
        members[node] = n = len(node.ends) + sum(members[c] for c in below)
        least[node] = min([*node.ends, *(least[c] for c in below)], default=None)
        kids, leaves, saved = map(sum, zip((0, 0, 0), *(passed[c] for c in below)))
        rows[node] = found = []
        for depth in range(node.extent, node.top, -1):
            part = partial(node, depth)
            if not part:
                leaves = leaves if below or depth < node.extent else 1
                saved += (n - 1) * node.chars[depth]
            found.append((depth, kids, leaves, saved, part))
            # a prefix further up counts what is complete; partial ones are summed over ranges
            kids, leaves, saved = (0, 0, 0) if part else (1, leaves, saved)
        passed[node] = kids, leaves, saved
    none = hashlib.sha256().hexdigest()
    for node in nodes:
        ids = sorted(node.ends)
        for depth, kids, leaves, saved, part in rows[node]:
            key, parent = node.keys[depth], node.keys[depth - 1] if depth else None
            counts = (members[node], kids, leaves, saved, node.chars[depth])
            ends = ids if depth == node.extent else []
            if part:
                yield key, parent, depth, least[node], None, *counts, None, None, None
                for at in range(0, len(ends), IDS_PER_BLOCK):
                    block = ends[at : at + IDS_PER_BLOCK]
                    yield key, None, depth, None, None, 0, 0, 0, 0, 0, None, block[0], ",".join(map(str, block))
                continue
            sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else none
            above = node if depth > node.top + 1 else node.parent
            if partial(above, depth - 1):  # its parent's smallest id is known when ranges are joined
                yield key, parent, depth, least[node], None, *counts, sha, None, None
            else:
                yield key, None, depth, least[node], least[above], *counts, sha, None, None


# ------------------------------------------------------------------ the tables


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, digests, chars): each conversation's turns in order, without their texts."""
    role, text = as_text(F.col("role").cast("string")), as_text(F.col("text").cast("string"))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(said, 256)), 1, DIGEST)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return grouped.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every conversation with the head of the one that begins its hundred, as ``turns_of``."""
    own = turns_of(conversations)
    begins = F.col("conv_id") - F.col("conv_id") % PERIOD
    heads = turns_of(conversations.where(F.col("conv_id") % PERIOD == 0)).select(
        F.col("conv_id").alias("begins"), *[F.slice(c, 1, HEADS - 1).alias(f"head_{c}") for c in ("digests", "chars")]
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")

    def joined(c: str) -> Column:
        head = F.coalesce(F.slice(f"head_{c}", F.lit(1), h), F.slice(c, 1, 0))
        return F.concat(head, F.slice(c, h + 1, F.size(c))).alias(c)

    return own.withColumn("begins", begins).join(heads, "begins", "left").select("conv_id", joined("digests"), joined("chars"))


def ranges(sequences: DataFrame, n: int) -> DataFrame:
    """Node rows of all ranges, see ``NODES``."""
    names = [c.split()[0] for c in NODES.split(", ")]
    kinds = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    types = [kinds[c.split()[1]] for c in NODES.split(", ")]

    def chain(digests: tuple[bytes, ...]) -> list[bytes]:
        only = ZFastTrie()
        only.insert_batch([(0, list(digests), [0] * len(digests))])
        return (next(iter(only.root.below.values())) if digests else only.root).keys

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, first, last = ZFastTrie(), None, None
        for batch in batches:
            read = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "digests", "chars")))
            conversations = list(read)
            trie.insert_batch(conversations)
            begins = [tuple(d[:FIRST_TURNS]) for _, d, _ in conversations]
            first = min(begins if first is None else [first, *begins])
            last = max(begins if last is None else [last, *begins])
        rows = []
        if first is not None:
            for row in expanded(trie, (chain(first), chain(last))):
                rows.append(row)
                if len(rows) == 10_000:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows = []
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    ranged = sequences.select("conv_id", "digests", "chars").repartitionByRange(n, F.slice("digests", 1, FIRST_TURNS), "conv_id")
    return ranged.mapInArrow(build, NODES)


def digests_of_blocks(blocks: DataFrame) -> DataFrame:
    """(key, sha): one digest over the blocks of each key in order, streamed, never joined in memory."""

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if k != key:
                    if key is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pa.record_batch([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["key", "sha"])
        if key is not None:
            yield pa.record_batch([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["key", "sha"])

    return blocks.repartition("key").sortWithinPartitions("key", "first_end").mapInArrow(streamed, "key binary, sha string")


def shared_prefixes(nodes: DataFrame) -> DataFrame:
    """Prefixes that ranges share, with their ranges' parts added up and what lies below them summed.

    Their number is that of ranges times the turns on two ways down. Sums run along the
    way up: in each round a prefix adds its sum to the one 1, 2, 4, ... turns above.
    """
    total = {c: F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    alone = (
        nodes.where("ends_sha256 IS NULL AND ends IS NULL")
        .groupBy("key")
        .agg(*[F.min(c).alias(c) for c in ("parent", "depth", "conv_id", "chars")], *total.values())
    )
    alone = materialise(alone)
    more = alone.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    children = F.col("n_children") + F.coalesce("more", F.lit(0))
    own = alone.join(more, "key", "left").select(
        "key", "parent", "depth", "conv_id", "n_convs", children.alias("n_children"),
        (F.col("n_leaves") + F.when(children == 0, 1).otherwise(0)).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    own = materialise(own)
    sums = own.select("key", F.col("parent").alias("up"), "n_leaves", "saved_tokens")
    for _ in range((own.agg(F.max("depth")).first()[0] or 0).bit_length()):
        gained = sums.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        above = sums.select(F.col("key").alias("up"), F.col("up").alias("next"))
        sums = materialise(
            sums.join(gained, "key", "left").join(above, "up", "left").select(
                "key", F.col("next").alias("up"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens"),
            )
        )
    return own.drop("n_leaves", "saved_tokens").join(sums.drop("up"), "key")


def trie(sequences: DataFrame, turns_per_range: int = TURNS_PER_RANGE) -> DataFrame:
    """The prefix trie of sequences (conv_id, digests, chars): one row for each distinct prefix.

    A task holds the digests of one range's turns. The turns of one conversation, at most
    some sixty bytes each, are never split. Conversations must have ids of their own.
    """
    turns = sequences.agg(F.sum(F.size("digests") + 1)).first()[0] or 0
    spread = min(sequences.sparkSession.sparkContext.defaultParallelism, -(-turns // 10_000))
    nodes = materialise(ranges(sequences, max(1, spread, -(-turns // turns_per_range))))
    shared = materialise(shared_prefixes(nodes))
    counts = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    known = nodes.where("ends_sha256 IS NOT NULL AND parent IS NULL").select("conv_id", "depth", "parent_conv_id", *counts, "ends_sha256")
    above = shared.select(F.col("key").alias("parent"), F.col("conv_id").alias("of"))
    hung = nodes.where("ends_sha256 IS NOT NULL AND parent IS NOT NULL").join(above, "parent")
    ends = digests_of_blocks(nodes.where("ends IS NOT NULL").select("key", "first_end", "ends"))
    sha = F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    partial = shared.join(above, "parent", "left").join(ends, "key", "left")
    return known.unionByName(hung.select("conv_id", "depth", F.col("of").alias("parent_conv_id"), *counts, "ends_sha256")).unionByName(
        partial.select("conv_id", "depth", F.col("of").alias("parent_conv_id"), *counts, sha)
    )


def prefixes(conversations: DataFrame) -> DataFrame:
    """The prefix trie of all conversations, rebuilt with shared heads.

    Turns are ordered by turn, NULL first, equal ones by their digest; NULL roles and texts
    are empty; repeated rows are turns of their own; rows without conv_id belong to no
    conversation and count nowhere; an empty table gives an empty result, without a root.
    Columns besides conv_id, turn, role and text are not read.
    """
    return trie(materialise(rebuilt(conversations)))
