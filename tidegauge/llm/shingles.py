"""Pairs of texts that share at least ``ALIKE`` of their five-word shingles.

1. A text becomes the set of hashes of its word shingles, and ``BANDS`` keys of
   ``ROWS`` MinHash values each. A pair of similarity 0.8 shares no key with a
   probability of (1 - 0.8^4)^20, three in a hundred thousand; such a pair is missed.
2. Texts that share a key are a group. Groups of the same texts count once, and only
   the texts of groups are read again.
3. Inside a group the shingle sets are compared exactly; texts that links join already
   are not compared again, so that a group of near copies takes about one comparison a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import settle

WIDTH = 5
ALIKE = 0.8
BANDS = 20
ROWS = 4
CACHED_WORDS = 300_000
AT_ONCE = 8192

_random = np.random.default_rng(11)
TIMES = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
PLACES = _random.integers(0, 1 << 63, WIDTH, np.uint64) * np.uint64(2) + np.uint64(1)


class Words(dict):
    """Hash of a word; remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def mixed(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ (codes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    codes = (codes ^ (codes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return codes ^ (codes >> np.uint64(32))


def shingles(text: str | None, known: Words) -> np.ndarray:
    """Different hashes of a text's shingles, sorted; a text shorter than a shingle is one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(WIDTH, len(codes))
    n = len(codes) - width + 1
    joined = np.full(n, width, np.uint64)
    for i in range(width):
        joined += mixed(codes[i : i + n]) * PLACES[i]
    return np.unique(mixed(joined))


def keys(codes: np.ndarray) -> np.ndarray:
    """The band keys of a shingle set; an empty set has none."""
    if not len(codes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(codes), AT_ONCE):
        np.minimum(least, (codes[at : at + AT_ONCE, None] * TIMES + PLUS).min(axis=0), out=least)
    bands, key = least.reshape(BANDS, ROWS), np.arange(BANDS, dtype=np.uint64)
    for row in range(ROWS):
        key = mixed(key + bands[:, row])
    return key.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common)


def _links_of(members: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """Links between the codes of one group that span what is alike; equal codes are linked already."""
    root = list(range(len(members)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict[int, int] = {}
    for i, (code, own) in enumerate(members):
        root[i] = first.setdefault(code, i)
        for j in range(i):
            other = members[j][1]
            if top(i) == top(j) or min(len(own), len(other)) < ALIKE * max(len(own), len(other)):
                continue
            if similarity(own, other) >= ALIKE:
                yield code, members[j][0]
                root[top(i)] = top(j)


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of the groups of one partition, sorted by key; a group may span batches."""
    settle()
    known, key, members = Words(), None, []

    def found() -> pd.DataFrame:
        return pd.DataFrame(list(_links_of(members)), columns=["a", "b"]).astype("int64")

    for rows in batches:
        for at, code, text in zip(rows["key"], rows["fp"], rows["text"]):
            if at != key:
                yield found()
                key, members = at, []
            members.append((code, shingles(text, known)))
    yield found()


def links(documents: DataFrame, marked: DataFrame) -> DataFrame:
    """Links (a, b) between fingerprints ``fp`` of texts that are alike.

    ``marked`` holds, for each text by its hash ``th``, the fingerprint and its ``bands``.
    """
    texts = marked.where(F.size("bands") > 0).groupBy("fp", "th").agg(F.first("bands").alias("bands"))
    # shuffled once, for counting and for the members of groups
    keyed = texts.select("fp", "th", F.explode("bands").alias("key")).repartition("key")
    groups = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("fp", "th")).alias("who"), F.min("fp").alias("low"), F.max("fp").alias("high")
    )
    once = groups.where("low <> high").groupBy("n", "who", "low", "high").agg(F.min("key").alias("key")).select("key")
    members = keyed.join(once, "key")
    wanted = members.select("th").distinct()
    read = documents.select(F.xxhash64("text").alias("th"), "text").join(wanted, "th").groupBy("th").agg(F.first("text").alias("text"))
    grouped = members.join(read, "th").select("key", "fp", "text").repartition("key").sortWithinPartitions("key")
    return grouped.mapInPandas(_compared, "a long, b long").distinct()
