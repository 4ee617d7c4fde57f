"""Document fingerprints from prefix polynomial hashes.

The hashes of all prefixes of a text, modulo two primes, are two arrays. From them
the hash of any span follows in constant time, so equal spans are found without
looking at the text, and the longest common extension of two places by binary search.

A fingerprint keeps of that: the length and the hash of the whole, the hashes of
prefixes on a ladder of at most ``RUNGS`` rungs, and the ``SKETCH`` smallest mixed
hashes of all spans of ``SPAN`` code points. The likeness of two fingerprints is the
larger of the share of the longer text that their common prefix covers, found by
binary search on the ladder, and the estimated overlap of their spans.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIME = np.uint64((1 << 31) - 1)
BASES = (1_000_003, 69_621_337)
SPAN = 32
SKETCH = 32
RUNGS = 16
ROWS_PER_BUCKET = 500
MOST_BUCKETS = 65_536
LOWEST = -(1 << 63)


class Powers:
    """Powers of a base and of its inverse, grown as longer texts come."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, int(PRIME))
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        while len(self.up) <= n:
            k = len(self.up)
            for name, base in (("up", self.base), ("down", self.inverse)):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, old * np.uint64(pow(base, k, int(PRIME))) % PRIME]))


class PrefixHashes:
    """Hashes of all prefixes of a sequence of code points; ``head`` of another may be taken over."""

    def __init__(self, codes: np.ndarray, powers: list[Powers], head: "PrefixHashes | None" = None, shared: int = 0):
        self.codes, self.powers = codes, powers
        self.sums = []
        for i, p in enumerate(powers):
            p.grow(len(codes))
            terms = (codes[shared:].astype(np.uint64) + np.uint64(1)) * p.up[shared : len(codes)] % PRIME
            start = head.sums[i][: shared + 1] if head is not None else np.zeros(1, np.uint64)
            self.sums.append(np.concatenate([start, (start[-1] + np.cumsum(terms)) % PRIME]))

    def __len__(self) -> int:
        return len(self.codes)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the spans [start, end), the same for equal spans wherever they stand."""
        halves = [(s[ends] + PRIME - s[starts]) % PRIME * p.down[starts] % PRIME for s, p in zip(self.sums, self.powers)]
        return (halves[0] << np.uint64(31)) | halves[1]

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])


def longest_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """Length of the longest common run of ``a`` from ``i`` and ``b`` from ``j``."""
    low, high = 0, min(len(a) - i, len(b) - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spread hashes over 64 bits, so that the smallest are an even choice."""
    h = hashes * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


def smallest(values: np.ndarray, k: int) -> np.ndarray:
    """The k smallest different values."""
    if len(values) > 8 * k:
        few = np.unique(np.partition(values, 4 * k)[: 4 * k])
        if len(few) >= k:
            return few[:k]
    return np.unique(values)[:k]


def step_of(n: int) -> int:
    """Distance of the rungs for n code points: a power of two, so that ladders share rungs."""
    return 1 << max(0, (max(n, 1) - 1).bit_length() - (RUNGS.bit_length() - 1))


def fingerprint(text: PrefixHashes) -> str:
    """Hexadecimal: length, whole, rungs of the ladder, sketch; parted by colons."""
    n = len(text)
    rungs = np.arange(step_of(n), n + 1, step_of(n))
    ladder = mixed(text.spans(np.zeros(len(rungs), np.int64), rungs)) >> np.uint64(32)
    starts = np.arange(n - SPAN + 1) if n >= SPAN else np.arange(min(n, 1))
    sketch = smallest(mixed(text.spans(starts, np.minimum(starts + SPAN, n))) >> np.uint64(32), SKETCH)
    parts = ["".join(f"{v:08x}" for v in values.tolist()) for values in (ladder, sketch)]
    return f"{n:x}:{text.span(0, n):016x}:{parts[0]}:{parts[1]}"


def likeness(a: str, b: str) -> float:
    """From 0 to 1; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    (na, _, la, sa), (nb, _, lb, sb) = a.split(":"), b.split(":")
    na, nb = int(na, 16), int(nb, 16)
    if not na or not nb:
        return 0.0
    step = max(step_of(na), step_of(nb))

    def rungs(ladder: str, n: int) -> list[str]:
        skip = step // step_of(n)
        return [ladder[i : i + 8] for i in range(0, len(ladder), 8)][skip - 1 :: skip]

    ra, rb = rungs(la, na), rungs(lb, nb)
    both = min(len(ra), len(rb))
    common = bisect_left(range(both), True, key=lambda i: ra[i] != rb[i])
    sketches = [{s[i : i + 8] for i in range(0, len(s), 8)} for s in (sa, sb)]
    union = sorted(sketches[0] | sketches[1])[:SKETCH]
    shared = sum(v in sketches[0] and v in sketches[1] for v in union)
    return max(common * step / max(na, nb), shared / len(union))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the next one of its bucket; rows come sorted, a bucket ends with a guest."""
    powers = [Powers(b) for b in BASES]
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    before, rows = None, []

    def out() -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        batch = pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        rows.clear()
        return batch

    for batch in batches:
        for i in range(batch.num_rows):
            doc_id, bucket, guest = (batch.column(c)[i].as_py() for c in ("doc_id", "bucket", "guest"))
            if before is None and guest:
                continue
            codes = code_points(batch.column("text")[i].as_py() or "")
            hashes = PrefixHashes(codes, powers)
            print_ = fingerprint(hashes)
            if before is not None and before[0] == bucket:
                _, own_id, own, own_print = before
                n = len(own)
                cut = n // 4
                edited = np.concatenate([own.codes[: n - cut], codes[:cut]])
                changed = fingerprint(PrefixHashes(edited, powers, own, n - cut))
                digest = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((own_id, n, digest, own_print, changed, likeness(own_print, changed), likeness(own_print, print_)))
            before = None if guest else (bucket, doc_id, hashes, print_)
            if len(rows) >= 1000:
                yield out()
    yield out()


def compare_with_next(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness; see ``COLUMNS``.

    The last quarter of a text is replaced by the start of the next document's, in
    ascending order of ``doc_id``, the first following the last. Documents are cut into
    ranges of ids and each range is sorted by itself; the first document of a range
    visits the range before it as a guest, so texts are shuffled once.

    NULL texts are empty; a NULL id comes before all others; repeated ids stand in the
    order of their texts; a lone document follows itself; an empty table gives an empty
    result. Columns besides doc_id and text are not read.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    ids = documents.select(key.alias("key"))
    n = ids.count()
    buckets = min(MOST_BUCKETS, 1 + n // ROWS_PER_BUCKET)
    # the cut points only balance the ranges; any would give the same result
    cuts = np.unique(np.array(ids.approxQuantile("key", [i / buckets for i in range(1, buckets)], 0.1 / buckets) if buckets > 1 else [], np.int64))

    @F.pandas_udf("int")
    def bucket_of(keys):
        import pandas as pd

        return pd.Series(np.searchsorted(cuts, keys.to_numpy(np.int64), side="right").astype(np.int32))

    heads = ids.groupBy(bucket_of("key").alias("bucket")).agg(F.min("key").alias("head")).orderBy("bucket").collect()  # one row per range
    firsts = np.array([r["head"] for r in heads], np.int64)
    hosts = np.array([heads[i - 1]["bucket"] for i in range(len(heads))], np.int32)

    @F.pandas_udf("array<struct<bucket:int,guest:boolean>>")
    def stays(keys):
        import pandas as pd

        values = keys.to_numpy(np.int64)
        own = np.searchsorted(cuts, values, side="right").tolist()
        at = np.minimum(np.searchsorted(firsts, values), len(firsts) - 1)
        host = np.where(firsts[at] == values, hosts[at], -1).tolist()
        return pd.Series([[(b, False)] if h < 0 else [(b, False), (h, True)] for b, h in zip(own, host)])

    dealt = documents.select("doc_id", key.alias("key"), "text").withColumn("stay", F.explode(stays("key")))
    ordered = (
        dealt.select(F.col("doc_id").cast("long"), "key", "stay.bucket", "stay.guest", "text")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "guest", "key", "text")
    )
    return ordered.select("doc_id", "bucket", "guest", "text").mapInArrow(_compare, COLUMNS)
