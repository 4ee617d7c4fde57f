"""Compression of vectors into codes of their parts, trained with norm-of-sum bounds.

Every vector is scaled to integers and cut into equal parts; each part position has a
codebook that k-means rounds refine. A round is one narrow pass over the vectors that
yields, for each position and entry, the sum and number of its parts; Spark adds those
up, and the driver holds codebooks only.

A part keeps its entry, the distance to it, the smallest distance to any other, and
for each of the two the round in which it was measured. All codebooks of earlier rounds
are kept, so that the true displacement of an entry since that round is known, however
often it went back and forth: the upper bound grows by it, the lower bound shrinks by
the largest one among the other entries. Only where the bounds meet is the distance to
the own entry measured, and only where they still meet all entries are scanned.
Distances are integers, bounds are widened by more than rounding could change, and
ties always lead to a scan, so codes are those of exhaustive search.

The state of a round derives from that of the round before by a narrow step, and all
of it from the table and the codebooks: what a lost executor held is made anew from its
input partitions. Two rounds at most are kept in executors' storage.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import materialise
from tidegauge.session import small_rows

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
SLACK = 1e-9  # relative; doubles err by less than 1e-15 in each of a few steps
BATCH = 8192  # vectors that are worked on together

STATE = "vec_id long, label {label}, parts binary, entry binary, upper binary, upper_round binary, lower binary, lower_round binary"


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def limit_of(width: int) -> int:
    """The largest component for which the squared error of a whole vector is still a long."""
    return int(math.sqrt((2**63 - 1) / max(1, width))) // 2 - 1


def scaled(vector: Column, width: int) -> Column:
    """Components as integers floor(SCALE * x), held at the limit, filled up with zeros to the width."""
    top = float(limit_of(width))
    whole = F.transform(vector, lambda x: F.greatest(F.lit(-top), F.least(F.lit(top), F.floor(x.cast("double") * SCALE).cast("double"))).cast("int"))
    return F.concat(whole, F.array_repeat(F.lit(0), F.lit(width) - F.size(vector)))


@dataclass(frozen=True)
class History:
    """Codebooks of all rounds so far, each of shape (parts, entries, length)."""

    books: tuple[np.ndarray, ...]

    @property
    def now(self) -> np.ndarray:
        return self.books[-1]

    def displacement(self) -> np.ndarray:
        """(round, part, entry): how far each entry is now from where it was in that round."""
        moved = np.stack(self.books) - self.now
        return np.sqrt((moved.astype(np.float64) ** 2).sum(-1)) * (1 + SLACK)


def squared(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows (n, length) to entries (k, length) as (n, k) longs."""
    out = np.empty((len(parts), len(entries)), np.int64)
    for k, entry in enumerate(entries):
        apart = parts - entry
        out[:, k] = np.einsum("ij,ij->i", apart, apart)
    return out


def scan(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry (the first of equally near ones), distance to it, and to the next one."""
    found = squared(parts, entries)
    best = found.argmin(1)
    rows = np.arange(len(parts))
    near = found[rows, best].copy()
    found[rows, best] = np.iinfo(np.int64).max
    other = np.sqrt(found.min(1).astype(np.float64)) if len(entries) > 1 else np.full(len(parts), np.inf)
    return best, near, other


class Assignment:
    """Entries and bounds of some vectors, position by position: arrays of shape (n, parts)."""

    def __init__(self, parts: np.ndarray, entry=None, upper=None, upper_round=None, lower=None, lower_round=None):
        self.parts = parts
        shape = parts.shape[:2]
        self.entry = np.zeros(shape, np.uint8) if entry is None else entry
        self.upper = np.full(shape, np.inf) if upper is None else upper
        self.upper_round = np.zeros(shape, np.uint8) if upper_round is None else upper_round
        self.lower = np.zeros(shape) if lower is None else lower
        self.lower_round = np.zeros(shape, np.uint8) if lower_round is None else lower_round
        self.scanned = 0

    def update(self, history: History) -> None:
        """Nearest entries in the newest codebook."""
        now, stamp = history.now, len(history.books) - 1
        displaced = history.displacement()
        for p in range(self.parts.shape[1]):
            entry = self.entry[:, p].astype(np.int64)
            upper = self.upper[:, p] + displaced[self.upper_round[:, p], p, entry]
            # the largest displacement among the entries that are not one's own
            order = np.argsort(displaced[:, p], axis=1)
            most = order[:, -1]
            next_most = order[:, -2] if order.shape[1] > 1 else order[:, -1]
            since = self.lower_round[:, p]
            other = np.where(most[since] == entry, next_most[since], most[since])
            lower = self.lower[:, p] - displaced[since, p, other]
            open_ = np.flatnonzero(~(upper * (1 + SLACK) < lower * (1 - SLACK)))
            if not len(open_):
                continue
            x = self.parts[open_, p]
            apart = x - now[p, entry[open_]]
            own = np.sqrt(np.einsum("ij,ij->i", apart, apart).astype(np.float64))
            self.upper[open_, p], self.upper_round[open_, p] = own, stamp
            again = ~(own * (1 + SLACK) < lower[open_] * (1 - SLACK))
            rest = open_[again]
            if len(rest):
                best, near, second = scan(self.parts[rest, p], now[p])
                self.entry[rest, p] = best
                self.upper[rest, p], self.upper_round[rest, p] = np.sqrt(near.astype(np.float64)), stamp
                self.lower[rest, p], self.lower_round[rest, p] = second, stamp
                self.scanned += len(rest)

    def sums(self, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """Per position and entry: number of parts and their componentwise sums."""
        n, positions, length = self.parts.shape
        counts, totals = np.zeros((positions, entries), np.int64), np.zeros((positions, entries, length), np.int64)
        for p in range(positions):
            counts[p] = np.bincount(self.entry[:, p], minlength=entries)
            order = np.argsort(self.entry[:, p], kind="stable")
            there = np.flatnonzero(counts[p])
            if len(there):
                starts = (np.cumsum(counts[p]) - counts[p])[there]
                totals[p, there] = np.add.reduceat(self.parts[order, p], starts, axis=0)
        return counts, totals

    def errors(self, book: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.parts), np.int64)
        for p in range(self.parts.shape[1]):
            apart = self.parts[:, p] - book[p, self.entry[:, p]]
            out += np.einsum("ij,ij->i", apart, apart)
        return out


def _loaded(batch: pa.RecordBatch, positions: int, length: int) -> Assignment:
    """The state of a batch from its binary columns."""

    def column(name: str, kind: str, *shape: int) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, *shape).copy()

    parts = column("parts", "<i4", positions, length).astype(np.int64)
    kinds = {"entry": "u1", "upper": "<f8", "upper_round": "u1", "lower": "<f8", "lower_round": "u1"}
    return Assignment(parts, **{name: column(name, kind, positions) for name, kind in kinds.items()})


def _saved(batch: pa.RecordBatch, state: Assignment) -> pa.RecordBatch:
    kinds = {"entry": "u1", "upper": "<f8", "upper_round": "u1", "lower": "<f8", "lower_round": "u1"}
    packed = []
    for name, kind in kinds.items():
        raw, n = getattr(state, name).astype(kind).tobytes(), state.entry.shape[1] * np.dtype(kind).itemsize
        packed.append(pa.array([raw[at : at + n] for at in range(0, n * batch.num_rows, n)], pa.binary()))
    kept = [batch.column(c) for c in ("vec_id", "label", "parts")]
    return pa.record_batch([*kept, *packed], names=["vec_id", "label", "parts", *kinds])


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield batch.slice(at, BATCH)


def begun(vectors: DataFrame, positions: int, length: int, label: str) -> DataFrame:
    """State before the first round: bounds that decide nothing. Scaled components arrive as ``parts``."""
    schema = STATE.format(label=label)

    def fresh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            flat = batch.column("parts").flatten().to_numpy(zero_copy_only=False).astype("<i4")
            raw, n = flat.tobytes(), 4 * positions * length
            rows = [raw[at : at + n] for at in range(0, n * batch.num_rows, n)] if n else [b""] * batch.num_rows
            held = pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(rows, pa.binary())], names=["vec_id", "label", "parts"])
            yield _saved(held, Assignment(flat.reshape(batch.num_rows, positions, length)))

    return vectors.mapInArrow(fresh, schema)


def advanced(state: DataFrame, history: History) -> DataFrame:
    """State after assigning every part in the newest codebook."""
    positions, _, length = history.now.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            held = _loaded(batch, positions, length)
            held.update(history)
            yield _saved(batch, held)

    return state.mapInArrow(step, state.schema)


def refined(state: DataFrame, history: History) -> np.ndarray:
    """The next codebooks: componentwise floor(sum / count), unused entries as they were.

    Each task adds its batches up before anything is shuffled: positions times entries rows.
    """
    positions, entries, length = history.now.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros((positions, entries), np.int64), np.zeros((positions, entries, length), np.int64)
        for batch in _sliced(batches):
            c, t = _loaded(batch, positions, length).sums(entries)
            counts += c
            totals += t
        p, e = np.nonzero(counts)
        columns = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]), pa.array(list(totals[p, e]), pa.list_(pa.int64()))]
        yield pa.record_batch(columns, names=["p", "e", "n", "s"])

    sums = state.mapInArrow(partial, "p int, e int, n long, s array<bigint>")
    total = sums.groupBy("p", "e").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(length)]).alias("s"))
    book = history.now.copy()
    for row in small_rows(total, positions * entries):
        book[row.p, row.e] = [s // row.n for s in row.s]
    return book


def digest(book: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position within the part."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vector: str = "embedding") -> tuple[DataFrame, History]:
    """Codes of all usable vectors, and the codebooks of all rounds.

    Rows are (vec_id, label, code, error): the code has two hex digits for each part, the
    error is the squared distance to the chosen entries. Vectors that are NULL or hold
    NULL, NaN or infinite components are dropped. Codebooks begin with the parts of the
    vectors of the smallest ids (NULL ids last; among equal ids by the components); fewer
    vectors than entries make fewer entries, none an empty result. All vectors count as
    long as the longest, filled up to a multiple of ``parts``: shorter ones get zeros.
    Components beyond ``limit_of`` are held there, so that errors are longs. Repeated rows
    count as often as they come; other columns are not read.
    """
    kept = vectors.where(usable(F.col(vector))).select("vec_id", "label", F.col(vector).alias("vector"))
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    length = -(-longest // parts)
    whole = kept.select(F.col("vec_id").cast("long"), "label", scaled(F.col("vector"), parts * length).alias("parts"))
    first = [r.parts for r in whole.orderBy(F.col("vec_id").asc_nulls_last(), "parts").limit(entries).collect()]  # `entries` rows
    label = whole.schema["label"].dataType.simpleString()
    book = np.array(first, np.int64).reshape(len(first), parts, length).transpose(1, 0, 2)
    history = History((np.ascontiguousarray(book),))
    state = begun(whole, parts, length, label)
    if not first:
        return state.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), history
    before = None
    for _ in range(rounds):
        state = advanced(state, history).persist(StorageLevel.MEMORY_AND_DISK)
        history = History((*history.books, refined(state, history)))
        if before is not None:
            before.unpersist()
        before = state

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            held = _loaded(batch, parts, length)
            held.update(history)
            raw, errors = held.entry.tobytes(), held.errors(history.now)
            codes = [raw[at : at + parts].hex() for at in range(0, len(raw), parts)]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors)]
            yield pa.record_batch(columns, names=["vec_id", "label", "code", "error"])

    codes = materialise(state.mapInArrow(coded, f"vec_id long, label {label}, code string, error long"))
    state.unpersist()
    return codes, history


def with_label_error(codes: DataFrame, history: History) -> DataFrame:
    """Codes with the error summed over equal labels (NULLs together) and the codebooks' digest."""
    total = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = codes.join(total, codes["label"].eqNullSafe(total["of"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(history.now)).alias("codebooks_sha256"))
