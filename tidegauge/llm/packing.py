"""Packing of tokenised documents into sequences by non-negative least squares.

Documents are tokenised once, on the executors, and cut into full windows and one
remainder. All that the plan needs is how many remainders of each length there are:
a histogram with fewer bins than the window has tokens, whatever the corpus size.

On that histogram the driver enumerates shallow combinations of two and three
lengths that fill a window, solves how often to use each by non-negative least
squares, rounds down to what the histogram holds, and packs what remains greedily,
largest first. The plan is a list of patterns with repeat counts. Pieces of one
length are numbered without gaps, in parts of bounded size, and the k-th of them
takes the k-th place that the plan has for its length.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import give_back, materialise, number_within, settle
from tidegauge.session import metadata_table

WINDOW = 2048
END_ID = 1
FREQUENT = 96  # lengths that triples are built from: two of these and the one that fills up
SWEEPS = 60
CACHED_WORDS, CACHED_PARTS = 400_000, 200_000  # in each of two generations that a worker process remembers

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


# Fixed values of the vocabulary: its pre-tokenizer's pattern, here for lower-case
# ASCII and Latin-1 only, and the words that consist of such characters.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds(dict):
    """Ids of a word between ASCII blanks, as little-endian bytes.

    The tokenizer splits at blanks and drops them, so a text's ids are those of its
    words in turn; each different word is tokenised once. Most words consist of
    ASCII and Latin-1 letters, digits and marks: those are lowered and split here, and
    the vocabulary's merges are asked for each different part. All others, and words
    that could spell a special token, go through the whole tokenizer, which gives a
    special token in a text its own id.

    What has been asked for is remembered in two generations of bounded size: when the
    younger one is full it becomes the older one, and words in use move over again.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.merges, self.letters = self.tokenizer.model, byte_letters()
        self.older, self.parts, self.older_parts = {}, {}, {}

    def part(self, part: str) -> bytes:
        found = self.older_parts.get(part)
        if found is None:
            spelled = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
            found = array("I", [t.id for t in self.merges.tokenize(spelled)]).tobytes()
        if len(self.parts) >= CACHED_PARTS:
            self.parts, self.older_parts = {}, self.parts
        self.parts[part] = found
        return found

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            text, known = word.decode("utf-8", "replace"), self.parts
            if LETTERS.fullmatch(text):
                text = text.lower()
                found = known.get(text) or self.part(text)
            elif SIMPLE.fullmatch(text) and "<|" not in text:
                found = b"".join([known.get(p) or self.part(p) for p in PARTS.findall(text.lower())])
            else:
                found = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


def word_ids(vocabulary: str) -> WordIds:
    """The ids of words, kept by the worker process for the tasks that follow on it until one of another kind settles there."""
    kept = settle("words")
    if vocabulary not in kept:
        kept[vocabulary] = WordIds(vocabulary)
    return kept[vocabulary]


def pieces(documents: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """Cut every document into pieces of at most ``window`` ids; NULL texts are empty."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = b"".join(map(words.__getitem__, (text.as_py() or "").encode().split())) + end
                for at in range(0, len(ids), 4 * window):
                    part = ids[at : at + 4 * window]
                    rows.append((doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=schema)
            give_back()

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def fillings(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[int, ...]]:
    """Combinations of two or three occurring lengths that fill the window exactly."""
    there = np.flatnonzero(histogram)
    out = [(a, window - a) for a in there.tolist() if 2 * a <= window and window - a < len(histogram) and histogram[window - a]]
    often = sorted(there[np.argsort(-histogram[there], kind="stable")][:FREQUENT].tolist())
    seen = set()
    for i, a in enumerate(often):
        for b in often[i:]:
            c = window - a - b
            if 0 < c < len(histogram) and histogram[c] and (combo := tuple(sorted((a, b, c)))) not in seen:
                seen.add(combo)
                out.append(combo)
    return out


def repeat_counts(combos: list[tuple[int, ...]], histogram: np.ndarray) -> np.ndarray:
    """Non-negative least squares by coordinate descent: how often to use each combination."""
    left = histogram.astype(float)
    columns = [np.unique(c, return_counts=True) for c in combos]
    norms = [float((m * m).sum()) for _, m in columns]
    counts = np.zeros(len(combos))
    for _ in range(SWEEPS):
        most = 0.0
        for j, (lengths, times) in enumerate(columns):
            new = max(0.0, counts[j] + float(left[lengths] @ times) / norms[j])
            change = new - counts[j]
            if change:
                left[lengths] -= change * times
                counts[j] = new
                most = max(most, abs(change))
        if most < 0.25:
            break
    return counts


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with repeat counts that use up the histogram."""
    left = histogram.astype(np.int64).copy()
    out = []
    combos = fillings(histogram, window)
    solved = repeat_counts(combos, histogram)
    for j in np.argsort(-solved, kind="stable"):
        lengths, times = np.unique(combos[j], return_counts=True)
        use = int(min(np.floor(solved[j] + 1e-9), (left[lengths] // times).min()))
        if use > 0:
            left[lengths] -= use * times
            out.append((combos[j], use))
    while left.any():
        free, room, pattern = left.copy(), window, []
        while True:
            fitting = np.flatnonzero(free[: room + 1])
            if not len(fitting):
                break
            length = int(fitting[-1])
            pattern.append(length)
            free[length] -= 1
            room -= length
        lengths, times = np.unique(pattern, return_counts=True)
        use = int((left[lengths] // times).min())
        left[lengths] -= use * times
        out.append((tuple(pattern), use))
    return out


def places(patterns: Iterable[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first number, first sequence, offset, used tokens), sorted by length and number."""
    rows, taken, sequence = [], {}, 0
    for pattern, use in patterns:
        offset = 0
        for length in pattern:
            at = taken.get(length, 0)
            rows.append((length, at, sequence, offset, sum(pattern)))
            taken[length] = at + use
            offset += length
        sequence += use
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(documents: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """Every piece with its place: sequence_id, offset and the sequence's number of ids.

    Empty and NULL texts are the end id alone; repeated rows are packed as often as
    they come; a NULL doc_id stays NULL; an empty table gives an empty result.
    Columns besides doc_id and text are not read.
    """
    cut = materialise(pieces(documents, vocabulary, window))
    histogram = np.zeros(window + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():  # at most one row per length
        histogram[length] = n
    full = int(histogram[window])
    remainders = histogram.copy()
    remainders[window] = 0
    table = places([*plan(remainders, window), *([((window,), full)] if full else [])])
    sizes = metadata_table(cut.sparkSession, [(i, int(n)) for i, n in enumerate(histogram) if n], "length bigint, n bigint")
    # a length with n pieces is numbered in about sqrt(n) parts
    parts = F.greatest(F.lit(1), F.floor(F.sqrt("n")))
    dealt = cut.join(F.broadcast(sizes), "length")  # at most `window` rows
    bucket = F.pmod(F.xxhash64("doc_id", "start"), parts)
    numbered = number_within(dealt, ["length"], [F.col("doc_id"), F.col("start"), F.col("ids_crc32")], bucket, "number").drop("n")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        span = int(table[:, 1].max(initial=0)) + 1
        starts = table[:, 0] * span + table[:, 1]
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            at = np.searchsorted(starts, length * span + np.minimum(number, span - 1), side="right") - 1
            placed = (table[at, 2] + number - table[at, 1], table[at, 3], table[at, 4])
            kept = [batch.column(c) for c in columns]
            yield pa.record_batch([*kept, *map(pa.array, placed)], names=[*columns, "sequence_id", "offset", "sequence_tokens"])

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    out = PIECES + ", sequence_id long, offset long, sequence_tokens long"
    return numbered.select(*columns, "number").mapInArrow(place, out)
