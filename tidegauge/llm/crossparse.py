"""Language identification by cross-parsing with suffix automata.

For every language a suffix automaton holds all substrings of a reference text. A
document is parsed greedily: from each place the longest match in the reference is
one phrase, and the next begins behind it. The language whose reference needs the
fewest phrases, normalised by the bits it takes to name a place in it, wins.

References are sampled from labelled documents, at most ``REFERENCE_CHARS`` letters a
language. Every letter of a reference keeps its identity; what is no letter is a space,
and spaces are joined. An automaton becomes a table of transitions in which a failing
step already leads on from the start and is marked as the end of a phrase, so that a
task walks thousands of stretches of text in step, one lookup per letter and language.
The most frequent letters have columns in the table; the steps of all others, few per
state, are found by binary search in a sorted list. Whole texts are parsed, in stretches of
``STRETCH`` letters, each of which may cut one phrase, the same for all languages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import settle

REFERENCE_CHARS = 24_000
SAMPLE_TIMES = 3  # sampled documents hold about so many times the letters needed
SYMBOLS = 64  # columns of a table: the space, frequent letters, letters that no reference has
SLICE = 2048  # letters that one of many documents gives to a reference
MARGIN, DEVIATIONS = 2.0, 6.0  # what a text of a language may take beyond its usual phrases
PIECE = 500  # letters of a text that the usual number of phrases is learned from
STRETCH = 1024
TOGETHER = 1 << 21  # letters that are parsed in step, which bounds a task's memory
UNKNOWN = "und"
POINTS = 0x110000


def letter_table() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is no letter."""
    return np.fromiter((ord(chr(i).lower()[0]) if chr(i).isalpha() else 0 for i in range(POINTS)), np.int32, POINTS)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.int32)


class Automaton:
    """Suffix automaton over small numbers, built letter by letter."""

    def __init__(self, symbols: list[int]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, last = [-1], [0], 0
        for c in symbols:
            last = self._extend(last, c)

    def _state(self, length: int, link: int, steps: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(steps)
        return len(self.next) - 1

    def _extend(self, last: int, c: int) -> int:
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and c not in self.next[at]:
            self.next[at][c] = new
            at = self.link[at]
        if at < 0:
            return new
        target = self.next[at][c]
        if self.length[at] + 1 < self.length[target]:
            copy = self._state(self.length[at] + 1, self.link[target], dict(self.next[target]))
            self.link[target] = copy
            while at >= 0 and self.next[at].get(c) == target:
                self.next[at][c] = copy
                at = self.link[at]
            target = copy
        self.link[new] = target
        return new

    def table(self) -> np.ndarray:
        """2 * next state for each (state, symbol), plus 1 where a phrase ends before the symbol.

        A symbol that the reference lacks is a phrase by itself.
        """
        alone = len(self.next)  # where a symbol leads that the reference lacks
        fresh = np.full(SYMBOLS, 2 * alone, np.int32)
        for c, to in self.next[0].items():
            if c < SYMBOLS:
                fresh[c] = 2 * to
        out = np.tile(fresh + 1, (alone + 1, 1))
        out[0] = fresh  # a walk begins here, where nothing ends
        for state, steps in enumerate(self.next):
            for c, to in steps.items():
                if c < SYMBOLS:
                    out[state, c] = 2 * to
        return out

    def rare(self) -> np.ndarray:
        """Rows (state, symbol, next state) for the symbols that the table has no column for."""
        rows = [(state, c, to) for state, steps in enumerate(self.next) for c, to in steps.items() if c >= SYMBOLS]
        return np.array(rows, np.int64).reshape(-1, 3)


@dataclass(frozen=True)
class References:
    languages: list[str]
    symbol: np.ndarray  # of each code point
    tables: np.ndarray  # all languages, one behind the other
    first: np.ndarray  # where each language starts
    bits: np.ndarray  # to name a place in each reference
    steps: list[tuple[np.ndarray, np.ndarray]]  # of rare letters, for each language: sorted state * letters + letter, 2 * next state
    starts: np.ndarray  # for each language and letter: 2 * state behind it from the start, or where it leads if the reference lacks it

    def _rare(self, lang: int, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """As a table lookup, for rare letters; ``state`` counts from the language's start."""
        known, to = self.steps[lang]
        fresh = self.starts[lang, c] + (state != 0)
        if not len(known):
            return fresh
        key = state * self.starts.shape[1] + c
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        return np.where(known[at] == key, to[at], fresh)

    def _symbols(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, one behind the other, with runs of others than letters as one, and whose they are."""
        sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
        points = code_points("".join(t for t in texts if t))
        symbols = self.symbol[points]
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        fresh = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
        kept = (symbols != 0) | np.r_[True, symbols[:-1] != 0] | fresh if len(owner) else fresh
        return symbols[kept], owner[kept]

    def parse(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases times bits for each text and language, and whether a text has a letter."""
        symbols, owner = self._symbols(texts)
        letters = np.bincount(owner[symbols > 0], minlength=len(texts)) > 0
        n = np.bincount(owner, minlength=len(texts))
        # stretches: (first letter, length), longest first, so that those still going stand in front
        pieces = -(-n // STRETCH)
        whose = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(whose)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = (np.cumsum(n) - n)[whose] + nth * STRETCH
        length = np.minimum(STRETCH, n[whose] - nth * STRETCH)
        order = np.argsort(-length, kind="stable")
        whose, start, length = whose[order], start[order], length[order]
        phrases = np.zeros((len(self.languages), len(whose)), np.int32)
        state = np.repeat(self.first[:, None], len(whose), axis=1)
        going = np.searchsorted(-length, -np.arange(1, STRETCH + 1), side="right")
        table = self.tables.reshape(-1)
        any_rare = bool((symbols >= SYMBOLS).any())
        for step in range(int(length.max(initial=0))):
            m = going[step]
            c = symbols[start[:m] + step]
            rare = np.flatnonzero(c >= SYMBOLS) if any_rare else c[:0]
            column = np.minimum(c, SYMBOLS - 1) if len(rare) else c
            for lang in range(len(self.languages)):
                found = table[state[lang, :m] * SYMBOLS + column]
                if len(rare):
                    found[rare] = self._rare(lang, state[lang, rare] - self.first[lang], c[rare])
                phrases[lang, :m] += found & 1
                state[lang, :m] = (found >> 1) + self.first[lang]
        cost = np.stack([np.bincount(whose, p + 1, len(texts)) for p in phrases], axis=1) if len(self.languages) else np.zeros((len(texts), 0))
        return cost * self.bits, letters

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text, parsed in groups of about ``TOGETHER`` letters."""
        out, group, held = [], [], 0
        for text in texts:
            group.append(text)
            held += len(text) if text else 0
            if held >= TOGETHER:
                out += self._predict(group)
                group, held = [], 0
        return out + self._predict(group) if group else out

    def known(self, texts: list[str | None], bounds: Bounds) -> list[bool]:
        """Whether each text is within the bound of the language that wins."""
        cost, letters = self.parse(texts)
        if not self.languages:
            return [False] * len(texts)
        best = cost.argmin(1)
        n = np.bincount(self._symbols(texts)[1], minlength=len(texts))
        phrases = cost[np.arange(len(texts)), best] / self.bits[best]
        return (letters & (phrases <= bounds.phrases(n)[np.arange(len(texts)), best])).tolist()

    def _predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The score is how much less the winner costs than the next."""
        cost, letters = self.parse(texts)
        out = []
        for row, any_letter in zip(cost, letters):
            if not any_letter or not len(row):
                out.append((UNKNOWN, 0.0))
                continue
            best = int(np.argmin(row))
            rest = np.delete(row, best)
            out.append((self.languages[best], float(rest.min() / (rest.min() + row[best])) if len(rest) else 1.0))
        return out


@dataclass(frozen=True)
class Bounds:
    """Phrases that texts of each language take per symbol, from texts that were not in the reference."""

    rate: np.ndarray
    spread: np.ndarray  # root mean square of the deviation, for one symbol

    def phrases(self, symbols: np.ndarray) -> np.ndarray:
        """The most phrases (text, language) of a text in that language: one law for all lengths."""
        n = symbols[:, None].astype(float)
        return MARGIN * self.rate * n + DEVIATIONS * self.spread * np.sqrt(n) + DEVIATIONS


def bounds_of(samples: dict[str, str]) -> Bounds:
    """Every second piece of the samples, parsed with references from the other pieces."""
    halves = {}
    for name, text in samples.items():
        pieces = [text[at : at + PIECE] for at in range(0, len(text), PIECE)]
        halves[name] = ("".join(pieces[0::2]), pieces[1::2] or pieces)
    known = build({name: reference for name, (reference, _) in halves.items()})
    rate, spread = np.ones(len(known.languages)), np.zeros(len(known.languages))
    for k, name in enumerate(known.languages):
        probes = halves[name][1]
        cost, letters = known.parse(probes)
        n = np.bincount(known._symbols(probes)[1], minlength=len(probes))
        used = letters & (n > 0)
        if used.any():
            phrases = cost[used, k] / known.bits[k]
            rate[k] = phrases.sum() / n[used].sum()
            spread[k] = np.sqrt(np.mean((phrases - rate[k] * n[used]) ** 2 / n[used]))
    return Bounds(rate, spread)


def build(samples: dict[str, str]) -> References:
    """Automata of the languages' sample texts, in the order of their names."""
    letters = letter_table()
    cleaned = {}
    for name in sorted(samples):
        points = letters[code_points(samples[name])]
        kept = (points != 0) | np.r_[True, points[:-1] != 0] if len(points) else np.zeros(0, bool)
        cleaned[name] = points[kept][:REFERENCE_CHARS]
    # the letters that are frequent in any language have columns
    share: dict[int, float] = {}
    for points in cleaned.values():
        values, counts = np.unique(points[points > 0], return_counts=True)
        for v, k in zip(values.tolist(), counts.tolist()):
            share[v] = max(share.get(v, 0.0), k / len(points))
    ordered = sorted(share, key=lambda v: (-share[v], v))
    frequent, others = ordered[: SYMBOLS - 2], ordered[SYMBOLS - 2 :]
    number = np.full(POINTS, SYMBOLS - 1, np.int32)  # letters that no reference has
    number[0] = 0
    number[frequent] = np.arange(1, len(frequent) + 1)
    number[others] = np.arange(SYMBOLS, SYMBOLS + len(others))
    n = SYMBOLS + len(others)
    tables, first, at, steps, starts = [], [], 0, [], np.zeros((len(cleaned), n), np.int32)
    for lang, points in enumerate(cleaned.values()):
        automaton = Automaton(number[points].tolist())
        table, rare = automaton.table(), automaton.rare()
        key = rare[:, 0] * n + rare[:, 1]
        order = np.argsort(key)
        steps.append((key[order], (2 * rare[order, 2]).astype(np.int32)))
        starts[lang] = 2 * (len(table) - 1)
        from_start = rare[rare[:, 0] == 0]
        starts[lang, from_start[:, 1]] = 2 * from_start[:, 2]
        tables.append(table)
        first.append(at)
        at += len(table)
    bits = np.array([math.log2(max(len(p), 2)) for p in cleaned.values()])
    joined = np.concatenate(tables) if tables else np.zeros((0, SYMBOLS), np.int32)
    return References(list(cleaned), number[letters], joined, np.array(first, np.int64), bits, steps, starts)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(documents: DataFrame) -> References:
    """References from a bounded sample of labelled documents that are not held out."""
    return build(sampled(documents))


def sampled(documents: DataFrame) -> dict[str, str]:
    """Texts of each language from a bounded sample of labelled documents that are not held out.

    A document gives at most a slice of its text, from a place that depends on a hash,
    so that a reference comes from many documents where there are many. How many letters
    these slices hold decides the share of a language's documents to read; where slices
    of ``SLICE`` letters hold too few, slices are longer and all are read. The document
    with the smallest hash is always read, so that no language is lost. The driver
    gets about ``SAMPLE_TIMES`` x ``REFERENCE_CHARS`` letters per language.
    """
    usable = documents.where("lang is not null and text is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    hashed = F.xxhash64("doc_id", "text", F.lit("reference"))
    usable = usable.where(F.col("text").rlike(r"\p{L}")).select("lang", hashed.alias("hash"), "doc_id", "text", F.length("text").alias("n"))
    place = (F.pmod("hash", F.lit(1 << 40)) / float(1 << 40)).alias("place")
    slices = [SLICE << k for k in range(7)]
    held = [F.sum(F.least("n", F.lit(size))).alias(f"held{size}") for size in slices]
    # repeated rows count once; one row per language
    sizes = usable.select("lang", "hash", "n", place).distinct().groupBy("lang").agg(F.min("place").alias("first"), *held).collect()
    needed = SAMPLE_TIMES * REFERENCE_CHARS
    chosen, size = F.lit(False), F.lit(SLICE)
    for row in sizes:
        # the shortest slices that hold what is needed
        cut = next((c for c in slices if row[f"held{c}"] >= needed), slices[-1])
        share = needed / row[f"held{cut}"] if cut == SLICE and row[f"held{cut}"] > needed else 1.0
        of_language = F.col("lang") == row["lang"]
        chosen = chosen | (of_language & (F.col("place") <= F.lit(max(share, row["first"]))))
        size = F.when(of_language, cut).otherwise(size)
    begin = F.pmod(F.xxhash64("hash", F.lit("slice")), F.greatest(F.col("n") - size + 1, F.lit(1))).cast("int") + 1
    rows = usable.select("*", place).where(chosen).select("lang", "place", "doc_id", F.substring("text", begin, size).alias("text")).distinct().collect()
    rows.sort(key=lambda r: (r["place"], r["doc_id"], r["text"]))
    samples: dict[str, list[str]] = {}
    for r in rows:
        samples.setdefault(r["lang"], []).append(r["text"])
    return {name: "\n".join(texts) for name, texts in samples.items()}


def predicted(documents: DataFrame, references: References, out: str = "_language") -> DataFrame:
    """The documents with a struct (lang_pred, score)."""
    # SYMBOLS x twice REFERENCE_CHARS numbers per language, whatever the corpus
    shared = documents.sparkSession.sparkContext.broadcast(references)

    @F.pandas_udf("lang_pred string, score double")
    def parse(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        settle()
        known = shared.value
        for series in texts:
            yield pd.DataFrame(known.predict(list(series)), columns=["lang_pred", "score"])

    return documents.withColumn(out, parse(F.col("text")))


def identify(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document.

    A text that is NULL or has no letter is ``und`` with score 0, as is every text
    when nothing can be learned; with one language its score is 1. Ties go to the
    name that sorts first; repeated rows agree; an empty table gives an empty result.
    Columns besides doc_id, text and lang are not read.
    """
    rows = predicted(documents.select("doc_id", "text"), learn(documents.select("doc_id", "text", "lang")))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "_language.lang_pred", "_language.score")


def accepted(documents: DataFrame) -> DataFrame:
    """The documents that are text in one of the learned languages, with their columns.

    A document stays if the winner parses it into no more phrases than texts of that
    language take: ``MARGIN`` times their rate, and ``DEVIATIONS`` of the spread that
    lengths like its own have. Gibberish and languages that no label names take more.
    Without a letter, with a NULL text, or when nothing can be learned it goes; very short
    texts are within any spread and stay. Repeated rows and rows without an id are judged
    by their texts alone.
    """
    samples = sampled(documents)
    shared = documents.sparkSession.sparkContext.broadcast((build(samples), bounds_of(samples)))

    @F.pandas_udf("boolean")
    def known(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        settle()
        references, bounds = shared.value
        for series in texts:
            said, group, held = [], [], 0
            for text in series:
                group.append(text)
                held += len(text) if text else 0
                if held >= TOGETHER:
                    said += references.known(group, bounds)
                    group, held = [], 0
            yield pd.Series(said + (references.known(group, bounds) if group else []), dtype=bool)

    return documents.where(known(F.col("text")))
