"""Quality classifier: a factorisation machine over hashed words and structure statistics.

A document is a sum of features, each with a weight and a low-rank factor: its words,
hashed into ``BUCKETS`` cells, and its structure statistics, each cut into steps.
A group of n features weighs 1 / sqrt(n) each, words ``WORD_SHARE`` of that, since
single words say less than structure; the words of a text of over ``EVEN_WORDS`` weigh
1 / n times what makes this continuous, so that long texts count by the mean of their
words and no text scores at a magnitude that fitting has not seen. All pairs of features
interact through the product of their factors; the sum-of-squares identity

    sum over pairs <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2

scores a text in time linear in its words.

The model is fitted on a sample of labelled documents of at most about
``TRAINING_ROWS`` rows, chosen by a hash of the id, on the driver: a few thousand
lists of feature numbers. It sees the words of whole texts, as counts of their cells; of
a text with over ``TRAINING_CELLS`` cells evenly spread words stand for all. Scoring reads
every whole text once and shuffles nothing. Labels, language, source, ``n_chars`` and id
are never features: lengths are taken from the text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import settle, spare

BUCKETS = 1 << 15
RANK = 8
STEPS_PER_STATISTIC = 16
TRAINING_ROWS = 8000
TRAINING_CELLS = 4096  # different cells of a training document's words, which bounds the sample
EVEN_WORDS = 256  # from so many words on, the words of a text count by their mean
EPOCHS = 8
BATCH = 64
RATE = 0.05
PENALTY = 1e-5
KEEP_FROM = 0.7
WORD_SHARE = 0.4
CACHED_WORDS = 300_000

# Characters whose share of the text is a statistic.
MARKS = "#*$%&|<>!?.,:;-_=/@\"'()[]{}+~^"


class Buckets(dict):
    """Bucket of a lower-case word; remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = zlib.crc32(word) % BUCKETS
        return found


def statistics(data: bytes, words: list[bytes]) -> np.ndarray:
    """Structure of a text: shares of kinds of characters, lengths, repetition, lines. All from 0 on."""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, n = max(len(data), 1), max(len(words), 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    shares = [counts[ord(m)] / size for m in MARKS]
    return np.array(
        [
            *shares,
            counts[65:91].sum() / size,
            counts[97:123].sum() / size,
            counts[48:58].sum() / size,
            counts[128:].sum() / size,
            sum(counts[ord(m)] for m in "#*$%&|<>") / n,
            (counts[33] + counts[63]) / n,
            min(lengths.mean() / 32, 1.0),
            min(lengths.max() / 256, 1.0),
            len(set(words)) / n,
            1 - len(set(lines)) / max(len(lines), 1),
            min(n / max(len(lines), 1) / 256, 1.0),
            min(np.log1p(n) / 12, 1.0),
            (counts[46] + counts[33] + counts[63]) / n,
            sum(a == b for a, b in zip(words, words[1:])) / n,
            1 - len(set(zip(words, words[1:], words[2:]))) / max(len(words) - 2, 1) if len(words) > 2 else 0.0,
        ]
    )


N_STATISTICS = len(MARKS) + 15


def features(text: str | None, buckets: Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the text's features: words with repeats, and the steps that each statistic reaches."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    # square roots spread out the small shares, where most texts differ
    step = np.minimum((np.sqrt(statistics(data, words)) * STEPS_PER_STATISTIC).astype(np.int64), STEPS_PER_STATISTIC - 1)
    # all steps up to its own: near values share most of their features
    reached = np.arange(STEPS_PER_STATISTIC) <= step[:, None]
    return np.fromiter(map(buckets.__getitem__, data.lower().split()), np.int64, len(words)), BUCKETS + np.flatnonzero(reached)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray  # one per feature
    factors: np.ndarray  # RANK per feature

    def score(self, words: np.ndarray, stats: np.ndarray) -> float:
        """Probability of label 1."""
        linear, total, square = self.bias, np.zeros(self.factors.shape[1]), 0.0
        for numbers, x in ((words, word_worth(len(words))), (stats, _worth(len(stats)))):
            if len(numbers):
                v = self.factors[numbers]
                linear += x * float(self.weights[numbers].sum())
                total += x * v.sum(axis=0)
                square += x * x * float(np.einsum("ij,ij->", v, v))
        return float(1 / (1 + np.exp(-np.clip(linear + (float(total @ total) - square) / 2, -30, 30))))


def _worth(n: int) -> float:
    return 1 / np.sqrt(n) if n else 0.0


def word_worth(n: int) -> float:
    """What each of a text's n words weighs."""
    return WORD_SHARE * _worth(n) * min(1.0, float(np.sqrt(EVEN_WORDS / max(n, 1))))


def cells(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different cells of a text's words, and how many words of the text each stands for."""
    found, counts = np.unique(words, return_counts=True)
    if len(found) <= TRAINING_CELLS:
        return found, counts.astype(float)
    part = words[:: -(-len(words) // TRAINING_CELLS)]
    found, counts = np.unique(part, return_counts=True)
    return found, counts * (len(words) / len(part))


def fit(examples: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], prior: float, seed: int = 7) -> Model:
    """Minibatch Adagrad on the logistic loss; label 1 weighs ``prior`` of the total.

    An example has the cells of its words, how many words each stands for, its
    statistics and its label; words of one cell are pairs as others are.
    With no example, or of one class only, the model knows the share of label 1 alone.
    """
    size = BUCKETS + N_STATISTICS * STEPS_PER_STATISTIC
    labels = np.array([y for *_, y in examples], float)
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        return Model(float(np.log((share + 0.01) / (1.01 - share))), np.zeros(size), np.zeros((size, RANK)))
    rng = np.random.default_rng(seed)
    bias, weights, factors = 0.0, np.zeros(size), rng.normal(0, 0.02, (size, RANK))
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
    balance = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
    flat = [np.concatenate([w, s]).astype(np.int32) for w, _, s, _ in examples]
    times = [np.concatenate([c, np.ones(len(s))]).astype(np.float32) for _, c, s, _ in examples]
    each = [(word_worth(round(c.sum())), len(w), _worth(len(s)), len(s)) for w, c, s, _ in examples]
    for _ in range(EPOCHS):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            numbers = np.concatenate([flat[i] for i in chosen])
            one = np.concatenate([np.repeat([a, b], [n, m]) for a, n, b, m in (each[i] for i in chosen)])
            x = one * np.concatenate([times[i] for i in chosen])
            starts = np.cumsum([0] + [len(flat[i]) for i in chosen[:-1]])
            row = np.repeat(np.arange(len(chosen)), [len(flat[i]) for i in chosen])
            vx = factors[numbers] * x[:, None]
            total = np.add.reduceat(vx, starts, axis=0)
            raw = bias + np.add.reduceat(weights[numbers] * x, starts) + ((total**2).sum(axis=1) - np.add.reduceat((factors[numbers] ** 2).sum(axis=1) * x * one, starts)) / 2
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) * balance[chosen] / len(chosen)
            touched, back = np.unique(numbers, return_inverse=True)
            scale = error[row] * x
            grad_w = np.bincount(back, scale, len(touched)) + PENALTY * weights[touched]
            inner = (total[row] - factors[numbers] * one[:, None]) * scale[:, None]
            grad_v = np.stack([np.bincount(back, inner[:, k], len(touched)) for k in range(RANK)], axis=1) + PENALTY * factors[touched]
            seen_w[touched] += grad_w**2
            seen_v[touched] += grad_v**2
            seen_b += error.sum() ** 2
            weights[touched] -= RATE * grad_w / np.sqrt(seen_w[touched])
            factors[touched] -= RATE * grad_v / np.sqrt(seen_v[touched])
            bias -= RATE * error.sum() / np.sqrt(seen_b)
    return Model(bias, weights, factors)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on a sample of labelled documents that are not held out.

    Documents with labels of both kinds or none are left out. The rarer label gives up
    to half of the sample, so that a rare kind of text is seen often enough.
    """
    marked = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
    )
    sizes = {r["quality"]: r["n"] for r in marked.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit("training")), F.lit(1 << 30)) / float(1 << 30)
    shares = {q: min(1.0, TRAINING_ROWS / 2 / n) for q, n in sizes.items()}
    chosen = F.lit(False)
    for quality, share in shares.items():
        chosen = chosen | ((F.col("quality") == quality) & (place < share))
    sample = marked.where(chosen)

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        settle()
        buckets = Buckets()
        for rows in batches:
            found = [features(t, buckets) for t in rows["text"]]
            held = [cells(w) for w, _ in found]
            yield pd.DataFrame(
                {
                    "doc_id": rows["doc_id"], "words": [w.astype("<i4").tobytes() for w, _ in held], "counts": [c.astype("<f4").tobytes() for _, c in held],
                    "stats": [s.astype("<i4").tobytes() for _, s in found], "quality": rows["quality"],
                }
            )

    # about TRAINING_ROWS ids, whatever the corpus: texts stay where they are
    columns = documents.select(F.col("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    schema = "doc_id long, words binary, counts binary, stats binary, quality int"
    rows = columns.mapInPandas(numbers, schema).collect()  # about TRAINING_ROWS rows
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["words"]), bytes(r["counts"]), bytes(r["stats"])))
    prior = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    read = lambda r: (np.frombuffer(r["words"], "<i4"), np.frombuffer(r["counts"], "<f4"), np.frombuffer(r["stats"], "<i4"), r["quality"])
    return fit([read(r) for r in rows], prior)


def scored(documents: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """The documents with a probability that their label is 1; NULL texts are empty ones."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS x (RANK + 1) numbers, whatever the corpus

    @F.pandas_udf("double")
    def probability(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        settle()
        buckets, known = Buckets(), shared.value
        for series in texts:
            yield pd.Series([known.score(*features(t, buckets)) for t in series], dtype="float64")

    return documents.withColumn(out, probability(F.col("text")))


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    NULL and empty texts get a score like others; repeated rows score alike; without
    usable labels all scores are the same; an empty table gives an empty result.
    Columns besides doc_id and text are not read.
    """
    model = train(documents, labels)
    rows = scored(documents.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score at least ``KEEP_FROM``, with their columns."""
    score = spare(documents, "score")
    rows = scored(documents, train(documents, labels), score)
    return rows.where(F.col(score) >= KEEP_FROM).drop(score)
