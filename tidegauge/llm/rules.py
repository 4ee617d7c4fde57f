"""Quality rules combined by weak supervision.

Each rule looks at one figure of a whole text and votes *good*, *bad* or abstains.
No rule is trusted by itself: expectation-maximisation estimates from the votes of
all documents how often each rule is right on good and on bad documents and how
common good documents are, without labels, and a document stays if the posterior
probability that it is good reaches one half.

The figures are DataFrame expressions over one text each; no text is exploded or
shuffled. Votes are counted by pattern (at most 3 to the number of rules rows), and
every step of the estimation is one aggregation of those counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import BLANKS, as_text, materialise

SPAN = 8  # words of a window
MIN_WORDS = 20
STEPS = 25
# Bounds of a rule's accuracy. On good documents rules are mostly right. Each kind of bad
# document shows in a few rules only, so a vote of good may mean little; none is certain.
ON_GOOD = (0.9, 0.999)
ON_BAD = (0.02, 0.999)
START = (0.97, 0.4)
KEEP_FROM = 0.5


@dataclass(frozen=True)
class Rule:
    """Votes bad from ``bad`` on and good up to ``good``; with ``bad`` below ``good`` the other way round."""

    name: str
    figure: Column
    good: float
    bad: float

    def vote(self) -> Column:
        up = self.bad > self.good
        bad = self.figure >= self.bad if up else self.figure <= self.bad
        good = self.figure <= self.good if up else self.figure >= self.good
        return F.when(bad, 0).when(good, 1).otherwise(-1)


def per_word(name: str) -> Column:
    return F.col(name) / F.greatest(F.col("n_words"), F.lit(1))


def per_char(name: str) -> Column:
    return F.col(name) / F.greatest(F.col("word_chars"), F.lit(1))


def rules() -> list[Rule]:
    """The rules. Their bounds are wide apart; between them a rule abstains."""
    return [
        Rule("symbols", per_char("n_symbols"), 0.02, 0.06),
        Rule("repeats", per_word("n_repeat_words"), 0.05, 0.25),
        Rule("dup_lines", F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 0.1, 0.3),
        Rule("capitals", per_char("n_capitals"), 0.12, 0.35),
        Rule("shouts", per_word("n_shouts"), 0.05, 0.3),
        Rule("sentences", F.col("n_words") / F.greatest(F.col("n_stops"), F.lit(1)), 40.0, 120.0),
        Rule("word_length", F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)), 9.0, 14.0),
        Rule("plain_words", per_word("n_plain"), 0.85, 0.6),
    ]


def only(text: Column, kept: str) -> Column:
    """Number of characters of a class, given as the inside of a regular-expression class."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def repeated_words(words: Column, windows: Column) -> Column:
    """Words inside windows that occur twice or more; ``windows`` has a hash for each start.

    Most texts have no equal windows and end at a distinct count. In others the
    (hash, start) pairs are sorted, starts with an equal neighbour are kept, and each
    adds the words that the window before it did not cover yet.
    """
    pairs = F.sort_array(F.arrays_zip(windows.alias("h"), F.sequence(F.lit(0), F.size(windows) - 1).alias("at")))

    def starts(s: Column) -> Column:
        def again(i: Column) -> Column:
            own = F.get(s, i)["h"]
            return (own == F.get(s, i - 1)["h"]) | (own == F.get(s, i + 1)["h"])

        kept = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.coalesce(again(i), F.lit(False)))
        return F.array_sort(F.transform(kept, lambda i: F.get(s, i)["at"]))

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(-SPAN).alias("last"), F.lit(0).alias("total")),
            lambda acc, p: F.struct(p.alias("last"), (acc["total"] + F.least(F.lit(SPAN), p - acc["last"])).alias("total")),
            lambda acc: acc["total"],
        )

    # one-element arrays bind the sorted pairs, which are then computed once
    slow = F.transform(F.array(pairs), lambda s: covered(starts(s)))[0]
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(slow).cast("long")


def figures(documents: DataFrame) -> DataFrame:
    """What the rules look at, one row per document. NULL texts are like empty ones."""
    text = F.col("_text")
    shown = documents.select("doc_id", as_text(F.col("text")).alias("_text"))
    split = shown.select(
        "doc_id",
        text,
        F.array_remove(F.split(text, f"[{BLANKS}]+"), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANKS}]")).alias("_lines"),
    )
    words = F.col("_words")
    windows = F.when(
        F.size(words) >= SPAN, F.transform(F.sequence(F.lit(1), F.size(words) - SPAN + 1), lambda i: F.xxhash64(F.slice(words, i, SPAN)))
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = split.withColumn("_windows", windows)
    return hashed.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        only(text, "#*$%&|<>").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(words, F.col("_windows")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        only(text, r"\p{Lu}").alias("n_capitals"),
        only(text, "!").alias("n_shouts"),
        only(text, ".!?").alias("n_stops"),
        # blanks left of a word that is letters with at most one mark behind them
        F.size(F.filter(words, lambda w: w.rlike(r"^[\p{L}'’-]+[.,;:!?]?$"))).cast("long").alias("n_plain"),
    )


def estimate(patterns: DataFrame, names: list[str]) -> tuple[float, dict[str, tuple[float, float]]]:
    """Share of good documents, and of each rule how often it is right on good and on bad ones.

    ``patterns`` holds the votes and their ``count``. Each step weighs every pattern
    with its posterior and counts votes again. Estimates are rounded, so that the
    order of sums doesn't show.
    """
    share, right = 0.8, {n: START for n in names}
    for _ in range(STEPS):
        good = posterior(share, right)
        sums = [F.sum("count").alias("n"), F.sum(F.col("count") * good).alias("good")]
        for n in names:
            vote = F.col(n)
            for label, chosen in (("g", vote >= 0), ("b", vote >= 0), ("gg", vote == 1), ("bb", vote == 0)):
                weight = good if label[0] == "g" else 1 - good
                sums.append(F.sum(F.when(chosen, F.col("count") * weight).otherwise(0.0)).alias(f"{label}_{n}"))
        row = patterns.agg(*sums).first()
        if not row["n"]:
            break
        before = (share, right)
        share = round(min(max(row["good"] / row["n"], 0.05), 0.95), 6)
        # one vote is added, so that a rule that never votes keeps what it started with
        right = {
            n: tuple(
                round(min(max((row[f"{hit}_{n}"] + start) / (row[f"{cast}_{n}"] + 1.0), low), high), 6)
                for hit, cast, start, (low, high) in (("gg", "g", START[0], ON_GOOD), ("bb", "b", START[1], ON_BAD))
            )
            for n in names
        }
        if (share, right) == before:
            break
    return share, right


def posterior(share: float, right: dict[str, tuple[float, float]]) -> Column:
    """Probability that a document with these votes is good; an abstention says nothing."""
    odds = F.lit(math.log(share / (1 - share)))
    for name, (good, bad) in right.items():
        odds = odds + F.when(F.col(name) == 1, math.log(good / (1 - bad))).when(F.col(name) == 0, math.log((1 - good) / bad)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge(documents: DataFrame) -> DataFrame:
    """Figures, ``base_failed``, posterior ``quality`` and ``kept`` of every document.

    Empty and NULL texts have no words and fail the base rule; repeated rows are
    judged alike, each for itself; an empty table gives an empty result. Columns
    besides doc_id and text are not read, so that clashing names don't matter.
    """
    voters = rules()
    names = [f"vote_{r.name}" for r in voters]
    counted = materialise(figures(documents))
    voted = counted.select("*", *[r.vote().alias(n) for r, n in zip(voters, names)])
    patterns = materialise(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("count")))
    share, right = estimate(patterns, names)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return voted.withColumn("quality", posterior(share, right)).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM)
    )
