import re
from collections import Counter

from tests.llm.rows import documents, prose
from tidegauge.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {p for i, w in enumerate(windows) if count[w] > 1 for p in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def check(rows, got):
    wanted = sorted((str(i), *slow(t)) for i, t in rows)
    assert sorted((str(r.doc_id), *[r[n] for n in NAMES]) for r in got) == wanted
    assert not any(r.kept and r.base_failed for r in got)


def junk(seed):
    words = prose(seed, 120).split()
    return [
        " ".join(f"{w}***" for w in words), " ".join(f"{w.upper()}!!" for w in words), " | ".join(words),
        "\n".join(words[i % 3] + " again" for i in range(60)),
    ][seed % 4]


def test_figures_and_verdict(spark):
    rows = [(i, prose(i, 30 + i % 90)) for i in range(160)] + [(1000 + i, junk(i)) for i in range(24)]
    span = prose(77, 8)
    rows += [(2000, span + " " + span), (2001, prose(5, 60) + " " + span + " x " + span), (2002, "a " * 40), (2003, "a\nb\na\n\n \nb")]
    got = rules.judge(documents(spark, [(*r, None, None, None) for r in rows])).collect()
    check(rows, got)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(160))
    assert not any(kept[1000 + i] for i in range(24))


def test_estimation_finds_the_accuracies(spark):
    import random

    rng = random.Random(3)
    right = {"a": (0.98, 0.9), "b": (0.95, 0.8), "c": (0.97, 0.85)}
    votes = Counter()
    for _ in range(20000):
        good = rng.random() < 0.75
        row = []
        for g, b in right.values():
            hit = rng.random() < (g if good else b)
            row.append(-1 if rng.random() < 0.2 else int(hit == good))
        votes[tuple(row)] += 1
    patterns = spark.createDataFrame([(*k, n) for k, n in votes.items()], "a int, b int, c int, count long")
    share, found = rules.estimate(patterns, list(right))
    assert abs(share - 0.75) < 0.03
    for n, (g, b) in right.items():
        assert abs(found[n][0] - g) < 0.03 and abs(found[n][1] - b) < 0.06


def test_edge_rows(edge, none):
    check([(r.doc_id, r.text) for r in edge.collect()], rules.judge(edge).collect())
    assert rules.judge(none).count() == 0
