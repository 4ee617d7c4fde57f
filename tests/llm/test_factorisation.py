import zlib

import numpy as np

from tests.llm.rows import documents, prose
from tests.llm.test_rules import junk
from tidegauge.llm import factorisation as fm


def corpus(spark, flip_held_out=False):
    rows = [(i, prose(i, 20 + i % 200)) if i % 4 else (i, junk(i // 4)) for i in range(600)]
    labels = []
    for i, _ in rows:
        held = zlib.crc32(str(i).encode()) % 4 == 2
        good = int(i % 4 != 0)
        labels.append((i, 1 - good if held and flip_held_out else good, 0))
    return documents(spark, [(*r, None, None, None) for r in rows]), spark.createDataFrame(labels, "doc_id long, quality long, toxic long")


def test_held_out_documents(spark):
    docs, labels = corpus(spark)
    got = fm.classify(docs, labels).collect()
    assert len(got) == 600 and {r.held_out for r in got} == {True, False}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 4 != 0) for r in held) >= 0.97 * len(held)
    flipped = {r.doc_id: r.score for r in fm.classify(*corpus(spark, flip_held_out=True)).collect()}
    assert all(abs(flipped[r.doc_id] - r.score) < 1e-9 for r in got)


def test_scores_by_the_pairwise_sum():
    rng = np.random.default_rng(1)
    size = fm.BUCKETS + fm.N_STATISTICS * fm.STEPS_PER_STATISTIC
    model = fm.Model(0.1, rng.normal(size=size), rng.normal(size=(size, fm.RANK)))
    words, stats = fm.features("a few words, a few words more\nand a line", fm.Buckets())
    numbers = [*words, *stats]
    x = [fm.WORD_SHARE / np.sqrt(len(words))] * len(words) + [1 / np.sqrt(len(stats))] * len(stats)
    raw = 0.1 + sum(model.weights[n] * v for n, v in zip(numbers, x))
    for i in range(len(numbers)):
        for j in range(i):
            raw += float(model.factors[numbers[i]] @ model.factors[numbers[j]]) * x[i] * x[j]
    assert abs(model.score(words, stats) - 1 / (1 + np.exp(-raw))) < 1e-9


def test_edge_rows(spark, edge, none):
    _, labels = corpus(spark)
    odd = labels.unionByName(spark.createDataFrame([(3, 0, 0), (None, 1, None), (6, None, None), (9, 7, 0)], labels.schema))
    got = fm.classify(edge, odd).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    nothing = fm.classify(edge, labels.limit(0)).collect()
    assert len({r.score for r in nothing}) == 1
    one_class = fm.classify(edge, labels.where("quality = 1")).collect()
    assert all(r.predicted == 1 for r in one_class)
    assert fm.classify(none, labels).count() == 0
    kept = fm.accepted(edge, labels)
    assert kept.columns == edge.columns and kept.where("score <> 'own score'").count() == 0


def logit(p):
    return np.log(p / (1 - p))


def test_length_alone_does_not_raise_a_score():
    rng = np.random.default_rng(2)
    size = fm.BUCKETS + fm.N_STATISTICS * fm.STEPS_PER_STATISTIC
    model = fm.Model(0.1, rng.normal(0.1, 0.3, size), rng.normal(0, 0.1, (size, fm.RANK)))
    words, none = rng.integers(0, fm.BUCKETS, 400), np.zeros(0, np.int64)
    scores = [logit(model.score(np.tile(words, k), none)) for k in (1, 10, 1000)]
    assert max(scores) - min(scores) < 0.2


def test_fitted_on_what_is_scored(monkeypatch):
    rng = np.random.default_rng(3)
    words = rng.integers(0, 3000, 60_000)
    found, counts = fm.cells(words)
    assert counts.sum() == len(words) and np.array_equal(np.repeat(found, counts.astype(int)), np.sort(words))
    # counts of cells are the same as all words one by one
    stats, some = fm.BUCKETS + np.arange(5), words[:3000]
    by_cell = fm.fit([(*fm.cells(some), stats, 1), (*fm.cells(words[:40]), stats, 0)] * 40, 0.5)
    by_word = fm.fit([(some, np.ones(3000), stats, 1), (words[:40], np.ones(40), stats, 0)] * 40, 0.5)
    assert np.allclose(by_cell.weights, by_word.weights, atol=1e-3) and np.allclose(by_cell.factors, by_word.factors, atol=1e-3)
    assert by_cell.score(some, stats) > 0.7 > 0.3 > by_cell.score(words[:40], stats)
    monkeypatch.setattr(fm, "TRAINING_CELLS", 500)
    part, stand = fm.cells(words)
    assert len(part) <= 500 and abs(stand.sum() - len(words)) < 1


def test_accuracy_by_length(spark):
    sizes = (15, 100, 500, 3000, 30_000)
    rows, labels = [], []
    for i in range(600):
        n = sizes[i % 4] if i % 60 else sizes[4]
        bad = i % 3 == 0
        # bad texts repeat their words; their structure else is the same
        text = prose(i, n) if not bad else " ".join((prose(i, max(n // 8, 3)) + " ").split() * 8)
        rows.append((i, text, None, None, None))
        labels.append((i, int(not bad), 0))
    # far longer than any text of the sample
    rows += [(9000, prose(9000, 300_000), None, None, None), (9001, " ".join(prose(9001, 37_000).split() * 8), None, None, None)]
    got = {r.doc_id: r for r in fm.classify(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality long, toxic long")).collect()}
    for n in sizes[:4]:
        held = [i for i in range(600) if got[i].held_out and i % 60 and sizes[i % 4] == n]
        assert len(held) > 20 and sum(got[i].predicted == int(i % 3 != 0) for i in held) >= 0.9 * len(held)
    assert 0.001 < got[9001].score < 0.7 <= got[9000].score
