import random

import numpy as np

from tests.llm.rows import documents, prose
from tests.llm.test_simhash import slow_fingerprint
from tidegauge.llm import shingles, simhash


def slow_similarity(a, b):
    sets = []
    for t in (a, b):
        words = t.lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set())
    return len(sets[0] & sets[1]) / max(len(sets[0] | sets[1]), 1)


def edited(text, seed, edits):
    words, rng = text.split(), random.Random(seed)
    for i in rng.sample(range(len(words)), edits):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


def test_similarity_of_shingle_sets():
    known, base = shingles.Words(), prose(1, 150)
    for a, b in [(base, edited(base, k, k)) for k in range(9)] + [("a b", "A  b"), ("a b", "a c"), (base, prose(2, 90)), ("", "x")]:
        assert abs(shingles.similarity(shingles.shingles(a, known), shingles.shingles(b, known)) - slow_similarity(a, b)) < 1e-12


def test_pairs_at_the_limit_share_a_key():
    known, missed = shingles.Words(), 0
    for k in range(300):
        base = prose(k, 180)
        codes = [shingles.shingles(t, known) for t in (base, edited(base, k, 4))]
        missed += not set(shingles.keys(codes[0]).tolist()) & set(shingles.keys(codes[1]).tolist())
    assert missed == 0


def test_near_copies_of_ordinary_texts_go(spark):
    rows, far = [], 0
    for k in range(40):
        base = prose(1000 + k, 120 + 5 * k)
        copy = edited(base, k, 2)
        other = edited(base, 500 + k, 25)  # about half of the shingles
        assert slow_similarity(base, copy) >= 0.8 and slow_similarity(base, other) < 0.6
        far += (slow_fingerprint(base) ^ slow_fingerprint(copy)).bit_count() > 2
        rows += [(10 * k + 1, base), (10 * k + 2, copy), (10 * k + 3, other), (10 * k + 4, base.upper())]
    assert far > 20
    # a chain: each text is like the next, the ends are not
    chain = [prose(7, 200)]
    for k in range(12):
        chain.append(edited(chain[-1], 900 + k, 3))
    assert slow_similarity(chain[0], chain[-1]) < 0.5
    rows += [(5000 + k, t) for k, t in enumerate(chain)]
    got = simhash.representatives(documents(spark, [(*r, None, None, None) for r in rows])).collect()
    assert sorted(r.doc_id for r in got) == sorted([10 * k + j for k in range(40) for j in (1, 3)] + [5000])


def test_links_of_a_group_span_it():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 60, 100).astype(np.uint64))
    near = [(k, np.delete(base, k)) for k in range(30)]
    other = [(100 + k, np.unique(rng.integers(0, 1 << 60, 100).astype(np.uint64))) for k in range(3)]
    got = list(shingles._links_of(near + other))
    assert len(got) == 29 and all(a < 30 and b < 30 for a, b in got)
