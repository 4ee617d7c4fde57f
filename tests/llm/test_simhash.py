import random
import re

import numpy as np
import xxhash

from tests.llm.rows import documents, prose
from tidegauge.llm import simhash


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if shingles and 2 * counts[b] > len(shingles))


def slow_classes(codes, radius=2):
    label = list(range(len(codes)))
    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= radius:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_fingerprints():
    for t in [None, "", "  ", "A", "a b", "a b c", "É é ÀB x", prose(4, 500), "x y z\x1cw q", "a b c a b c a b c"]:
        assert simhash.fingerprint_of(t) % 2**64 == slow_fingerprint(t)


def test_gray_rank_is_the_place_in_the_gray_sequence():
    n = np.arange(5000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def clustered(seed, n):
    rng = random.Random(seed)
    codes = set()
    while len(codes) < n:
        code = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 9])):
            codes.add(code)
            for _ in range(rng.choice([1, 2, 3])):
                code ^= 1 << rng.randrange(64)
    return sorted(codes)


def test_index_finds_all_pairs_of_a_group():
    codes = np.array(clustered(1, 400), np.uint64)
    groups = np.array([i % 3 for i in range(len(codes))])
    index = simhash.GrayIndex(codes, groups)
    got = {tuple(sorted(p)) for a, b in index.links(2) for p in zip(a.tolist(), b.tolist())}
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    wanted = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if apart[i, j] <= 2 and groups[i] == groups[j]}
    assert got == wanted and wanted


def test_links_and_classes_with_heavy_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HEAVY", 3)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    near = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    codes = sorted(near | set(clustered(2, 300)))
    signed = [c - 2**64 if c >= 2**63 else c for c in codes]
    nodes = simhash.classes(simhash.links(spark.createDataFrame([(c,) for c in signed], "fp long"))).collect()
    root = {r.node: r.root for r in nodes}
    label = slow_classes(codes)
    for i, a in enumerate(signed):
        for j, b in enumerate(signed[:i]):
            assert (root.get(a, a) == root.get(b, b)) == (label[i] == label[j])


def check(rows, got):
    codes = [slow_fingerprint(t) for _, t in rows]
    label = slow_classes(codes)
    least = {}
    for (doc_id, _), x in zip(rows, label):
        if doc_id is not None:
            least[x] = min(least.get(x, doc_id), doc_id)
    wanted = sorted((str(i), f"{c:016x}", least.get(x)) for (i, _), c, x in zip(rows, codes, label))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == wanted


def test_documents(spark, edge, none):
    text = prose(9, 400)
    words = text.split()
    rows = [(i, " ".join([*words[:i], "changed", *words[i + 1 :]])) for i in range(40)] + [(100 + i, prose(i, 40)) for i in range(40)]
    check(rows, simhash.near_duplicates(documents(spark, [(*r, None, None, None) for r in rows])).collect())
    check([(r.doc_id, r.text) for r in edge.collect()], simhash.near_duplicates(edge).collect())
    assert simhash.near_duplicates(none).count() == 0


def test_one_document_of_each_class_stays(edge, none):
    kept = simhash.representatives(edge)
    assert kept.columns == edge.columns
    classes = {r.component_id for r in simhash.near_duplicates(edge).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(classes) and set(ids) == classes
    assert kept.where("nth <> 'own nth'").count() == 0
    assert simhash.representatives(none).count() == 0


def test_texts_without_an_id_or_with_a_common_one_stay(spark, edge):
    rows = [(5, prose(1, 80)), (5, prose(2, 40)), (7, prose(1, 80)), (None, prose(3, 50)), (None, prose(4, 60)), (None, prose(4, 60))]
    rows += [(9, "A b c d"), (9, "a b c d"), (8, ""), (11, None), (11, "x y z")]
    got = simhash.representatives(documents(spark, [(*r, None, None, None) for r in rows])).collect()
    wanted = [rows[0], rows[1], rows[3], rows[4], (9, "A b c d"), (8, ""), (11, "x y z")]
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == sorted(map(str, wanted))
    texts = [r.text for r in edge.collect()]
    kept = [r.text for r in simhash.representatives(edge).collect()]
    label = dict(zip(texts, slow_classes([slow_fingerprint(t) for t in texts])))
    assert sorted(label[t] for t in kept) == sorted(set(label.values())) and "the same id as another text" in kept
