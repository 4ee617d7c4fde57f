import hashlib
import random

import numpy as np

from tests.llm.rows import documents, prose
from tidegauge.llm import prefix_hash as ph


def hashes(text):
    return ph.PrefixHashes(ph.code_points(text), [ph.Powers(b) for b in ph.BASES])


def test_spans_are_equal_exactly_where_texts_are():
    a, b = "abracadabra é\U0001f600 abra", "xx abracadabra é\U0001f600 abba"
    x, y = hashes(a), hashes(b)
    for i in range(len(a)):
        for j in range(len(b)):
            for n in range(0, min(len(a) - i, len(b) - j) + 1, 3):
                assert (x.span(i, i + n) == y.span(j, j + n)) == (a[i : i + n] == b[j : j + n])


def test_longest_extension():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(1, 60))) for _ in range(2))
        i, j = rng.randrange(len(a)), rng.randrange(len(b))
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        assert ph.longest_extension(hashes(a), i, hashes(b), j) == n


def test_taking_over_a_head_changes_nothing():
    text, other = prose(1, 200), prose(2, 50)
    head = hashes(text)
    edited = text[:700] + other
    again = ph.PrefixHashes(ph.code_points(edited), head.powers, head, 700)
    assert ph.fingerprint(again) == ph.fingerprint(hashes(edited))


def test_smallest_of_repeated_values():
    values = np.array([5] * 5000 + list(range(100)), np.uint64)
    assert ph.smallest(values, 32).tolist() == list(range(32))


def test_likeness():
    text = prose(3, 800)
    cut = len(text) // 4
    near = text[: len(text) - cut] + prose(4, 800)[:cut]
    a, b, c = (ph.fingerprint(hashes(t)) for t in (text, near, prose(5, 700)))
    assert ph.likeness(a, a) == 1.0 and 0.6 < ph.likeness(a, b) < 0.95 and ph.likeness(a, c) < 0.1
    moved = ph.fingerprint(hashes("new start " + text))
    assert ph.likeness(a, moved) > 0.7
    empty = ph.fingerprint(hashes(""))
    assert ph.likeness(empty, empty) == 1.0 and ph.likeness(empty, a) == 0.0
    for n in (1, 2, 15, 16, 17, 31, 33):
        t = text[:n]
        assert ph.likeness(ph.fingerprint(hashes(t)), ph.fingerprint(hashes(t + "x"))) > 0.4 or n < 2


def slow(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        a, b, c = (ph.fingerprint(hashes(t)) for t in (text, edited, following))
        out.append((str(i), len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, ph.likeness(a, b), ph.likeness(a, c)))
    return sorted(out)


def shown(got):
    return sorted((str(r[0]), *r[1:]) for r in got)


def test_next_documents_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ph, "ROWS_PER_BUCKET", 7)
    rows = [(i * i - 50, prose(i % 50, 3 + i % 60)) for i in range(150)]
    got = ph.compare_with_next(documents(spark, [(*r, None, None, None) for r in rows])).collect()
    assert shown(got) == slow(rows)


def test_edge_rows(spark, edge, none):
    assert shown(ph.compare_with_next(edge).collect()) == slow([(r.doc_id, r.text) for r in edge.collect()])
    assert ph.compare_with_next(none).count() == 0
    lone = ph.compare_with_next(documents(spark, [(4, "abcdefgh", None, None, None)])).collect()
    assert lone[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and lone[0].near_next == 1.0
