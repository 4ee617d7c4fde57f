import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from tidegauge.llm import part_codes as pc


def plain(rows, parts=8, entries=16, rounds=6):
    """All distances in every round, in Python integers: codes, errors and codebooks of usable rows."""
    kept = [(i, l, [float(x) for x in v]) for i, l, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    longest = max((len(v) for _, _, v in kept), default=0)
    length = -(-longest // parts)
    q = [[int(np.floor(x * 4096)) for x in v] + [0] * (parts * length - len(v)) for _, _, v in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, q[k]))[:entries]
    split = lambda v: [v[p * length : (p + 1) * length] for p in range(parts)]
    book = [[split(q[k])[p] for k in first] for p in range(parts)]
    x = [split(v) for v in q]
    near = lambda a, entries: min((sum((s - t) ** 2 for s, t in zip(a, e)), j) for j, e in enumerate(entries))
    for _ in range(rounds):
        sums = defaultdict(list)
        for v in x:
            for p in range(parts):
                sums[p, near(v[p], book[p])[1]].append(v[p])
        for (p, e), got in sums.items():
            book[p][e] = [sum(c) // len(got) for c in zip(*got)]
    out = []
    for (i, l, _), v in zip(kept, x):
        found = [near(v[p], book[p]) for p in range(parts)]
        out.append((i, l, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    sha = hashlib.sha256(",".join(str(c) for b in book for e in b for c in e).encode()).hexdigest()
    label = Counter()
    for _, l, _, error in out:
        label[l] += error
    return Counter((i, code, error, label[l], sha) for i, l, code, error in out)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>")


def made(n, width=64, seed=0, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (20, width))
    return [(i, int(i % 7), (centres[rng.integers(20)] + rng.normal(0, spread, width)).astype("f4").tolist()) for i in range(n)]


def got(df):
    return Counter(map(tuple, pc.with_label_error(*pc.compress(df)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_of_exhaustive_search(spark, seed):
    rows = made(300, seed=seed)
    np.random.default_rng(seed).shuffle(rows)
    assert got(frame(spark, rows)) == plain(rows)


def test_ties_and_repeats(spark):
    rng = np.random.default_rng(5)
    rows = [(i, None if i % 3 else 1, (rng.integers(-2, 3, 16) / 4096).tolist()) for i in range(200)]
    rows += rows[:20] + [(None, 2, [0.0] * 16), (3, 2, [0.5] * 16), (3, 2, [-0.5] * 16)]
    assert got(frame(spark, rows)) == plain(rows)


def test_unusable_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = made(40, 16) + [(90, 1, None), (91, 1, [0.1] * 15 + [None]), (92, 1, [nan] * 16), (93, None, [inf] + [0.0] * 15), (94, None, [-inf] * 16)]
    rows += [(95, None, []), (96, 3, [0.25] * 3), (97, 3, [-1e-9] * 16)]
    assert got(frame(spark, rows)) == plain(rows)
    clashing = frame(spark, rows).select("*", *[F.lit("own").alias(c) for c in ("parts", "code", "error", "entry", "upper", "vector", "of", "label_error")])
    assert got(clashing) == plain(rows)
    assert got(frame(spark, rows, "double")) == plain(rows)
    few = made(5, 8)
    assert got(frame(spark, few)) == plain(few)  # fewer vectors than entries
    assert got(frame(spark, [(1, 1, []), (2, None, [])])) == plain([(1, 1, []), (2, None, [])])
    for none in ([], [(1, 1, None), (2, 2, [nan])]):
        empty = pc.with_label_error(*pc.compress(frame(spark, none)))
        assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0


def test_huge_components_are_held(spark):
    rows = made(30, 8) + [(50, 0, [3e38] * 8), (51, 0, [-3e38] * 8)]
    found = pc.compress(frame(spark, rows))[0].collect()
    assert len(found) == 32 and all(r.error >= 0 for r in found)


def test_bounds_hold_and_spare_scans(spark):
    """Bounds from the rounds' stamps never cross the true distances, beat summed drifts, and most parts need no scan."""
    rows = made(2000, 32, seed=3, spread=0.2)
    x = np.floor(np.array([r[2] for r in rows]) * 4096).astype(np.int64).reshape(2000, 8, 4)
    state, book = pc.Assignment(x), np.ascontiguousarray(x[:16].transpose(1, 0, 2))
    history, scans, gain = pc.History((book,)), [], 0
    for _ in range(7):
        before = state.scanned
        state.update(history)
        scans.append(state.scanned - before)
        moved = history.displacement()
        steps = [np.sqrt(((b - a).astype(float) ** 2).sum(-1)) for a, b in zip(history.books, history.books[1:])]
        for p in range(8):
            d = np.sqrt(pc.squared(x[:, p], history.now[p]).astype(float))
            e = state.entry[:, p].astype(int)
            assert (e == pc.squared(x[:, p], history.now[p]).argmin(1)).all()
            own = d[np.arange(2000), e]
            assert (own <= (state.upper[:, p] + moved[state.upper_round[:, p], p, e]) * (1 + 1e-8)).all()
            d[np.arange(2000), e] = np.inf
            others = moved[:, p][state.lower_round[:, p]].copy()
            others[np.arange(2000), e] = 0
            assert (d.min(1) * (1 + 1e-8) >= state.lower[:, p] - others.max(1)).all()
            for s in range(len(history.books)):
                drift = sum((t[p] for t in steps[s:]), np.zeros(16))
                assert (moved[s, p] <= drift * (1 + 1e-8) + 1e-6).all()
                gain += (drift - moved[s, p]).sum()
        counts, totals = state.sums(16)
        book = history.now.copy()
        some = counts > 0
        book[some] = totals[some] // counts[some][:, None]
        history = pc.History((*history.books, book))
    assert gain > 0 and scans[0] == 16000 and scans[-1] < 4000, scans


def test_a_lost_round_is_made_anew(spark):
    """State of a round depends on the table and the codebooks alone: dropping what is kept changes nothing."""
    rows = made(200, 16, seed=9)
    whole = frame(spark, rows).select("vec_id", "label", pc.scaled(F.col("embedding"), 16).alias("parts"))
    first = np.array([r.parts for r in whole.orderBy("vec_id").limit(16).collect()]).reshape(16, 8, 2).transpose(1, 0, 2)
    history = pc.History((np.ascontiguousarray(first),))
    kept = pc.advanced(pc.begun(whole, 8, 2, "int"), history).persist(StorageLevel.MEMORY_AND_DISK)
    once = pc.refined(kept, history)
    kept.unpersist()
    assert (pc.refined(kept, history) == once).all()
