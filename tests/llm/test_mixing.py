import math

import pytest
from pyspark.sql import functions as F

from tests.llm.rows import documents, prose
from tidegauge.llm import mixing


def test_targets_share_by_weight_and_stop_at_the_cap():
    assert mixing.targets([100, 100], [3, 1]) == [150.0, 50.0]
    got = mixing.targets([10, 300, 300], [5, 2, 1])
    assert got[0] == 30 and sum(got) == pytest.approx(610) and got[1] == pytest.approx(2 * got[2])
    assert mixing.targets([0, 5], [5, 2]) == [0.0, 5.0]
    assert mixing.targets([], []) == []


def brute_force(sizes, target, cap=3):
    """The tilt that meets the target, by bisection."""
    mean = max(1.0, sum(sizes) / len(sizes))
    low, high = -200.0, 200.0
    for _ in range(300):
        t = (low + high) / 2
        if sum(n * min(cap, math.exp(min(t * n / mean, 700))) for n in sizes) < target:
            low = t
        else:
            high = t
    return low, mean


def test_rates_solve_the_dual(spark):
    rows = [(i, prose(i, 5 + 7 * (i % 40)), None, f"s{i % 4}", None) for i in range(400)]
    got = mixing.mix(documents(spark, rows)).collect()
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, abs=28)  # sizes lie 28 apart
        assert max(r.copies for r in own) <= 3
        tilt, mean = brute_force([r.size for r in own], own[0].target)
        by_size = {}
        for r in own:
            by_size.setdefault(r.size, []).append(r.copies)
        # rounding moves a size by one copy, repairs a few more
        off = sum(abs(sum(c) - len(c) * min(3, math.exp(tilt * n / mean))) for n, c in by_size.items())
        assert off <= len(by_size) + 20


def test_one_size_holds_most_rows(spark):
    rows = [(i, "same words here", None, "hot" if i % 3 else "cold", None) for i in range(3000)]
    got = mixing.mix(documents(spark, rows))
    sums = got.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target"), F.max("copies").alias("m")).collect()
    for r in sums:
        assert abs(r.t - r.target) <= 12 * 3 and r.m <= 3
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, mixing.mix(documents(spark, rows[::-1])).collect()))


def test_sources_in_code_point_order_null_last(spark):
    rows = [(i, "a b c d e f g h", None, s, None) for i, s in enumerate(["b", "B", None, "é", "b"] * 20)]
    got = {r.source: r.target / r.source_size for r in mixing.mix(documents(spark, rows)).withColumnRenamed("group_size", "source_size").collect()}
    # B, b, é, NULL weigh 5, 2, 1, 5; b has twice the words; B and NULL reach 3 times their size at most
    assert set(got) == {"B", "b", "é", None} and got["B"] == got[None]
    assert got["B"] == pytest.approx(min(3, 100 / 13 * 5 / 20))


def test_edge_rows(edge, none):
    got = mixing.mix(edge)
    assert got.count() == edge.count()
    assert got.where("taken > 3 * size or taken is null").count() == 0
    assert got.where("size = 0 and taken > 0").count() == 0
    assert mixing.mix(none).count() == 0
    kept = mixing.mixed_documents(edge)
    assert kept.columns == edge.columns
    assert kept.count() == got.agg(F.sum("copies")).first()[0]
    assert kept.where("copies <> 'own copies'").count() == 0
    assert mixing.mixed_documents(none).count() == 0
