"""Counts of all repetitions at once against the split taken repetition by repetition."""

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import stats
from tidegauge.operators import splits
from tidegauge.operators.cumulative import Cuts
from tidegauge.operators.distance import paired_effects


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(900).select(
        F.col("id").alias("key"), (F.hash("id") % 1000 / 7.0).alias("x"), F.round(F.rand(5) * 6).alias("few"),
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("c"), (F.col("id") % 4).cast("string"))).alias("c"),
    )
    odd = [(None, 3.0, 2.0, "c1"), (-5, float("nan"), None, None), (2**40, float("inf"), 1.0, "rare"), (7, None, None, "c2")]
    return df.unionByName(spark.createDataFrame(odd, "key long, x double, few double, c string")).cache()


@pytest.mark.parametrize("seed, fraction", [(0, 0.5), (3, 0.3)])
def test_words_hold_the_sides(spark, rows, seed, fraction):
    marked, words = splits.with_side_words(rows, "key", 70, fraction, seed)
    assert words == ["__w0", "__w1"] and marked.columns == [*rows.columns, *words]
    want = [stats.split_side("key", F.lit(r), fraction, seed).alias(f"s{r}") for r in range(70)]
    for r in marked.select(*words, *want).collect():
        for rep in range(70):
            assert (r[words[rep // 62]] >> (rep % 62)) & 1 == 1 - r[f"s{rep}"]


@pytest.mark.parametrize("cuts", [{}, {"x": [-40.0, -3.0, 11.0, 60.0], "few": [2.0]}])
def test_effects_of_each_repetition(rows, cuts):
    cut_points = {f: Cuts(cuts.get(f, ())) for f in ("x", "few")}
    how = dict(bins=10, splits=cut_points)
    got = splits.split_effects(rows, ("x", "few"), ("c",), "key", repetitions=9, fraction=0.4, seed=2, **how).collect()
    samples = rows.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(8)))).withColumn("side", stats.split_side("key", "rep", 0.4, 2))
    want = paired_effects(samples, ["rep"], ("x", "few"), ("c",), **how).collect()

    def table(found):
        return {(r.rep, r.feature, r.kind): (r.n0, r.n1, round(r.effect, 10)) for r in found}

    assert table(got) == table(want) and len(got) == 27


def test_shuffle_is_not_multiplied_by_repetitions(rows):
    """What leaves the first exchange is one row per distinct value, however many repetitions there are."""
    for repetitions in (2, 30):
        marked, words = splits.with_side_words(rows, "key", repetitions, 0.5, 0)
        long = splits.long_numeric(marked, ["x", "few"], words, splits={}).where(F.abs("value") < float("inf"))
        assert splits.vector_counts(long, ["feature", "bucket", "value"], repetitions).count() == long.select("feature", "value").distinct().count()


def test_too_few_rows_are_not_measured(rows):
    some = rows.where("key < 30")
    got = splits.split_effects(some, ("x",), (), "key", repetitions=3, fraction=0.5, seed=0, bins=10, splits={"x": Cuts()}).collect()
    assert all((r.effect is None) == (min(r.n0, r.n1) < 20) for r in got) and got
