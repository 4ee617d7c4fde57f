"""The retraining job and its pointer."""

import pytest
from pyspark.sql import functions as F

from tidegauge.plans import retrain as job
from tidegauge.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(1200).select("id", (F.rand(1) * 2 - 1).alias("x"), (F.rand(2) * 2 - 1).alias("noise"))
    return df.withColumn("y", (F.col("x") + (F.rand(3) - 0.5) * 0.4 > 0.5).cast("int")).cache()


def decisions(spark, *codes):
    names = {0: "NOTHING", 10: "RETRAIN", 20: "BLOCK", 30: "INSUFFICIENT"}
    return spark.createDataFrame([(i, names[c], c) for i, c in enumerate(codes)], "day long, action string, exit_code int")


def run(rows, history, registry, **how):
    how = {"num": ("x",), "holdout": rows.where("id >= 800")} | how
    return job.retrain(rows.where("id < 800"), how.pop("holdout"), history, registry, axis="day", label="y", **how).first()


def test_from_refusal_to_promotion(spark, rows):
    registry = scratch_path(spark, "registry")
    assert job.pointer(spark, registry) is None and job.attempts(spark, registry).count() == 0
    with pytest.raises(LookupError):
        job.score_published(rows, registry)
    none = run(rows, None, registry)
    assert (none.exit_code, none.outcome, none.version) == (20, "refused: no decision recorded", None)
    held = run(rows, decisions(spark, 10, 20), registry)  # the last one counts
    assert (held.exit_code, held.outcome, held.decided_action) == (20, "refused: not authorised", "BLOCK")
    assert job.pointer(spark, registry) is None
    first = run(rows, decisions(spark, 0, 10), registry, num=("noise",))
    assert (first.exit_code, first.version, first.champion_version, first.decided_at) == (0, 1, None, 1)
    thin = run(rows, decisions(spark, 10), registry, holdout=rows.where("id >= 800 and y = 0"))
    assert (thin.exit_code, thin.version) == (30, None)
    better = run(rows, decisions(spark, 10), registry)
    assert (better.exit_code, better.version, better.champion_version) == (0, 2, 1) and better.gain > 0.01
    same = run(rows, decisions(spark, 10), registry)
    assert (same.exit_code, same.outcome, same.version) == (0, "kept champion", None)
    forced = run(rows, decisions(spark, 20), registry, forced=True, min_gain=-1.0)
    assert (forced.exit_code, forced.version, forced.forced) == (0, 3, True)
    said = job.attempts(spark, registry).orderBy("attempted_at").collect()
    assert [r.exit_code for r in said] == [20, 20, 0, 30, 0, 0, 0] and [r.version for r in said if r.version] == [1, 2, 3]
    assert [r.forced for r in job.promotions(spark, registry).orderBy("version").collect()] == [False, False, True]
    scored = job.score_published(rows, registry)
    assert {r.model_version for r in scored.select("model_version").distinct().collect()} == {3} and scored.where("p between 0 and 1").count() == 1200


def test_a_version_without_a_pointer_is_not_seen(spark, rows):
    registry = scratch_path(spark, "registry")
    run(rows, decisions(spark, 10), registry)
    before = job.published(spark, registry)
    before.model.save(f"{registry}/versions/2-written-by-a-run-that-died")
    assert job.pointer(spark, registry)[0] == 1
    assert job.publish(spark, before.model, registry) == 2  # the next run takes the number again
    assert job.published(spark, registry).path != f"{registry}/versions/2-written-by-a-run-that-died"
