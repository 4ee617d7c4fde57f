"""The guard cascade against a step-by-step replay, in batch, resumed and streamed."""

import numpy as np
import pytest

from tidegauge.operators.policy import decide, guard_table
from tidegauge.operators.plant import detection_score
from tidegauge.plans.monitor import decide_next
from tidegauge.session import scratch_path
from tidegauge.types import GuardConfig

CONFIG = GuardConfig(floor=0.01, threshold=0.02, k=2, n=3, cooldown=4, contexts={"campaign": (11, 13)})
SCHEMA = (
    "monitor string, day bigint, n_rows bigint, n_drift bigint, effect_max double, worst_feature string, "
    "worst_fraction double, auc_global double, auc_segment double, gain double"
)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    out = []
    for m in ("m1", "m2", "m3"):
        for d in range(1, 41):
            pick = lambda p, v: v if rng.random() < p else None
            out.append(
                (
                    m, d, int(rng.choice([50, 500], p=[0.1, 0.9])), int(rng.choice([0, 1, 3], p=[0.2, 0.4, 0.4])),
                    pick(0.95, float(rng.choice([0.01, 0.05, 0.15, 0.5]))), "x", pick(0.2, float(rng.choice([0.05, 0.3]))),
                    pick(0.8, 0.8), pick(0.8, float(rng.choice([0.5, 0.6, 0.79]))), pick(0.4, float(rng.choice([0.0, 0.02]))),
                )
            )
    return out


def replay(rows, cfg, resets=None):
    """Window by window, as the rules are stated."""
    out, memory = {}, {}
    for m, d, n, drift, effect, _, worst, g, s, gain in rows:
        if resets and (m, d) in resets:
            memory.pop(m, None)
        alarms, causes, last = memory.get(m, ([], [], None))
        if n < cfg.min_obs:
            out[m, d] = (30, "undefined")
            continue
        both = g is not None and s is not None
        calm = drift <= 1 and (effect is None or effect < 10 * cfg.threshold)
        if worst is not None and worst > 0.10:
            cause = "pipeline"
        elif any(a <= d <= b for a, b in cfg.contexts.values()):
            cause = "business"
        elif both and max(s - 0.5, 0) / max(g - 0.5, 1e-6) < 0.35 and s < 0.55 and calm:
            cause = "hardware"
        elif drift > 0 and both and g - s < 0.05:
            cause = "business"
        else:
            cause = "model" if drift > 0 else "none"
        alarms, causes = [*alarms, drift > 0], [*causes, cause]
        code = 0
        if cause in ("hardware", "pipeline"):
            code = 20
        elif (
            drift > 0 and sum(alarms[-cfg.n :]) >= cfg.k and effect is not None and effect > cfg.floor_factor * cfg.floor
            and cause != "business" and not (cause == "model" and causes[-2:].count("model") < 2)
            and (gain is None or gain >= cfg.min_gain) and (last is None or d - last >= cfg.cooldown)
        ):
            code, last = 10, d
        memory[m] = (alarms, causes, last)
        out[m, d] = (code, cause)
    return out


def as_map(df):
    return {(r.monitor, r.day): (r.exit_code, r.cause) for r in df.collect()}


def test_cascade_matches_replay(spark, rows):
    got = as_map(decide(spark.createDataFrame(rows, SCHEMA), ["monitor"], "day", CONFIG))
    want = replay(rows, CONFIG)
    assert got == want
    assert {c for c, _ in want.values()} == {0, 10, 20, 30}


def test_reset_clears_one_monitor(spark, rows):
    resets = spark.createDataFrame([("m1", 20), ("m1", 30), ("m2", 9)], "monitor string, reset_at bigint")
    got = as_map(decide(spark.createDataFrame(rows, SCHEMA), ["monitor"], "day", CONFIG, resets=resets))
    assert got == replay(rows, CONFIG, {("m1", 20), ("m1", 30), ("m2", 9)})


@pytest.mark.parametrize("cut", [7, 22])
def test_resumed_decisions_equal_the_uninterrupted_run(spark, rows, cut):
    df = spark.createDataFrame(rows, SCHEMA)
    history = decide(df.where(f"day <= {cut}"), ["monitor"], "day", CONFIG)
    got = as_map(decide_next(df.where(f"day > {cut}"), history, ["monitor"], "day", CONFIG))
    want = {k: v for k, v in replay(rows, CONFIG).items() if k[1] > cut}
    assert got == want
    assert any(code == 10 for code, _ in got.values())


def test_only_reached_guards_are_reported(spark, rows):
    out = decide(spark.createDataFrame(rows, SCHEMA), ["monitor"], "day", CONFIG)
    for r in out.collect():
        keys = set(r.guards)
        if r.exit_code == 30:
            assert keys == {"measurable"} and r.guards["measurable"] is False and r.evidence is None
        elif r.reason in ("authorised", "cooldown", "shadow failed", "cause unconfirmed"):
            assert "cause_repeated" in keys
            assert ("challenger_gains" in keys) == (r.reason != "cause unconfirmed")
            assert ("cooled_down" in keys) or r.reason != "cooldown"
        else:
            assert keys == {"measurable", "lasting", "above_noise", "outside_context", "trainable_cause"}
    shown = guard_table(out, ["monitor"], "day")
    assert shown.where("result = 'BLOCK'").count() > 0 and shown.where("guard is null").count() == 0


def test_blocking_comes_before_the_alarm_test(spark):
    row = ("m", 1, 500, 0, 0.001, "pressure", 0.97, None, None, None)
    r = decide(spark.createDataFrame([row], SCHEMA), ["monitor"], "day", CONFIG).first()
    assert (r.exit_code, r.action, r.cause) == (20, "BLOCK", "pipeline")
    assert "pressure" in r.evidence.cause_evidence


def test_stream_equals_batch(spark, rows):
    from tidegauge.streaming.guards import guard_stream, state_store

    df = spark.createDataFrame(rows, SCHEMA)
    source, sink = scratch_path(spark, "in"), scratch_path(spark, "out")
    for a in (1, 8, 25):
        df.where(f"day between {a} and {({1: 7, 8: 24, 25: 40})[a]}").coalesce(1).write.mode("append").parquet(source)
    with state_store(spark):
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
        q = (
            guard_stream(stream, ["monitor"], "day", CONFIG).writeStream.format("parquet").option("path", sink)
            .option("checkpointLocation", sink + "_cp").trigger(availableNow=True).start()
        )
        q.awaitTermination()
    assert as_map(spark.read.parquet(sink)) == replay(rows, CONFIG)


def test_detection_score(spark):
    rows = [("m", d, 500, int(d >= 3), 0.5, "x", 0.9 if d >= 5 else None, None, None, None) for d in range(1, 7)]
    out = decide(spark.createDataFrame(rows, SCHEMA), ["monitor"], "day", CONFIG)
    events = spark.createDataFrame(
        [("quiet", 1, 2, False, 0), ("fault", 5, 6, True, 20)], "name string, start int, end int, must_alarm boolean, exit_code int"
    )
    got = {r.name: r for r in detection_score(out, "day", events).collect()}
    assert got["quiet"].alarm_right == 2 and got["quiet"].action_right == 2
    assert got["fault"].blocked == 2 and got["fault"].action_right == 2


