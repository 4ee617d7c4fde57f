"""Adaptive windows: exponential histograms against plain sums over the units, table against stream."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import metrics
from tidegauge.session import scratch_path
from tidegauge.streaming import adwin
from tidegauge.streaming.guards import state_store


def plain(units, delta, min_rows, scale):
    """Every border's cut from the raw units; sizes of buckets held as a list of unit numbers."""
    window, found = [], []  # each bucket is the list of its units
    for unit, numbers in units:
        window.append([numbers])
        size = 1
        while sum(len(b) == size for b in window) > adwin.BUCKETS:
            at = next(i for i, b in enumerate(window) if len(b) == size)
            window[at : at + 2] = [window[at] + window[at + 1]]
            size *= 2

        def cut():
            for border in range(1, len(window)):
                a, b = (np.array([x for bucket in part for x in bucket]).sum(0) for part in (window[:border], window[border:]))
                if a[0] < min_rows or b[0] < min_rows:
                    continue
                n, s, q = a + b
                variance = max(q / n - (s / n) ** 2, 0)
                term, inverse = np.log(2 * np.log(max(n, 3)) / delta), 1 / a[0] + 1 / b[0]
                if abs(a[1] / a[0] - b[1] / b[0]) > np.sqrt(2 * inverse * variance * term) + 2 / 3 * term * inverse * scale:
                    return True
            return False

        changed = False
        while len(window) > 1 and cut():
            del window[0]
            changed = True
        if changed:
            found.append(unit)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_as_plain_sums_say(seed):
    rng = np.random.default_rng(seed)
    level = np.repeat(rng.random(6), 60)
    units = []
    for u, p in enumerate(level):
        x = (rng.random(rng.integers(1, 12)) < p).astype(float)
        units.append((u, (len(x), x.sum(), (x * x).sum())))
    pdf = pd.DataFrame([(u, *x) for u, x in units], columns=["u", "n", "s", "q"]).sample(frac=1, random_state=seed)
    found = adwin.scan(pdf, "u", 0.01, 5, 1.0)
    assert found == plain(units, 0.01, 5, 1.0) and found
    # in parts, as micro-batches bring them
    histogram, parts = adwin.Histogram(), []
    for at in range(0, 360, 37):
        part = pd.DataFrame([(u, *x) for u, x in units[at : at + 37]], columns=["u", "n", "s", "q"])
        parts += histogram.run(part["u"], part["n"], part["s"], part["q"], 0.01, 5, 1.0)
        histogram = adwin.Histogram(histogram.sizes, histogram.n, histogram.s, histogram.q)
    assert parts == found


def test_few_buckets_hold_many_units():
    histogram = adwin.Histogram()
    for i in range(5000):
        histogram.append(1.0, float(i), float(i * i))
        assert sum(histogram.sizes) == i + 1 and sum(histogram.n) == i + 1
        assert len(histogram.sizes) <= adwin.BUCKETS * (i + 1).bit_length()
        assert histogram.sizes == sorted(histogram.sizes, reverse=True)
    assert sum(histogram.s) == sum(range(5000))


def scored(hours=240, per=30):
    """From hour 120 on scores of key 1 stay on their side of 0.5 but lose confidence; key 2 turns wrong at 170."""
    rng = np.random.default_rng(8)
    out = []
    for key in (0, 1, 2):
        for h in range(hours):
            y = rng.integers(0, 2, per)
            sure = 0.45 if not (key == 1 and h >= 120) else 0.02
            p = 0.5 + np.where(y == 1, sure, -sure) * rng.uniform(0.9, 1, per)
            if key == 2 and h >= 170:
                p = 1 - p
            out.append(pd.DataFrame(dict(seg=key, hour=h, y=y, p=p)))
    return pd.concat(out)


def test_stream_finds_what_the_table_shows(spark):
    signals = {"error": (((F.col("p") >= 0.5) != (F.col("y") == 1)).cast("double"), 1.0), "logloss": (metrics.log_loss_signal(), 16.2)}
    rows = spark.createDataFrame(scored()).withColumn("ts", F.timestamp_seconds(F.col("hour") * 3600 + 10))
    table = adwin.signal_changes(rows, ["seg"], "hour", signals).collect()
    hits = {}
    for r in table:
        hits.setdefault((r.seg, r.signal), []).append(r.hour)
    hits = {k: sorted(v) for k, v in hits.items()}
    assert not [k for k in hits if k[0] == 0]
    assert (1, "error") not in hits and 120 <= hits[1, "logloss"][0] <= 130  # only the continuous signal sees it
    assert 170 <= hits[2, "error"][0] <= 175 and 170 <= hits[2, "logloss"][0] <= 175
    source, sink = scratch_path(spark, "sent"), scratch_path(spark, "changes")
    for at in range(0, 240, 80):
        rows.where(F.col("hour").between(at, at + 79)).drop("hour").coalesce(1).write.mode("append").parquet(source)
    rows.limit(1).select("seg", F.lit(None).cast("bigint").alias("y"), F.lit(None).cast("double").alias("p"), F.timestamp_seconds(F.lit(400 * 3600)).alias("ts")).coalesce(1).write.mode("append").parquet(source)
    with state_store(spark, partitions=2):
        stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
        q = (
            adwin.change_stream(stream, ["seg"], "ts", signals).writeStream.outputMode("append").format("parquet").option("path", sink)
            .option("checkpointLocation", sink + "_cp").trigger(availableNow=True).start()
        )
        q.awaitTermination()
    streamed = spark.read.schema("seg bigint, signal string, hour bigint").parquet(sink).collect()
    assert sorted(map(tuple, streamed)) == sorted((r.seg, r.signal, r.hour) for r in table)
