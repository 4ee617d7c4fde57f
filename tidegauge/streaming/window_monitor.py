"""Continuous window monitor: the batch count schema, maintained by a stream.

The stream keeps only additive counts per axis unit (day), feature and slot (bin or
category). Sliding windows are sums over the appended counts, so late data and
window overlap cost no extra state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.clean import bisect_sql, literal, quoted
from tidegauge.operators.distance import CATEGORY_SCALE, psi_from_bins
from tidegauge.operators.profile import ReferenceProfile
from tidegauge.operators.windows import assign_windows
from tidegauge.types import MIN_VALUES, SlidingWindow

ROWS = "__rows"
MICROS_PER_DAY = 86_400_000_000


def utc_instant(df: DataFrame, time: str) -> Column:
    """The time column as an instant; zone-less times are taken as UTC."""
    c = F.col(quoted(time))
    if isinstance(df.schema[time].dataType, T.TimestampNTZType):
        return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {quoted(time)}))")
    return c.cast("timestamp")


def unit_count_stream(
    stream: DataFrame, profile: ReferenceProfile, time: str, *, origin_day: int, unit: str = "1 day", watermark: str = "1 day"
) -> DataFrame:
    """``day, feature, slot, n``, appended once the watermark closes a unit.

    ``origin_day`` is the days since 1970-01-01 of the axis value 0.
    """
    spec = profile.spec
    slots = [f"named_struct('feature', {literal(ROWS)}, 'slot', '')"]
    for f in spec.num:
        x = f"try_cast({quoted(f)} as double)"
        inner = list(profile.edges[f])[1:-1]
        slots.append(
            f"named_struct('feature', {literal(f)}, 'slot', CASE WHEN abs({x}) < double('Infinity') "
            f"THEN cast({bisect_sql(x, inner)} as string) END)"
        )
    for f in spec.cat:
        slots.append(f"named_struct('feature', {literal(f)}, 'slot', cast({quoted(f)} as string))")
    timed = stream.withColumn("__t", utc_instant(stream, time)).withWatermark("__t", watermark)
    long = timed.select("__t", F.expr(f"inline(array({', '.join(slots)}))")).where("slot is not null")
    counted = long.groupBy(F.window("__t", unit), "feature", "slot").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(_day("window.start", origin_day).alias("day"), "feature", "slot", "n")


def _day(start: str, origin_day: int) -> Column:
    return (F.floor(F.unix_micros(F.col(start)) / MICROS_PER_DAY) - origin_day).cast("bigint")


def run_available(counts: DataFrame, sink: str, checkpoint: str) -> None:
    """Process everything that is there into the exactly-once parquet sink, then stop."""
    query = (
        counts.writeStream.outputMode("append").format("parquet")
        .option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def open_units(spark: SparkSession, checkpoint: str, *, origin_day: int) -> DataFrame:
    """Counts of the units that the watermark has not closed yet, in the appended schema.

    Read from the stream's state. Once the input is finished, appended and open units
    together are all there is; while it runs, open units are preliminary.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        _day("key.window.start", origin_day).alias("day"), "key.feature", "key.slot", F.col("value.count").alias("n")
    )


def report_from_counts(counts: DataFrame, profile: ReferenceProfile, window: SlidingWindow) -> DataFrame:
    """``window, feature, kind, n_cur, effect, measurable, over`` from appended unit counts."""
    spec, spark = profile.spec, counts.sparkSession
    inside = counts.where((F.col(window.axis) > window.first - window.width) & (F.col(window.axis) <= window.last))
    summed = assign_windows(inside, window).groupBy("window", "feature", "slot").agg(F.sum("n").alias("n"))
    sizes = summed.where(F.col("feature") == ROWS).select("window", F.col("n").alias("n_cur"))
    bins = summed.where(F.col("feature").isin(*spec.num)).select("window", "feature", F.col("slot").cast("int").alias("bin"), "n")
    parts = []
    if spec.num:
        psi = psi_from_bins(bins, profile, ["window"])
        parts.append(psi.select("window", "feature", F.lit("num").alias("kind"), F.col("psi").alias("effect")))
    if spec.cat:
        cats = summed.where(F.col("feature").isin(*spec.cat)).withColumnRenamed("slot", "category")
        totals = cats.groupBy("window", "feature").agg(F.sum("n").alias("m"))
        sizes_ref = profile.feature_table(spark).where("kind = 'cat'").select("feature", "n_ref_valid")
        cells = (
            cats.join(totals, ["window", "feature"]).join(profile.category_counts, ["feature", "category"], "left")
            .join(F.broadcast(sizes_ref), "feature")
        )
        p, q = F.coalesce("n_ref", F.lit(0)) / F.col("n_ref_valid"), F.col("n") / F.col("m")
        mid = F.greatest((p + q) * 0.5, F.lit(1e-12))
        js = F.when(p > 0, p * F.log2(p / mid)).otherwise(0.0) + q * F.log2(q / mid)
        grouped = cells.groupBy("window", "feature").agg(
            F.sum(js).alias("js"), F.sum(p).alias("seen"), F.max("m").alias("m"), F.max("n_ref_valid").alias("r")
        )
        bounded = F.least(F.greatest(F.lit(0.5) * (F.col("js") + 1.0 - F.col("seen")), F.lit(0.0)), F.lit(1.0))
        parts.append(
            grouped.select(
                "window", "feature", F.lit("cat").alias("kind"),
                F.when((F.col("m") >= MIN_VALUES) & (F.col("r") >= MIN_VALUES), bounded * CATEGORY_SCALE).alias("effect"),
            )
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    measurable = (F.col("n_cur") >= spec.min_obs) & F.col("effect").isNotNull()
    return rows.join(sizes, "window").select(
        "window", "feature", "kind", "n_cur",
        F.when(measurable, F.col("effect")).alias("effect"),
        measurable.alias("measurable"),
        (measurable & (F.col("effect") > spec.threshold)).alias("over"),
    )


