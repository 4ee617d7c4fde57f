"""Wide manufacturing tables: topology, time axis, presence, feature selection."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.clean import finite, number, quoted
from tidegauge.operators.joins import join_one_to_one
from tidegauge.session import materialise

# fixed values: column-name pattern and time unit (hundredths of a week)
COLUMN_PATTERN = r"^L(\d+)_S(\d+)_[FD](\d+)$"
TIME_UNIT_WEEKS = 0.01
MIN_COVERAGE = 0.05
MIN_VARIANCE = 1e-12
MIN_VALID_FOR_VARIANCE = 100
PER_STATION = 6
TARGET_FEATURES = 160
COLUMNS_AT_ONCE = 128  # columns of one profile aggregate


def topology(features: DataFrame, name: str = "feature") -> DataFrame:
    """Line, station and number encoded in each column name; other names drop out."""
    part = lambda i: F.regexp_extract(name, COLUMN_PATTERN, i)
    return features.where(F.col(name).rlike(COLUMN_PATTERN)).select(
        name,
        part(1).cast("int").alias("line"),
        part(2).cast("int").alias("station_no"),
        part(3).cast("int").alias("number"),
        F.concat(F.lit("L"), part(1), F.lit("_S"), part(2)).alias("station"),
    )


def stations_of(columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns per station, from the header alone."""
    import re

    out: dict[str, list[str]] = defaultdict(list)
    for c in columns:
        m = re.match(COLUMN_PATTERN, c)
        if m:
            out[f"L{m[1]}_S{m[2]}"].append(c)
    return dict(sorted(out.items()))


def first_of(columns: Sequence[str]) -> Column:
    xs = [number(quoted(c)) for c in columns]
    return F.least(*xs) if len(xs) > 1 else xs[0]


def last_of(columns: Sequence[str]) -> Column:
    xs = [number(quoted(c)) for c in columns]
    return F.greatest(*xs) if len(xs) > 1 else xs[0]


def present(columns: Sequence[str]) -> Column:
    """Did the row visit the station: any of its columns is there."""
    return F.coalesce(*[number(quoted(c)) for c in columns]).isNotNull()


def week_of(t: Column | str) -> Column:
    """Whole week of a time in hundredths of a week; -1 when undated."""
    t = F.col(t) if isinstance(t, str) else t
    weeks = F.floor(t.cast("float") * F.lit(TIME_UNIT_WEEKS).cast("float"))
    return F.coalesce(weeks, F.lit(-1)).cast("int")


def fortnight_of(week: Column | str) -> Column:
    """Floor halves, so that -1 stays -1."""
    w = F.col(week) if isinstance(week, str) else week
    return F.floor(w / 2).cast("int")


def time_axis(dates: DataFrame, labels: DataFrame, key: str = "Id", label: str = "Response") -> DataFrame:
    """One row per part: first and last time, presence per station, label, week.

    Each row reduces to ~130 numbers without a shuffle; only the label join moves data.
    """
    columns = [c for c in dates.columns if c != key]
    stations = stations_of(columns)
    flags = {f"vis_{s}": present(cs) for s, cs in stations.items()}
    rows = dates.select(
        F.col(key).cast("bigint").alias(key),
        first_of(columns).cast("float").alias("t_min"),
        last_of(columns).cast("float").alias("t_max"),
        *[f.cast("tinyint").alias(n) for n, f in flags.items()],
    )
    counted = rows.withColumn("n_stations", F.expr(" + ".join(f"cast({quoted(n)} as int)" for n in flags) or "0").cast("smallint"))
    joined = join_one_to_one(counted, labels.select(F.col(key).cast("bigint").alias(key), label), [key], "left")
    return (
        joined.withColumn("duration", F.col("t_max") - F.col("t_min"))
        .withColumn("week", week_of("t_min"))
        .withColumn("fortnight", fortnight_of("week"))
    )


def in_time_order(meta: DataFrame, key: str = "Id") -> DataFrame:
    """Undated parts last, the key breaking ties; a range sort, spread over tasks."""
    return meta.orderBy(F.col("t_min").asc_nulls_last(), F.col(key))


def numbered_in_time_order(meta: DataFrame, key: str = "Id", out: str = "place") -> DataFrame:
    """All parts with their place from 1 on, in the order of ``in_time_order``.

    Ranges of the order are numbered by themselves and laid end to end by their sizes,
    so that no task sorts more than a range.
    """
    order = [F.col("t_min").asc_nulls_last(), F.col(key)]
    # kept, since ranges come from a sample and must not be cut anew
    ranged = materialise(meta.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = ranged.withColumn("_nth", nth).join(F.broadcast(starts), "_range")
    return placed.withColumn(out, F.col("_start") + F.col("_nth")).drop("_range", "_start", "_nth")


def feature_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, n_valid, coverage, variance``: counts and variances as plain aggregates.

    Columns are aggregated in chunks, each of which reads its own columns only, so a
    columnar table is read once whatever its width.
    """

    def chunk(names: Sequence[str]) -> DataFrame:
        figures = F.array(
            *[F.struct(F.lit(f).alias("feature"), F.count(finite(quoted(f))).alias("n"), F.var_pop(finite(quoted(f))).alias("v")) for f in names]
        )
        return df.agg(F.count(F.lit(1)).alias("n_total"), figures.alias("p")).select("n_total", F.inline("p"))

    names = list(features)
    out = chunk(names[:COLUMNS_AT_ONCE])
    for at in range(COLUMNS_AT_ONCE, len(names), COLUMNS_AT_ONCE):
        out = out.unionAll(chunk(names[at : at + COLUMNS_AT_ONCE]))
    return out.select(
        "feature",
        F.col("n").alias("n_valid"),
        F.when(F.col("n_total") > 0, F.col("n") / F.col("n_total")).otherwise(0.0).alias("coverage"),
        F.when(F.col("n") > MIN_VALID_FOR_VARIANCE, F.col("v")).otherwise(0.0).alias("variance"),
    )


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= k).drop("__rank")


def select_features(
    profile: DataFrame, *, target: int = TARGET_FEATURES, per_station: int = PER_STATION
) -> DataFrame:
    """Diverse choice: a few columns per station, then fill up by coverage and variance.

    The profile has one row per column, so ranking it is a metadata-sized job.
    """
    eligible = profile.where((F.col("coverage") >= MIN_COVERAGE) & (F.col("variance") > MIN_VARIANCE))
    placed = eligible.join(topology(profile.select("feature")).select("feature", "station"), "feature", "left")
    order = [F.col("coverage").desc(), F.col("variance").desc(), F.col("feature").asc()]
    in_quota = F.col("station").isNotNull() & (
        F.row_number().over(Window.partitionBy("station").orderBy(*order)) <= per_station
    )
    ranked = placed.withColumn("quota", in_quota).withColumn(
        "position", F.row_number().over(Window.orderBy(F.col("quota").desc(), *order))
    )
    return ranked.where(F.col("position") <= target).select("feature", "station", "coverage", "variance", "quota")


def load_selected(df: DataFrame, key: str, features: Sequence[str], label: str) -> DataFrame:
    """Second pass: only the chosen columns reach the scan."""
    return df.select(
        F.col(key).cast("bigint").alias(key), *[finite(quoted(f)).cast("float").alias(f) for f in features], label
    )


def weekly_rates(meta: DataFrame, week: str, label: str, stations: str) -> DataFrame:
    """``week, n, rate, mean_stations`` of each period."""
    return meta.groupBy(week).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(label).cast("double")).alias("rate"),
        F.avg(F.col(stations).cast("double")).alias("mean_stations"),
    )
