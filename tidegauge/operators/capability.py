"""Process capability indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.clean import finite

MIN_CAPABILITY_ROWS = 30
CONFORMING_CPK = 1.33


def cpk(column: str, lsl: float, usl: float) -> Column:
    """Aggregate: distance of the mean to the nearer limit in three sample sigmas."""
    x = finite(column)
    mean, sd, n = F.avg(x), F.stddev_samp(x), F.count(x)
    return F.when((n >= MIN_CAPABILITY_ROWS) & (sd != 0), F.least((usl - mean) / (3 * sd), (mean - lsl) / (3 * sd)))


def ppm_out_of_spec(column: str, lsl: float, usl: float) -> Column:
    """Aggregate: parts per million outside the limits."""
    x = finite(column)
    out = F.when((x < lsl) | (x > usl), 1.0).when(x.isNotNull(), 0.0)
    return F.avg(out) * 1e6


def capability_table(df: DataFrame, column: str, lsl: float, usl: float, by: Sequence[str]) -> DataFrame:
    """``by, n, mean, cpk, ppm, conforming`` per scenario."""
    out = df.groupBy(*by).agg(
        F.count(finite(column)).alias("n"),
        F.avg(finite(column)).alias("mean"),
        cpk(column, lsl, usl).alias("cpk"),
        ppm_out_of_spec(column, lsl, usl).alias("ppm"),
    )
    return out.withColumn("conforming", F.coalesce(F.col("cpk") >= CONFORMING_CPK, F.lit(False)))
