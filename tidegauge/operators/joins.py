"""Validated equi-joins, membership and key-set checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on group keys, which are never NULL (see :func:`known_groups`)."""
    return left.join(right, list(keys), how)


def known_groups(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows that belong to a group: a NULL segment is not a segment."""
    for b in by:
        df = df.where(F.col(b).isNotNull())
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def join_one_to_one(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join that refuses duplicate keys on either side.

    Each side counts its key over the partitioning and order that the join needs
    anyway, and a filter raises on a duplicate while the query runs. A filter stays
    whatever columns are read later, be it only a count.
    """
    if how not in ("left", "inner"):
        raise ValueError("one-to-one joins are 'left' or 'inner'")

    def checked(df: DataFrame, side: str, mark: str) -> DataFrame:
        n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        refused = F.raise_error(F.lit(f"duplicate key on the {side} side")).cast("boolean")
        return df.withColumn("__n", n).withColumn(mark, F.when(F.col("__n") == 1, F.lit(True)).otherwise(refused)).where(mark).drop("__n")

    joined = checked(left, "left", "__left").join(checked(right, "right", "__right"), list(keys), how)
    # asks for the right side even where nothing of it is read and its rows could not matter
    return joined.where(F.coalesce("__right", F.lit(True))).drop("__left", "__right")


def key_set_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present on one side only, labelled ``side``."""
    sides = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    seen = sides.groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return seen.where("l + r = 1").select(
        *keys, F.when(F.col("l") == 1, "left").otherwise("right").alias("side")
    )


def members(df: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(kept.select(*keys), list(keys), "left_semi")


def non_members(df: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(kept.select(*keys), list(keys), "left_anti")


def suffixed_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes: tuple[str, str]
) -> DataFrame:
    """Inner join of two result tables; every non-key column takes its side's suffix."""

    def side(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*[F.col(c) if c in keys else F.col(c).alias(c + suffix) for c in df.columns])

    return side(left, suffixes[0]).join(side(right, suffixes[1]), list(keys))
