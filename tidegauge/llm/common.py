"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Sequence
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.session import materialise

__all__ = ["BLANKS", "as_text", "count_words", "give_back", "materialise", "number_within", "settle", "spare", "table", "uniform", "vocabulary"]

# The white space of every operator here: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies; the same place on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def give_back() -> None:
    """Return memory that this process has freed to the system; the allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def settle(keep: str | None = None) -> dict[str, Any]:
    """What this worker process keeps for tasks of the kind ``keep``; what other kinds left in it goes.

    Later stages run in the same worker processes, so that a cache of one stage would lie
    beside all that the others need.
    """
    held = sys.modules.setdefault("tidegauge_worker", ModuleType("tidegauge_worker")).__dict__.setdefault("held", {})
    for kind in held.keys() - {keep}:
        del held[kind]
    give_back()
    return {} if keep is None else held.setdefault(keep, {})


def spare(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_text(text: Column) -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(text, F.lit(""))


def count_words(text: Column) -> Column:
    """Number of words of a text (0 for NULL) without building an array of them.

    Each word, with the blanks behind it, shrinks to one letter; what is left of
    leading blanks goes, and the length of the rest is the count.
    """
    letters = F.regexp_replace(as_text(text), f"[^{BLANKS}]+[{BLANKS}]*", "w")
    return F.length(F.regexp_replace(letters, f"[{BLANKS}]+", "")).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the given values alone."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double")
    return (bits + 0.5) * (2.0**-53)


def number_within(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column, out: str) -> DataFrame:
    """Number the rows of each key without gaps from 0, never sorting a whole key in one task.

    ``bucket`` spreads a key over so many parts that each is small; the parts of a
    key are laid end to end by a running sum of their sizes. Keys must not be NULL.
    With about sqrt(n) buckets for n rows, no task holds more than a multiple of
    sqrt(n) rows, whatever share of all rows one key has.
    """
    dealt = rows.withColumn("_bucket", bucket)
    parts = [*keys, "_bucket"]
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*parts, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    placed = dealt.withColumn("_place", F.row_number().over(Window.partitionBy(*parts).orderBy(*order)) - 1)
    return placed.join(starts, parts).withColumn(out, F.col("_start") + F.col("_place")).drop("_bucket", "_start", "_place")
