"""Readers, writers, contract and decision history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.types import CONTRACT_SCHEMA, Contract


def read_window(
    spark: SparkSession,
    path: str,
    *,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Parquet or CSV by suffix, pruned and filtered before anything else happens."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix in (".parquet", ".pq"):
        df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    elif suffix == ".csv":
        reader = spark.read.option("header", True)
        df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    else:
        raise ValueError(f"unsupported format {suffix!r}: use .parquet, .pq or .csv")
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def wide_schema(header: Sequence[str], key: str = "Id", label: str = "Response") -> T.StructType:
    """Integral key, small label, everything else float."""
    kinds = {key: T.LongType(), label: T.ByteType()}
    return T.StructType([T.StructField(c, kinds.get(c, T.FloatType())) for c in header])


def read_wide_csv(
    spark: SparkSession,
    path: str,
    *,
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    key: str = "Id",
    label: str = "Response",
) -> DataFrame:
    """Typed wide CSV. The header is read once; rows are parsed in parallel splits."""
    header = spark.read.option("header", True).csv(path).columns
    df = spark.read.option("header", True).schema(wide_schema(header, key, label)).csv(path)
    df = df.select(*columns) if columns else df
    return df.limit(limit) if limit else df


def read_meta(spark: SparkSession, path: str, *, week: str = "week", **kw) -> DataFrame:
    df = read_window(spark, path, **kw)
    return df.withColumn(week, F.col(week).cast("int")) if week in df.columns else df


def read_features(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_window(spark, path, **kw)


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    order: Sequence[str] = (),
    partitions: int | None = None,
    row_group_bytes: int = 16 * 1024 * 1024,
    max_records: int = 5_000_000,
) -> None:
    """zstd parquet in small row groups, range-sorted so that min/max skipping works."""
    if order:
        keys = [F.col(c).asc_nulls_last() for c in order]
        df = (df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    (
        df.write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.block.size", row_group_bytes)
        .option("maxRecordsPerFile", max_records)
        .parquet(path)
    )


def write_results(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Result tables as CSV with a header, verdicts as JSON."""
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    elif fmt == "json":
        df.write.mode("overwrite").json(path)
    else:
        raise ValueError("results are csv or json")


# ---------------------------------------------------------------------------
def save_contract(spark: SparkSession, contract: Contract, path: str) -> None:
    row = asdict(contract)
    row["contexts"] = {k: {"first": v[0], "last": v[1]} for k, v in contract.contexts.items()}
    row["ranges"] = {k: {"lo": v[0], "hi": v[1]} for k, v in contract.ranges.items()}
    df = spark.createDataFrame([row], CONTRACT_SCHEMA)
    if not contract.created_at:
        df = df.withColumn("created_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    df = df.withColumn("lineage", F.map_concat("lineage", F.create_map(F.lit("spark"), F.lit(spark.version))))
    df.coalesce(1).write.mode("overwrite").json(path)


def load_contract(spark: SparkSession, path: str, fallback: str | None = None) -> Contract:
    """The contract at ``path``, or at ``fallback`` when there is none."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.schema(CONTRACT_SCHEMA).option("multiLine", True).json(path).first()
    except AnalysisException:
        row = None
    if row is None:
        if fallback is None:
            raise FileNotFoundError(f"no contract at {path}")
        return load_contract(spark, fallback)
    values = row.asDict(recursive=True)
    values["contexts"] = {k: (v["first"], v["last"]) for k, v in (values["contexts"] or {}).items()}
    values["ranges"] = {k: (v["lo"], v["hi"]) for k, v in (values["ranges"] or {}).items()}
    values["num"], values["cat"] = tuple(values["num"] or ()), tuple(values["cat"] or ())
    values["lineage"] = values["lineage"] or {}
    return Contract(**values)


# ---------------------------------------------------------------------------
def append_decisions(decisions: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append to the history, partitioned by monitor."""
    stamped = decisions.withColumn("recorded_at", F.current_timestamp())
    stamped.write.mode("append").partitionBy(*keys).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def last_decision(history: DataFrame, keys: Sequence[str], order: str, tie: str | None = None) -> DataFrame:
    """Latest row of each monitor: an aggregate, no sort."""
    rest = [c for c in history.columns if c not in keys]
    rank = F.struct(order, tie) if tie else F.col(order)
    return history.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("r")).select(*keys, "r.*")
