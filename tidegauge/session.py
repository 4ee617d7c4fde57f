"""Shared-folder handling and small driver-side guards."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows of metadata (one per column, per bucket, per block ...) a driver-side
# read may return before it is treated as a programming error.
MAX_DRIVER_ROWS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Only a local session without that setting
    gets a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if configured:
            context.setCheckpointDir(configured)
        elif context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="tidegauge-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        current = context.getCheckpointDir()
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tidegauge-{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_rows(df: DataFrame, limit: int = MAX_DRIVER_ROWS) -> list:
    """Read a result that has one row per column, bin or block; never more than the bound, fail beyond it."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"expected at most {limit} metadata rows")
    return rows


def _sql_value(value, kind: str) -> str:
    if value is None:
        return f"cast(null as {kind})"
    if kind == "string":
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"
    if kind == "double":
        return f"double('{float(value)!r}')" if value != value or abs(value) == float("inf") else f"{float(value)!r}D"
    if kind == "boolean":
        return "true" if value else "false"
    if kind.startswith("array<"):
        inner = kind[6:-1]
        items = ", ".join(_sql_value(v, inner) for v in value)
        return f"array({items})" if items else f"cast(array() as {kind})"
    return f"cast({int(value)} as {kind})"


def metadata_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal table of metadata (one row per column, bin, block ...).

    Planned as constants, so no job and no Python process is needed to read it.
    """
    fields = [part.strip().split(" ", 1) for part in schema.split(",")]
    names = ", ".join(f"`{n}`" for n, _ in fields)
    if not rows:
        nulls = ", ".join(f"cast(null as {k}) as `{n}`" for n, k in fields)
        return spark.sql(f"SELECT {nulls} WHERE false")
    body = ", ".join(
        "(" + ", ".join(_sql_value(v, k) for v, (_, k) in zip(row, fields)) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
