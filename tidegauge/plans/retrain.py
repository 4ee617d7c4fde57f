"""The retraining job: from a recorded decision to a published model.

A registry is a folder that all executors share. ``versions/<n>-<token>`` holds models,
each written once and never changed; ``attempts`` says what every run did; and
``promotions`` is the pointer: a table that only grows, one small file a promotion,
written after the model it names is complete. A file appears as a whole or not at all,
so a scorer sees the old version or the new one, never half of one, and a run that
dies leaves at most a version that nothing points to. The highest version counts;
of two runs that took the same number at once, the one with the larger token.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.model import TrainedModel, champion_challenger
from tidegauge.types import RETRAIN

PROMOTIONS = "version bigint, token string, gain double, forced boolean, decided_at bigint, promoted_at timestamp"
ATTEMPTS = (
    "exit_code int, outcome string, champion_ap double, challenger_ap double, gain double, forced boolean, "
    "champion_version bigint, version bigint, decided_at bigint, decided_action string, attempted_at timestamp"
)


@dataclass(frozen=True)
class Published:
    """A version that the pointer named."""

    version: int
    path: str
    model: TrainedModel


def _rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An append-only table that need not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def promotions(spark: SparkSession, registry: str) -> DataFrame:
    return _rows(spark, f"{registry}/promotions", PROMOTIONS)


def attempts(spark: SparkSession, registry: str) -> DataFrame:
    return _rows(spark, f"{registry}/attempts", ATTEMPTS)


def pointer(spark: SparkSession, registry: str) -> tuple[int, str] | None:
    """Version and path that the pointer names, NULL before the first promotion."""
    last = promotions(spark, registry).agg(F.max(F.struct("version", "token")).alias("p")).first()["p"]
    return None if last is None else (last["version"], f"{registry}/versions/{last['version']}-{last['token']}")


def published(spark: SparkSession, registry: str) -> Published | None:
    """The model that the pointer names now."""
    found = pointer(spark, registry)
    return None if found is None else Published(*found, TrainedModel.load(spark, found[1]))


def score_published(rows: DataFrame, registry: str, name: str = "p") -> DataFrame:
    """Add the published model's probability and ``model_version``; raises before the first promotion."""
    found = published(rows.sparkSession, registry)
    if found is None:
        raise LookupError(f"no model has been promoted in {registry}")
    return found.model.score(rows, name).withColumn("model_version", F.lit(found.version).cast("bigint"))


def publish(spark: SparkSession, model: TrainedModel, registry: str, *, gain: float | None = None, forced: bool = False, decided_at: int | None = None) -> int:
    """Write a model as the next version, then point to it."""
    found = pointer(spark, registry)
    version, token = (found[0] if found else 0) + 1, uuid.uuid4().hex
    model.save(f"{registry}/versions/{version}-{token}")
    row = spark.createDataFrame([(version, token, gain, forced, decided_at)], PROMOTIONS.rsplit(",", 1)[0])
    row.withColumn("promoted_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{registry}/promotions")
    return version


def retrain(
    train_rows: DataFrame,
    holdout: DataFrame,
    history: DataFrame | None,
    registry: str,
    *,
    axis: str,
    num: tuple[str, ...],
    cat: tuple[str, ...] = (),
    label: str,
    min_gain: float = 0.01,
    forced: bool = False,
) -> DataFrame:
    """Retrain if the last decision says so; one row, see ``ATTEMPTS``, which is recorded.

    ``history`` holds the decisions of one monitor. Without a decision, or after one other
    than RETRAIN, the run is refused (20) unless it is ``forced``, which is recorded. The
    challenger must beat the published model by ``min_gain`` of average precision on the
    held-out rows: then it is promoted (0), else the champion stays (0), and where either
    cannot be estimated the promotion is postponed (30). The first model has no rival.
    """
    spark = train_rows.sparkSession
    last = None
    if history is not None:
        last = history.agg(F.max_by(F.struct(F.col(axis).cast("bigint").alias("at"), "action", "exit_code"), axis).alias("d")).first()["d"]
    champion = published(spark, registry)
    authorised = last is not None and last["exit_code"] == RETRAIN
    audit, promoted = champion_challenger(
        train_rows, holdout, num=num, cat=cat, label=label, champion=champion.model if champion else None, min_gain=min_gain,
        authorised=authorised, forced=forced,
    )
    row = audit.first()
    version = None
    if promoted is not None:
        version = publish(spark, promoted, registry, gain=row["gain"], forced=row["forced"], decided_at=last["at"] if last else None)
    outcome = row["outcome"] if last is not None or authorised or forced else "refused: no decision recorded"
    said = (
        row["exit_code"], outcome, row["champion_ap"], row["challenger_ap"], row["gain"], row["forced"], champion.version if champion else None,
        version, last["at"] if last else None, last["action"] if last else None,
    )
    done = spark.createDataFrame([said], ATTEMPTS.rsplit(",", 1)[0]).withColumn("attempted_at", F.current_timestamp())
    done.coalesce(1).write.mode("append").parquet(f"{registry}/attempts")
    return done
