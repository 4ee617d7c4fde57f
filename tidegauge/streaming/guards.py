"""The guard cascade as a stream: one state per monitor, kept across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidegauge.operators.policy import diagnose
from tidegauge.types import (
    BLOCK,
    BLOCKING_CAUSES,
    CAUSE_BUSINESS,
    CAUSE_MODEL,
    CAUSE_UNDEFINED,
    INSUFFICIENT,
    NOTHING,
    RETRAIN,
    GuardConfig,
)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTITIONS = "spark.sql.shuffle.partitions"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_store(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Custom state needs the RocksDB provider; restore the session's choices after.

    ``partitions`` fixes the number of state partitions, which should follow the
    number of monitors rather than the size of the batch shuffles.
    """
    wanted = {PROVIDER: ROCKSDB} | ({PARTITIONS: str(partitions)} if partitions else {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


class GuardProcessor(StatefulProcessor):
    """State: the last alarms, the last causes, the last retraining."""

    def __init__(self, config: GuardConfig, axis: str, keys: Sequence[str]):
        self.config, self.axis, self.keys = config, axis, list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = handle.getValueState("memory", "alarms array<boolean>, causes array<string>, last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        # the windows one monitor closed in this micro-batch
        batch = pd.concat(list(rows)).sort_values(self.axis)
        alarms, causes, last = [], [], None
        if self.memory.exists():
            a, c, last = self.memory.get()
            alarms, causes = list(a), list(c)
        out = []
        for r in batch.itertuples():
            code, cause, reason = INSUFFICIENT, CAUSE_UNDEFINED, "window too small to be judged"
            if r.n_rows >= self.config.min_obs:
                alarms = [*alarms, bool(r.n_drift > 0)][-self.config.n :]
                causes = [*causes, r.cause][-self.config.cause_confirmations :]
                cause = r.cause
                code, reason, last = self.step(r, alarms, causes, last)
            out.append((*key, int(getattr(r, self.axis)), code, cause, reason))
        self.memory.update((alarms, causes, last))
        yield pd.DataFrame(out, columns=[*self.keys, self.axis, "exit_code", "cause", "reason"])

    def step(self, r, alarms: list, causes: list, last: int | None) -> tuple[int, str, int | None]:
        cfg = self.config
        axis = int(getattr(r, self.axis))
        if r.cause in BLOCKING_CAUSES:
            return BLOCK, "blocked", last
        if not r.n_drift > 0:
            return NOTHING, "no alarm", last
        if sum(alarms) < cfg.k:
            return NOTHING, "not persistent", last
        if pd.isna(r.effect_max) or not cfg.floor_factor * cfg.floor < r.effect_max < float("inf"):
            return NOTHING, "below floor", last
        if r.cause == CAUSE_BUSINESS:
            return NOTHING, "known context", last
        if r.cause == CAUSE_MODEL and causes.count(CAUSE_MODEL) < cfg.cause_confirmations:
            return NOTHING, "cause unconfirmed", last
        if not pd.isna(r.gain) and r.gain < cfg.min_gain:
            return NOTHING, "shadow failed", last
        if last is not None and axis - last < cfg.cooldown:
            return NOTHING, "cooldown", last
        return RETRAIN, "authorised", axis

    def close(self) -> None:
        pass


def guard_stream(evidence: DataFrame, keys: Sequence[str], axis: str, config: GuardConfig) -> DataFrame:
    """``keys, axis, exit_code, cause, reason`` for each evidence row of the stream."""
    fields = {f.name: f.dataType.simpleString() for f in evidence.schema}
    schema = ", ".join(f"{k} {fields[k]}" for k in keys) + f", {axis} bigint, exit_code int, cause string, reason string"
    needed = [*keys, axis, "n_rows", "n_drift", "effect_max", "gain", "cause"]
    rows = diagnose(evidence, axis, config).select(*needed).withColumn(axis, F.col(axis).cast("bigint"))
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=GuardProcessor(config, axis, keys), outputStructType=schema, outputMode="Append", timeMode="None"
    )
