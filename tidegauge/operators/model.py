"""The monitored model: a balanced logistic regression as a Spark ML pipeline."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.clean import finite, quoted
from tidegauge.operators.metrics import performance
from tidegauge.session import scratch_path
from tidegauge.types import BLOCK, INSUFFICIENT, NOTHING

MEDIAN_ACCURACY = 10_000


@dataclass(frozen=True)
class TrainedModel:
    num: tuple[str, ...]
    cat: tuple[str, ...]
    medians: dict[str, float]
    modes: dict[str, str]
    indicators: tuple[str, ...]
    pipeline: PipelineModel

    def prepared(self, df: DataFrame) -> DataFrame:
        """Impute, and flag the columns that had missing values in training."""
        out = df
        numbers = {f: finite(quoted(f)) for f in self.num}
        new = {f"__num_{i}": F.coalesce(numbers[f], F.lit(self.medians[f])) for i, f in enumerate(self.num)}
        new |= {f"__miss_{i}": F.when(numbers[f].isNull(), 1.0).otherwise(0.0) for i, f in enumerate(self.indicators)}
        new |= {
            f"__cat_{i}": F.coalesce(F.col(quoted(f)).cast("string"), F.lit(self.modes[f])) for i, f in enumerate(self.cat)
        }
        return out.withColumns(new)

    def score(self, df: DataFrame, name: str = "p") -> DataFrame:
        """Add the probability of the positive class."""
        scored = self.pipeline.transform(self.prepared(df))
        return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        head = {
            "num": self.num, "cat": self.cat, "medians": self.medians, "modes": self.modes, "indicators": self.indicators,
        }
        spark.createDataFrame([(json.dumps(head),)], "head string").coalesce(1).write.mode("overwrite").text(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TrainedModel:
        head = json.loads(spark.read.text(f"{path}/head", wholetext=True).first()[0])
        return TrainedModel(
            tuple(head["num"]), tuple(head["cat"]), head["medians"], head["modes"], tuple(head["indicators"]),
            PipelineModel.load(f"{path}/pipeline"),
        )


def train(
    reference: DataFrame,
    *,
    num: Sequence[str],
    cat: Sequence[str] = (),
    label: str,
    C: float = 1.0,  # noqa: N803
    max_iter: int = 2000,
) -> TrainedModel:
    """Median/mode imputation, scaling, one-hot, balanced logistic regression."""
    labelled = reference.where(F.col(label).isNotNull())
    row = labelled.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label).cast("int") == 1).alias("pos"),
        *[F.approx_percentile(finite(quoted(f)), 0.5, MEDIAN_ACCURACY).alias(f"m{i}") for i, f in enumerate(num)],
        *[F.count_if(finite(quoted(f)).isNull()).alias(f"x{i}") for i, f in enumerate(num)],
    ).first()
    n, pos = row["n"], row["pos"]
    if pos == 0 or pos == n:
        raise ValueError(f"the reference holds one class only (n={n}, positives={pos})")
    modes = {}
    for f in cat:
        # one small aggregate per categorical column; ties go to the smallest name
        best = (
            labelled.where(F.col(quoted(f)).isNotNull()).groupBy(F.col(quoted(f)).cast("string").alias("c"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "c").first()
        )
        modes[f] = best["c"] if best else ""
    medians = {f: float(row[f"m{i}"]) if row[f"m{i}"] is not None else 0.0 for i, f in enumerate(num)}
    indicators = tuple(f for i, f in enumerate(num) if row[f"x{i}"] > 0)
    shell = TrainedModel(tuple(num), tuple(cat), medians, modes, indicators, None)  # type: ignore[arg-type]

    weight = F.when(F.col(label).cast("int") == 1, n / (2.0 * pos)).otherwise(n / (2.0 * (n - pos)))
    data = shell.prepared(labelled).withColumn("__w", weight).withColumn("__y", F.col(label).cast("double"))
    raw = [f"__num_{i}" for i in range(len(num))] + [f"__miss_{i}" for i in range(len(indicators))]
    stages: list = []
    parts = []
    if raw:
        stages += [
            VectorAssembler(inputCols=raw, outputCol="__raw"),
            StandardScaler(inputCol="__raw", outputCol="__scaled", withMean=True, withStd=True),
        ]
        parts.append("__scaled")
    for i in range(len(cat)):
        # 'keep' adds a slot for unseen categories; dropping the last slot zeroes it
        stages += [
            StringIndexer(inputCol=f"__cat_{i}", outputCol=f"__idx_{i}", handleInvalid="keep"),
            OneHotEncoder(inputCol=f"__idx_{i}", outputCol=f"__hot_{i}", dropLast=True),
        ]
        parts.append(f"__hot_{i}")
    stages += [
        VectorAssembler(inputCols=parts, outputCol="__features"),
        LogisticRegression(
            featuresCol="__features", labelCol="__y", weightCol="__w", regParam=1.0 / (C * n), elasticNetParam=0.0,
            standardization=False, maxIter=max_iter,
        ),
    ]
    fitted = Pipeline(stages=stages).fit(data)
    return TrainedModel(tuple(num), tuple(cat), medians, modes, indicators, fitted)


def champion_challenger(
    train_rows: DataFrame,
    holdout: DataFrame,
    *,
    num: Sequence[str],
    cat: Sequence[str] = (),
    label: str,
    champion: TrainedModel | None,
    min_gain: float = 0.01,
    authorised: bool = True,
    forced: bool = False,
) -> tuple[DataFrame, TrainedModel | None]:
    """Train a challenger and promote it if it beats the champion on held-out rows.

    Returns an audit row ``exit_code, outcome, champion_ap, challenger_ap, gain,
    forced`` and the promoted model, if any. ``forced`` overrides a missing
    authorisation and is recorded. The comparison uses rows later than the training
    rows, not the training rows themselves.
    """
    spark = train_rows.sparkSession
    schema = "exit_code int, outcome string, champion_ap double, challenger_ap double, gain double, forced boolean"
    if not authorised and not forced:
        return spark.createDataFrame([(BLOCK, "refused: not authorised", None, None, None, False)], schema), None
    challenger = train(train_rows, num=num, cat=cat, label=label)
    if champion is None:
        return spark.createDataFrame([(NOTHING, "promoted: no champion", None, None, None, forced)], schema), challenger

    def average_precision(model: TrainedModel) -> float | None:
        # performance reads the scores several times: rows are scored once, and kept as two columns
        path = scratch_path(spark, "scored")
        model.score(holdout).select(F.col(label).cast("int").alias("y"), "p").write.parquet(path)
        return performance(spark.read.parquet(path), label="y", score="p").first()["pr_auc"]

    new, old = average_precision(challenger), average_precision(champion)
    if new is None or old is None:
        return spark.createDataFrame([(INSUFFICIENT, "postponed: not estimable", old, new, None, forced)], schema), None
    gain = new - old
    if gain < min_gain:
        return spark.createDataFrame([(NOTHING, "kept champion", old, new, gain, forced)], schema), None
    return spark.createDataFrame([(NOTHING, "promoted", old, new, gain, forced)], schema), challenger
