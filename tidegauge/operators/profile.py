"""The frozen reference profile.

Everything later measurements need from the reference: bin edges and counts,
category counts and value counts. It is taken once; windows never touch the
reference rows again.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from math import log

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.clean import long_categorical, long_numeric, number, quoted
from tidegauge.operators.cumulative import ROWS_PER_BUCKET, Cuts, reference_edges, sketch_with
from tidegauge.session import metadata_table, small_rows
from tidegauge.types import PSI_EPS, MonitorSpec


@dataclass(frozen=True)
class NumericProfile:
    n_valid: int
    n_finite: int
    edges: tuple[float, ...]
    bin_counts: tuple[int, ...]
    splits: tuple[float, ...]
    subdivision: int = 1

    @property
    def usable(self) -> bool:
        return len(self.edges) >= 3


@dataclass(frozen=True)
class ReferenceProfile:
    spec: MonitorSpec
    n_rows: int
    numeric: dict[str, NumericProfile]
    cat_valid: dict[str, int]
    cat_support: dict[str, int]
    value_counts: DataFrame
    category_counts: DataFrame

    @property
    def edges(self) -> dict[str, tuple[float, ...]]:
        return {f: p.edges for f, p in self.numeric.items()}

    @property
    def sizes(self) -> dict[str, tuple[int, Cuts]]:
        """Row counts and cut points, as the sketch of the reference gave them."""
        out = {}
        for f, p in self.numeric.items():
            cuts = Cuts(p.splits)
            cuts.sub = p.subdivision
            out[f] = (p.n_finite, cuts)
        return out

    def but(self, **changes) -> ReferenceProfile:
        """Same reference, other thresholds (features and bins stay)."""
        from dataclasses import replace

        if set(changes) & {"num", "cat", "bins"}:
            raise ValueError("features and bins are part of the profile; take a new one")
        return replace(self, spec=self.spec.but(**changes))

    def feature_table(self, spark: SparkSession) -> DataFrame:
        """One row per monitored feature, in the caller's order."""
        rows = []
        for f in self.spec.num:
            p = self.numeric[f]
            # what an empty window bin contributes, summed over all bins
            absent = sum(absent_term(c, p.n_finite) for c in p.bin_counts) if p.usable else None
            rows.append((f, "num", p.n_valid, p.n_finite, p.usable, absent, None))
        for f in self.spec.cat:
            rows.append((f, "cat", self.cat_valid[f], None, True, None, self.cat_support[f]))
        return metadata_table(
            spark,
            rows,
            "feature string, kind string, n_ref_valid bigint, n_ref_finite bigint, usable boolean, "
            "absent double, support bigint",
        )

    def bin_table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (f, b, c, p.n_finite, absent_term(c, p.n_finite))
            for f, p in self.numeric.items()
            if p.usable
            for b, c in enumerate(p.bin_counts)
        ]
        return metadata_table(
            spark, rows, "feature string, bin int, n_ref_bin bigint, n_ref_finite_bin bigint, absent_bin double"
        )

    def save(self, path: str) -> None:
        """Persist as two parquet tables and one JSON row."""
        spark = self.value_counts.sparkSession
        self.value_counts.write.mode("overwrite").partitionBy("feature").parquet(f"{path}/values")
        self.category_counts.write.mode("overwrite").partitionBy("feature").parquet(f"{path}/categories")
        head = {
            "spec": {**asdict(self.spec), "ranges": {k: list(v) for k, v in self.spec.ranges.items()}},
            "n_rows": self.n_rows,
            "numeric": {f: asdict(p) for f, p in self.numeric.items()},
            "cat_valid": self.cat_valid,
            "cat_support": self.cat_support,
        }
        spark.createDataFrame([(json.dumps(head),)], "profile string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ReferenceProfile:
        head = json.loads(spark.read.text(f"{path}/head", wholetext=True).first()[0])
        spec = head["spec"]
        spec["ranges"] = {k: tuple(v) for k, v in spec["ranges"].items()}
        return ReferenceProfile(
            spec=MonitorSpec(**spec),
            n_rows=head["n_rows"],
            numeric={
                f: NumericProfile(
                    p["n_valid"], p["n_finite"], tuple(p["edges"]), tuple(p["bin_counts"]), tuple(p["splits"]),
                    p["subdivision"],
                )
                for f, p in head["numeric"].items()
            },
            cat_valid=head["cat_valid"],
            cat_support=head["cat_support"],
            value_counts=spark.read.schema("value double, n_ref long, feature string").parquet(f"{path}/values"),
            category_counts=spark.read.schema("category string, n_ref long, feature string").parquet(
                f"{path}/categories"
            ),
        )


def absent_term(count: int, total: int) -> float:
    """PSI contribution of a bin the window leaves empty."""
    p = max(count / total, PSI_EPS)
    return (PSI_EPS - p) * log(PSI_EPS / p)


def build_profile(
    reference: DataFrame, spec: MonitorSpec, *, rows_per_bucket: int = ROWS_PER_BUCKET
) -> ReferenceProfile:
    """Measure the reference once.

    Driver-side results are bounded by the number of features times the number of
    bins or cut points; value and category counts stay distributed tables.
    """
    missing = [c for c in (*spec.num, *spec.cat) if c not in reference.columns]
    if missing:
        raise KeyError(f"features absent from the reference: {missing}")

    sizes, rows = sketch_with(
        reference,
        spec.num,
        [
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count(number(quoted(f))).alias(f"valid{i}") for i, f in enumerate(spec.num)],
            *[F.count(F.col(quoted(f))).alias(f"cat{i}") for i, f in enumerate(spec.cat)],
        ],
        rows_per_bucket=rows_per_bucket,
    )
    edges = reference_edges(reference, spec.num, bins=spec.bins, sizes=sizes)

    numeric = {}
    for i, f in enumerate(spec.num):
        e, per_bin = edges.get(f, ([], []))
        numeric[f] = NumericProfile(
            n_valid=rows[f"valid{i}"],
            n_finite=sizes[f][0],
            edges=tuple(e),
            bin_counts=tuple(per_bin),
            splits=tuple(sizes[f][1]),
            subdivision=sizes[f][1].sub,
        )

    value_counts = long_numeric(reference, spec.num).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n_ref")
    )
    category_counts = long_categorical(reference, spec.cat).groupBy("feature", "category").agg(
        F.count(F.lit(1)).alias("n_ref")
    )
    support = {}
    if spec.cat:
        support = {
            r["feature"]: r["n"]
            for r in small_rows(category_counts.groupBy("feature").agg(F.count(F.lit(1)).alias("n")))
        }
    return ReferenceProfile(
        spec=spec,
        n_rows=rows["n_rows"],
        numeric=numeric,
        cat_valid={f: rows[f"cat{i}"] for i, f in enumerate(spec.cat)},
        cat_support={f: support.get(f, 0) for f in spec.cat},
        value_counts=value_counts,
        category_counts=category_counts,
    )
