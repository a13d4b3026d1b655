"""Fitted parameters as tables, so that a fit in one job can be applied in another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.config import Band, BinSpec
from scoreloom.sources.versions import VersionStore

STATS_SCHEMA = "column string, stat string, value double"

SCORECARD_SCHEMA = """
    stats array<struct<column: string, stat: string, value: double>>,
    bins array<struct<variable: string, edges: array<double>, direction: string, labels: array<string>>>,
    woe array<struct<variable: string, bin: string, woe: double>>,
    coefficients array<struct<feature: string, coefficient: double>>,
    intercept double,
    bands array<struct<lower: double, label: string, color: string, recommendation: string, level: int>>,
    category_column string,
    categories array<string>
"""


def _float(value: float | None) -> float | None:
    """A parameter as a double; null if it could not be fitted."""
    return None if value is None else float(value)


def stats_table(spark: SparkSession, stats: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """``{stat: {column: value}}`` as ``(column, stat, value)``; one row per parameter."""
    rows = [
        (column, stat, _float(value))
        for stat, values in stats.items()
        for column, value in values.items()
    ]
    return spark.createDataFrame(rows, STATS_SCHEMA)


def write_stats(table: DataFrame, path: str) -> int:
    """Commit the parameters as the next version at ``path``."""
    return VersionStore(table.sparkSession, path).commit({"stats": table.coalesce(1)})


def read_stats(spark: SparkSession, path: str, version: int | None = None) -> dict[str, dict[str, float]]:
    """Parameters as of a version, by default the latest."""
    stats: dict[str, dict[str, float]] = {}
    for row in VersionStore(spark, path).read("stats", version).collect():
        stats.setdefault(row["stat"], {})[row["column"]] = row["value"]
    return stats


@dataclass(frozen=True)
class Scorecard:
    """All that scoring needs: imputation, caps, bins, WOE values, linear model, bands."""

    bins: Sequence[BinSpec]
    woe: Mapping[str, Mapping[str, float]]
    coefficients: Mapping[str, float]
    intercept: float
    bands: Sequence[Band]
    category_column: str
    categories: Sequence[str]
    medians: Mapping[str, float] = field(default_factory=dict)
    caps: Mapping[str, float] = field(default_factory=dict)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The scorecard as a table of one row with nested parameter lists."""
        row = (
            [(c, "median", _float(v)) for c, v in self.medians.items()]
            + [(c, "cap", _float(v)) for c, v in self.caps.items()],
            [
                (b.variable, [float(e) for e in b.edges], b.direction, list(b.labels))
                for b in self.bins
            ],
            [(v, label, value) for v, values in self.woe.items() for label, value in values.items()],
            [(f, float(b)) for f, b in self.coefficients.items()],
            float(self.intercept),
            [(float(b.lower), b.label, b.color, b.recommendation, b.level) for b in self.bands],
            self.category_column,
            list(self.categories),
        )
        return spark.createDataFrame([row], SCORECARD_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> int:
        """Commit the parameters as the next version at ``path``; earlier ones stay readable."""
        return VersionStore(spark, path).commit({"scorecard": self.to_frame(spark).coalesce(1)})

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> Scorecard:
        """The scorecard as of a version, by default the latest."""
        row = VersionStore(spark, path).read("scorecard", version).first()
        woe: dict[str, dict[str, float]] = {}
        for w in row["woe"]:
            woe.setdefault(w["variable"], {})[w["bin"]] = w["woe"]
        return cls(
            bins=tuple(
                BinSpec(b["variable"], tuple(b["edges"]), b["direction"], tuple(b["labels"]))
                for b in row["bins"]
            ),
            woe=woe,
            coefficients={c["feature"]: c["coefficient"] for c in row["coefficients"]},
            intercept=row["intercept"],
            bands=tuple(Band(*b) for b in row["bands"]),
            category_column=row["category_column"],
            categories=tuple(row["categories"]),
            medians={s["column"]: s["value"] for s in row["stats"] if s["stat"] == "median"},
            caps={s["column"]: s["value"] for s in row["stats"] if s["stat"] == "cap"},
        )


def save_model(model: LogisticRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> LogisticRegressionModel:
    return LogisticRegressionModel.load(path)


RUN_LOG_SCHEMA = (
    "run_id string, run_name string, kind string, key string, value string, logged_at timestamp"
)


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    run_name: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float | None],
) -> None:
    """Add one run to the log table; metrics are rounded to 4 decimals, unknown ones null.

    A run has a folder of its own, whose only file appears at once. A run that is
    logged already is left as it is, so a job may log it again after a failure.
    """
    folder = f"{path}/run={sha256(run_id.encode()).hexdigest()}"
    if not _logged(spark, folder).isEmpty():
        return
    rows = [(run_id, run_name, "param", k, str(v)) for k, v in params.items()]
    rows += [
        (run_id, run_name, "metric", k, None if v is None else str(round(v, 4))) for k, v in metrics.items()
    ]
    table = spark.createDataFrame(
        rows, "run_id string, run_name string, kind string, key string, value string"
    )
    table.withColumn("logged_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(folder)


def _logged(spark: SparkSession, path: str) -> DataFrame:
    """What is logged below a folder; nothing if it does not exist."""
    try:
        return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], RUN_LOG_SCHEMA)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """All runs, one row per parameter and metric."""
    return _logged(spark, path).select("run_id", "run_name", "kind", "key", "value", "logged_at")
