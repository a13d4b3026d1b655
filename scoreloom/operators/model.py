"""Logistic regression: fit, cross-validation, coefficients, probability."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from math import ceil

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from scoreloom.config import EFFECTS, CreditConfig
from scoreloom.functions.columns import even, literal, name, number, round_even, stack
from scoreloom.functions.scoring import probability
from scoreloom.operators.curve import roc_table
from scoreloom.operators.metrics import confusion, curve_metrics, threshold_metrics

ROWS = "n_rows"
ROWS_PER_PARTITION = 100_000


def feature_patterns(
    df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Distinct feature rows with their multiplicity ``n_rows``.

    A WOE table has a bounded number of them, so a fit on the patterns costs the
    same for any number of applicants and has the same solution.
    """
    return df.where(F.col(label).isNotNull()).groupBy(*keys, *features, label).agg(
        F.count(F.lit(1)).alias(ROWS)
    )


def class_weights(df: DataFrame, label: str, weight: str | None = None) -> dict[int, float]:
    """Balanced weights ``n / (classes * n_class)``."""
    sizes = {value: rows for value, (rows, _) in _class_sizes(df, label, weight).items()}
    n = sum(sizes.values())
    return {value: n / (len(sizes) * rows) for value, rows in sizes.items()}


def _class_sizes(df: DataFrame, label: str, weight: str | None) -> dict[int, tuple[int, int]]:
    """Per class: rows by multiplicity, and rows as stored."""
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        rows.alias("n"), F.count(F.lit(1)).alias("stored")
    )
    return {int(r[label]): (r["n"], r["stored"]) for r in counted.collect()}


def fit_logistic(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    c: float = 1.0,
    class_weight: str | None = None,
    max_iter: int = 1000,
    weight: str | None = None,
    tolerance: float = 1e-8,
) -> LogisticRegressionModel:
    """L2-penalized fit with inverse penalty strength ``c`` and a free intercept.

    ``weight`` is a row multiplicity. The penalty is per row, so it is scaled by
    the number of rows; balanced class weights leave that number unchanged.
    """
    labelled = df.where(F.col(label).isNotNull())
    counted = _class_sizes(labelled, label, weight)
    sizes = {value: rows for value, (rows, _) in counted.items()}
    n, stored = sum(sizes.values()), sum(rows for _, rows in counted.values())
    row_weight = F.col(weight).cast("double") if weight else F.lit(1.0)
    if class_weight == "balanced":
        factor = F.lit(None).cast("double")
        for value, rows in sizes.items():
            factor = F.when(F.col(label) == value, F.lit(n / (len(sizes) * rows))).otherwise(factor)
        row_weight = row_weight * factor
    elif class_weight is not None:
        raise ValueError(f"unknown class_weight: {class_weight}")
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(
        labelled.select(
            *features, F.col(label).cast("double").alias("label"), row_weight.alias("weight")
        )
    )
    estimator = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        regParam=1.0 / (c * n),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tolerance,
    )
    rows = vectors.select("features", "label", "weight")
    if weight:
        # Patterns come out of a shuffle, so fewer tasks read no less of the table.
        rows = rows.coalesce(max(1, ceil(stored / ROWS_PER_PARTITION)))
    return estimator.fit(rows)


def coefficients_of(model: LogisticRegressionModel, features: Sequence[str]) -> dict[str, float]:
    return {f: float(b) for f, b in zip(features, model.coefficients)}


def coefficient_table(
    spark: SparkSession, coefficients: Mapping[str, float], by_size: bool = False
) -> DataFrame:
    """Coefficient, odds ratio (4 decimals) and reading; by value, or by absolute value.

    One row per feature. The odds ratio is taken before rounding.
    """
    table = spark.createDataFrame(list(coefficients.items()), "feature string, beta double")
    shown = table.select(
        "feature",
        round_even("beta", 4).alias("coefficient"),
        F.expr(even("exp(beta)", 4)).alias("odds_ratio"),
        F.when(F.col("beta") > 0, EFFECTS["raises"]).otherwise(EFFECTS["lowers"]).alias("effect"),
    )
    order = F.abs("coefficient") if by_size else F.col("coefficient")
    return shown.orderBy(order.desc(), "feature")


def optimality(
    df: DataFrame, features: Sequence[str], label: str, model: LogisticRegressionModel, c: float, class_weight: str | None = None, weight: str | None = None
) -> DataFrame:
    """``(term, gradient)`` of the penalized likelihood per row; all are 0 at the optimum.

    One aggregate over the fitted rows: for a feature the sum of ``w (y - p) x``
    less ``beta / c``, for the intercept without penalty, each over the number of rows.
    """
    betas = coefficients_of(model, features)
    known = df.where(F.col(label).isNotNull())
    rows = F.col(weight).cast("double") if weight else F.lit(1.0)
    if class_weight == "balanced":
        weights = class_weights(known, label, weight)
        rows = rows * F.element_at(
            F.create_map(*[F.lit(float(v)) for item in weights.items() for v in item]), F.col(label).cast("double")
        )
    p = probability(betas, float(model.intercept), known.columns)
    residual = rows * (F.col(label).cast("double") - p)
    n = F.sum(F.col(weight) if weight else F.lit(1)).cast("double")
    sums = known.agg(
        n.alias("n"),
        F.sum(residual).alias("intercept"),
        *[F.sum(residual * number(f)).alias(f) for f in features],
    )
    terms = [["'intercept'", "intercept / n"]]
    terms += [[literal(f), f"({name(f)} - {literal(b / c)}) / n"] for f, b in betas.items()]
    return stack(sums, ["term", "gradient"], terms)


def with_probability(
    df: DataFrame, coefficients: Mapping[str, float], intercept: float, name: str = "pd"
) -> DataFrame:
    """Add the default probability; a feature the table lacks counts as 0."""
    return df.withColumn(name, probability(coefficients, intercept, df.columns))


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    config: CreditConfig,
    fold: str = "fold",
    patterns: bool = False,
    parallelism: int = 3,
) -> DataFrame:
    """AUC and F1 (at ``p > 0.5``) of the held-out rows, one row per fold.

    Each fold is fitted once and serves both metrics. All held-out rows are
    scored and measured together in one job. ``patterns`` fits on distinct
    feature rows, for tables known to have few of them.
    """
    label = config.target
    if patterns:
        data, weight = feature_patterns(df, features, label, [fold]), ROWS
    else:
        data, weight = df.where(F.col(label).isNotNull()).select(fold, label, *features), None
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _class_sizes(data, label, weight)  # fills the persisted table once, before the fits share it

        def fit_without(k: int) -> Column:
            model = fit_logistic(
                data.where(F.col(fold) != k),
                features,
                label,
                config.c,
                config.class_weight,
                config.max_iter,
                weight,
            )
            return probability(coefficients_of(model, features), float(model.intercept), data.columns)

        # The fits are independent jobs; side by side they share the cluster.
        with ThreadPoolExecutor(max_workers=min(parallelism, config.folds)) as pool:
            jobs = [
                pool.submit(inheritable_thread_target(df.sparkSession)(fit_without), k)
                for k in range(config.folds)
            ]
            held_out = F.lit(None).cast("double")
            for k, job in enumerate(jobs):
                held_out = F.when(F.col(fold) == k, job.result()).otherwise(held_out)
        scored = data.withColumn("pd", held_out)
        # Materialized here: the persisted rows are released on return.
        curve = roc_table(scored, "pd", label, [fold], weight)
        auc = {r[fold]: r["auc"] for r in curve_metrics(curve, [fold]).collect()}
        decided = scored.withColumn("decision", (F.col("pd") > 0.5).cast("int"))
        f1 = {
            r[fold]: r["f1"]
            for r in threshold_metrics(confusion(decided, label, "decision", [fold], weight)).collect()
        }
    finally:
        data.unpersist()
    rows = [(k, auc[k], f1[k]) for k in sorted(auc)]
    return df.sparkSession.createDataFrame(rows, f"{fold} int, auc double, f1 double")


def cross_validation_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and population deviation of each metric over the folds."""
    return per_fold.agg(
        F.avg("auc").alias("cv_auc_mean"),
        F.stddev_pop("auc").alias("cv_auc_std"),
        F.avg("f1").alias("cv_f1_mean"),
        F.stddev_pop("f1").alias("cv_f1_std"),
    )
