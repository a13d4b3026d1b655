"""From an applicant table to a scorecard and its metrics."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.config import CreditConfig
from scoreloom.functions.columns import literal, stack
from scoreloom.operators import metrics as M
from scoreloom.operators import model as L
from scoreloom.operators import prep as P
from scoreloom.operators import woe as E
from scoreloom.operators.curve import roc_table
from scoreloom.operators.validate import column_roles
from scoreloom.sources.params import Scorecard


def prepare(
    df: DataFrame,
    config: CreditConfig,
    fit_on: DataFrame | None = None,
    fitted: tuple[dict[str, float], dict[str, float]] | None = None,
) -> tuple[DataFrame, dict[str, float], dict[str, float]]:
    """Impute, cap and encode; ``(prepared, medians, caps)``.

    Parameters are fitted on ``fit_on`` (for example the train rows), by default
    on all rows; ``fitted`` are medians and caps known already.
    """
    basis = df if fit_on is None else fit_on
    if fitted is None:
        medians = P.fit_medians(basis, config.impute_columns)
        fitted = medians, P.fit_caps(P.impute(basis, medians), config.cap_columns, config.cap_quantile)
    medians, caps = fitted
    prepared = P.cap(P.impute(df, medians), caps)
    return P.one_hot(prepared, config.category_column, config.categories), medians, caps


def standardized_split(
    df: DataFrame,
    config: CreditConfig,
    fitted: tuple[dict[str, float], dict[str, float]] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Prepared table with ``split`` and standardized numeric columns, and its features.

    A ``split`` that the table has already is kept.
    """
    prepared, _, _ = prepare(df, config, fitted=fitted)
    numeric, binary = column_roles(prepared.columns, config)
    split = prepared if "split" in df.columns else P.stratified_split(prepared, config)
    scaler = P.fit_standardizer(split.where(F.col("split") == "train"), numeric)
    return P.standardize(split, scaler), numeric + binary


def woe_dataset(
    df: DataFrame, config: CreditConfig, fit_on: DataFrame | None = None
) -> tuple[DataFrame, dict[str, float], dict[str, dict[str, float]]]:
    """WOE features, dummies, flags and target; ``(table, medians, woe maps)``."""
    basis = df if fit_on is None else fit_on
    medians = P.fit_medians(basis, config.impute_columns)
    table = E.woe_table(P.impute(basis, medians), config.bins, config.target)
    maps = E.woe_maps(table)
    encoded = P.one_hot(P.impute(df, medians), config.category_column, config.categories)
    replaced = E.apply_woe(encoded, config.bins, maps)
    passed_on = [c for c in ("split", "fold") if c in df.columns]
    return (
        replaced.select(config.id_column, *config.woe_features, config.target, *passed_on),
        medians,
        maps,
    )


@dataclass(frozen=True)
class TrainedScorecard:
    card: Scorecard
    model: LogisticRegressionModel
    scored: DataFrame  # key, target, split, pd


def train_scorecard(
    df: DataFrame, config: CreditConfig, fit_on_train: bool = False, fit_categories: bool = False
) -> TrainedScorecard:
    """Fit the WOE scorecard on the train rows.

    By default medians, caps and WOE values come from all rows, as published;
    ``fit_on_train`` keeps the test rows out of them as well. ``fit_categories``
    encodes the categories that occur instead of the configured ones. The model is
    fitted on distinct WOE rows, so its cost does not grow with the table.
    """
    split = P.stratified_split(df, config)
    basis = split.where(F.col("split") == "train") if fit_on_train else split
    if fit_categories:
        found = P.fit_categories(basis, config.category_column, config.max_categories)
        config = replace(config, categories=tuple(found))
    data, medians, maps = woe_dataset(split, config, basis)
    caps = P.fit_caps(P.impute(basis, medians), config.cap_columns, config.cap_quantile)
    features = list(config.woe_features)
    train = L.feature_patterns(data.where(F.col("split") == "train"), features, config.target)
    train = train.persist()
    try:
        model = L.fit_logistic(
            train, features, config.target, config.c, config.class_weight, config.max_iter, L.ROWS
        )
    finally:
        train.unpersist()
    coefficients = L.coefficients_of(model, features)
    card = Scorecard(
        bins=config.bins,
        woe=maps,
        coefficients=coefficients,
        intercept=float(model.intercept),
        bands=config.bands,
        category_column=config.category_column,
        categories=config.categories,
        medians=medians,
        caps=caps,
    )
    scored = L.with_probability(data, coefficients, float(model.intercept)).select(
        config.id_column, config.target, "split", "pd"
    )
    return TrainedScorecard(card, model, scored)


def _double(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else literal(float(value))


def evaluation(scored: DataFrame, config: CreditConfig) -> DataFrame:
    """``(metric, value)`` of a scored table with a ``split`` column.

    Ranking metrics per split, threshold metrics of the test rows at their
    optimal threshold. A metric that a missing split or class leaves open is null.
    """
    ranking = M.curve_metrics(
        roc_table(scored, "pd", config.target, ["split"]), ["split"]
    ).collect()
    none = dict.fromkeys(("auc", "gini", "ks", "threshold"))
    test, train = (next((r.asDict() for r in ranking if r["split"] == s), none) for s in ("test", "train"))
    gap = None if None in (train["auc"], test["auc"]) else abs(train["auc"] - test["auc"])
    decided = scored.where(F.col("split") == "test").withColumn(
        "decision", (F.col("pd") >= F.lit(test["threshold"]).cast("double")).cast("int")
    )
    cells = M.threshold_metrics(M.confusion(decided, config.target, "decision"))
    values = {
        "auc": _double(test["auc"]),
        "auc_train": _double(train["auc"]),
        "auc_gap": _double(gap),
        "gini": _double(test["gini"]),
        "ks": _double(test["ks"]),
        "threshold": _double(test["threshold"]),
        **{c: c for c in ("precision", "recall", "specificity", "f1")},
        **{c: f"CAST({c} AS DOUBLE)" for c in ("tn", "fp", "fn", "tp")},
    }
    return stack(cells, ["metric", "value"], [[literal(m), v] for m, v in values.items()])
