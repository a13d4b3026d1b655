"""Fits against an independent Newton solution; cross-validation; stored parameters."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import frozen
from scoreloom.config import CreditConfig
from scoreloom.operators import model as L
from scoreloom.operators import prep as P
from scoreloom.plans.training import evaluation, standardized_split, train_scorecard, woe_dataset
from scoreloom.sources import params
from scoreloom.storage import new_path

CONFIG = CreditConfig()


def newton(x, y, weights, c):
    """Minimum of ``c * weighted log loss + |b|^2 / 2`` with a free intercept."""
    design = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.diag([0.0] + [1.0] * x.shape[1])
    beta = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = c * design.T @ (weights * (p - y)) + penalty @ beta
        hessian = c * (design.T * (weights * p * (1 - p))) @ design + penalty
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-12:
            break
    return beta


@pytest.fixture(scope="module")
def standardized(applicants):
    data, features = standardized_split(applicants, CONFIG)
    return data.where("split = 'train'").select(*features, CONFIG.target).cache(), features


@pytest.mark.parametrize("class_weight", [None, "balanced"])
@pytest.mark.parametrize("c", [1.0, 0.01])
def test_fit_equals_newton(standardized, class_weight, c):
    data, features = standardized
    frame = data.toPandas()
    y = frame[CONFIG.target].to_numpy(float)
    weights = np.ones(len(y))
    if class_weight:
        weights = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    want = newton(frame[features].to_numpy(float), y, weights, c)
    model = L.fit_logistic(data, features, CONFIG.target, c=c, class_weight=class_weight)
    got = np.array([model.intercept, *L.coefficients_of(model, features).values()])
    assert got == pytest.approx(want, abs=1e-4, rel=1e-4)


def test_patterns_give_the_same_fit(applicants):
    data, _, _ = woe_dataset(applicants, CONFIG)
    features = list(CONFIG.woe_features)
    patterns = L.feature_patterns(data, features, CONFIG.target)
    assert patterns.agg(F.sum(L.ROWS)).first()[0] == 1500
    by_row = L.fit_logistic(data, features, CONFIG.target)
    by_pattern = L.fit_logistic(patterns, features, CONFIG.target, weight=L.ROWS)
    assert by_pattern.intercept == pytest.approx(by_row.intercept, abs=1e-4)
    assert list(by_pattern.coefficients) == pytest.approx(list(by_row.coefficients), abs=1e-4)


def test_probability_expression_equals_the_model(standardized):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    data, features = standardized
    model = L.fit_logistic(data, features, CONFIG.target)
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(data)
    both = L.with_probability(
        model.transform(vectors).withColumn("theirs", vector_to_array("probability")[1]),
        L.coefficients_of(model, features),
        model.intercept,
    )
    assert both.agg(F.max(F.abs(F.col("pd") - F.col("theirs")))).first()[0] < 1e-12


def test_unknown_class_weight_is_refused(standardized):
    data, features = standardized
    with pytest.raises(ValueError):
        L.fit_logistic(data, features, CONFIG.target, class_weight="heavy")


def test_coefficient_table(spark):
    rows = L.coefficient_table(spark, {"a": 0.5, "b": -1.25, "c": 0.0}, by_size=True).collect()
    assert [r.feature for r in rows] == ["b", "a", "c"]
    assert [r.effect for r in rows] == ["Protection", "Risque", "Protection"]
    assert rows[1].odds_ratio == pytest.approx(1.6487)
    by_value = [r.feature for r in L.coefficient_table(spark, {"a": 0.5, "b": -1.25, "c": 0.0}).collect()]
    assert by_value == ["a", "c", "b"]


def test_cross_validation_by_rows_and_by_patterns(applicants):
    data, _, _ = woe_dataset(applicants, CONFIG)
    folds = P.stratified_folds(data, CONFIG)
    features = list(CONFIG.woe_features)
    rows = L.cross_validate(folds, features, CONFIG).collect()
    patterns = L.cross_validate(
        folds, features, CONFIG, patterns=True
    ).collect()
    assert [r.fold for r in rows] == [0, 1, 2, 3, 4]
    for a, b in zip(rows, patterns):
        assert a.auc == pytest.approx(b.auc, abs=1e-4) and a.f1 == pytest.approx(b.f1, abs=0.02)
        assert 0.8 < a.auc < 1
    summary = L.cross_validation_summary(L.cross_validate(folds, features, CONFIG)).first()
    assert summary.cv_auc_std == pytest.approx(np.std([r.auc for r in rows]), abs=1e-4)


@pytest.mark.parametrize("fit_on_train", [False, True])
def test_training_and_stored_scorecard(spark, applicants, fit_on_train):
    trained = train_scorecard(applicants, CONFIG, fit_on_train)
    values = {r.metric: r.value for r in evaluation(trained.scored, CONFIG).collect()}
    assert values["tn"] + values["fp"] + values["fn"] + values["tp"] == 300
    assert values["auc"] > 0.8 and values["gini"] == pytest.approx(2 * values["auc"] - 1)
    path = new_path(spark, "card")
    trained.card.save(spark, path)
    loaded = params.Scorecard.load(spark, path)
    assert loaded == trained.card
    params.save_model(trained.model, path + "-model")
    assert params.load_model(path + "-model").coefficients == trained.model.coefficients


def test_stats_and_run_log(spark):
    path = new_path(spark, "stats")
    stats = {"median": {"a": 1.5}, "cap": {"a": 9.0, "b": None}}
    params.write_stats(params.stats_table(spark, stats), path)
    assert params.read_stats(spark, path) == stats
    log = new_path(spark, "runs")
    for run in ("one", "two"):
        params.log_run(spark, log, run, "fit", {"C": 1.0}, {"cv_auc_mean": 0.854321})
    rows = params.read_run_log(spark, log).orderBy("run_id", "kind").collect()
    assert [(r.run_id, r.kind, r.key, r.value) for r in rows] == [
        ("one", "metric", "cv_auc_mean", "0.8543"), ("one", "param", "C", "1.0"),
        ("two", "metric", "cv_auc_mean", "0.8543"), ("two", "param", "C", "1.0"),
    ]
    assert replace(frozen.CONFIG, rules=CONFIG.rules) == CONFIG


def test_fit_keeps_the_partitions_of_the_scan(spark, monkeypatch):
    """Few labels in a large table do not narrow its scan; patterns may be gathered."""
    seen = []
    fit = L.LogisticRegression._fit
    monkeypatch.setattr(L.LogisticRegression, "_fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    rows = spark.range(0, 4000, 1, 16).selectExpr("CAST(id % 7 AS DOUBLE) AS x", "CASE WHEN id % 9 = 0 THEN CAST(id % 2 AS INT) END AS y")
    L.fit_logistic(rows, ["x"], "y")
    L.fit_logistic(L.feature_patterns(rows, ["x"], "y"), ["x"], "y", weight=L.ROWS)
    assert seen[0] == 16 and seen[1] <= 8


def test_fit_is_optimal(spark):
    rows = spark.range(500).selectExpr("CAST(id % 7 AS DOUBLE) AS x", "CAST(id % 3 AS DOUBLE) AS z", "CAST(id % 5 = 0 AS INT) AS y")
    model = L.fit_logistic(rows, ["x", "z"], "y", 0.5, "balanced")
    found = {r["term"]: r["gradient"] for r in L.optimality(rows, ["x", "z"], "y", model, 0.5, "balanced").collect()}
    assert set(found) == {"intercept", "x", "z"} and all(abs(g) < 1e-6 for g in found.values())
    off = L.optimality(rows, ["x", "z"], "y", model, 0.05, "balanced").collect()
    assert any(abs(r["gradient"]) > 1e-6 for r in off)
