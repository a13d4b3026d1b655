"""Ranking and threshold metrics against brute force on pairs of rows."""

from __future__ import annotations

from math import inf

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloom.config import CreditConfig
from scoreloom.operators import metrics as M
from scoreloom.operators.curve import roc_table

CONFIG = CreditConfig()


def brute(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    grid = sorted({s for s, _ in rows}, reverse=True)
    gaps = [(np.mean([p >= t for p in pos]) - np.mean([n >= t for n in neg]), t) for t in grid]
    best = max(gaps)
    return wins / (len(pos) * len(neg)), max(abs(g) for g, _ in gaps), best


def measured(spark, rows, **options):
    df = spark.createDataFrame(rows, "s double, y int").repartition(4)
    return M.curve_metrics(roc_table(df, "s", "y", **options)).first()


def random_rows(seed, n, digits):
    rng = np.random.default_rng(seed)
    labels = rng.integers(0, 2, n)
    scores = np.round(1 / (1 + np.exp(-(rng.normal(0, 1, n) + labels))), digits)
    return [(float(s), int(y)) for s, y in zip(scores, labels)]


@pytest.mark.parametrize("digits", [1, 2, 12])
@pytest.mark.parametrize("options", [{}, {"max_window_rows": 20}, {"max_window_rows": 1}])
def test_against_pairs(spark, digits, options):
    rows = random_rows(digits, 300, digits)
    auc, ks, (gap, threshold) = brute(rows)
    found = measured(spark, rows, **options)
    assert found.auc == pytest.approx(auc)
    assert found.gini == pytest.approx(2 * auc - 1)
    assert found.ks == pytest.approx(ks)
    assert found.ks_curve == pytest.approx(gap)
    assert found.threshold == threshold


def test_concentrated_scores_by_ranges(spark):
    """A third of the rows shares one score and the others lie very close together."""
    rng = np.random.default_rng(3)
    rows = [(1e-6, i % 7 == 0) for i in range(200)] + [(float(1e-6 + 1e-9 * x), i % 3 == 0) for i, x in enumerate(rng.uniform(0, 1, 400))]
    rows = [(s, int(y)) for s, y in rows]
    auc, ks, _ = brute(rows)
    found = measured(spark, rows, max_window_rows=10)
    assert found.auc == pytest.approx(auc) and found.ks == pytest.approx(ks)


def test_reversed_scores(spark):
    rows = random_rows(5, 200, 2)
    straight = measured(spark, rows)
    turned = measured(spark, [(-s, y) for s, y in rows])
    assert turned.auc == pytest.approx(1 - straight.auc)
    worst = measured(spark, [(0.1, 1), (0.2, 1), (0.8, 0), (0.9, 0)])
    assert (worst.auc, worst.ks, worst.threshold) == (0.0, 1.0, inf)


def test_special_scores(spark):
    tied = measured(spark, [(0.5, 0), (0.5, 1), (0.5, 0)])
    assert (tied.auc, tied.ks) == (0.5, 0.0)
    perfect = measured(spark, [(0.9, 1), (0.8, 1), (0.1, 0)])
    assert (perfect.auc, perfect.ks, perfect.threshold) == (1.0, 1.0, 0.8)
    one_class = measured(spark, [(0.9, 1), (0.8, 1)])
    assert one_class.auc is None and one_class.ks is None and one_class.threshold is None
    ties_take_the_highest = measured(spark, [(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)])
    assert ties_take_the_highest.threshold == 0.9
    unscored = measured(spark, [(0.9, 1), (0.1, 0), (None, 1), (float("nan"), 0), (0.5, None)])
    assert unscored.auc == 1.0


def test_weights_and_groups(spark):
    rows = [("a", 0.9, 1, 3), ("a", 0.4, 0, 2), ("a", 0.9, 0, 1), ("b", 0.2, 1, 1), ("b", 0.7, 0, 4)]
    df = spark.createDataFrame(rows, "m string, s double, y int, n long")
    repeated = df.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    for options in ({}, {"max_window_rows": 1}):
        weighted = M.curve_metrics(roc_table(df, "s", "y", ["m"], "n", **options), ["m"]).orderBy("m").collect()
        plain = M.curve_metrics(roc_table(repeated, "s", "y", ["m"], **options), ["m"]).orderBy("m").collect()
        assert weighted == plain


def test_curve_starts_at_the_origin(spark):
    df = spark.createDataFrame([(0.9, 1), (0.1, 0)], "s double, y int")
    rows = roc_table(df, "s", "y", origin=True).orderBy(F.col("threshold").desc()).collect()
    assert [(r.threshold, r.tpr, r.fpr) for r in rows] == [(inf, 0, 0), (0.9, 1, 0), (0.1, 1, 1)]


def test_ks_grid_against_search(spark):
    rows = random_rows(11, 200, 3) + [(0.0, 1), (1.0, 0), (1.0, 1)]
    df = spark.createDataFrame(rows, "s double, y int")
    grid = M.ks_grid(df, "s", "y").orderBy("point").collect()
    assert len(grid) == 300 and grid[-1].cum_class0 == grid[-1].cum_class1 == 1.0
    for r in grid[::37]:
        for y, value in ((0, r.cum_class0), (1, r.cum_class1)):
            scores = [s for s, c in rows if c == y]
            assert value == pytest.approx(sum(s <= r.point / 299 for s in scores) / len(scores))
    largest = [r for r in grid if r.is_largest]
    assert len(largest) == 1 and largest[0].gap == max(r.gap for r in grid)


def test_confusion_and_rates(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 0)] * 1 + [(1, 1)] * 3 + [(None, 1), (1, None)]
    df = spark.createDataFrame(rows, "y int, d int")
    cells = M.confusion(df, "y", "d")
    assert tuple(cells.first()) == (5, 2, 1, 3)
    row = M.threshold_metrics(cells).first()
    assert (row.precision, row.recall, row.f1, row.specificity) == pytest.approx((3 / 5, 3 / 4, 6 / 9, 5 / 7))
    shares = {(r.actual, r.predicted): r.share for r in M.confusion_long(cells).collect()}
    assert shares[0, 1] == pytest.approx(2 / 7) and shares[1, 1] == pytest.approx(3 / 4)
    report = {r.row: r for r in M.classification_report(cells, CONFIG.target_names).collect()}
    assert report["accuracy"].f1 == pytest.approx(8 / 11)
    assert report["Non-defaut"].precision == pytest.approx(5 / 6) and report["Defaut"].support == 4
    assert report["macro avg"].recall == pytest.approx((5 / 7 + 3 / 4) / 2)
    assert report["weighted avg"].recall == pytest.approx((5 / 7 * 7 + 3 / 4 * 4) / 11)


def test_undefined_rates(spark):
    df = spark.createDataFrame([(1, 0), (1, 0)], "y int, d int")
    row = M.threshold_metrics(M.confusion(df, "y", "d")).first()
    assert (row.precision, row.recall, row.f1, row.specificity) == (0.0, 0.0, 0.0, None)


def test_gate(spark):
    rows = [("auc", 0.75), ("gini", 0.49), ("ks", 0.3), ("f1", 0.45), ("auc_gap", 0.02), ("other", 1.0)]
    df = spark.createDataFrame(rows, "metric string, value double")
    passed = {r.metric: r.passed for r in M.benchmark_gate(df, CONFIG.limits).collect()}
    assert passed == {"auc": 1, "gini": 0, "ks": 1, "f1": 0, "auc_gap": 0, "other": None}


def test_ranges_are_bounded_by_distinct_scores(spark):
    """99% of the rows on four scores: windows still hold no more than the bound."""
    from scoreloom.operators.curve import score_ranges

    rows = spark.range(40_000).selectExpr(
        "CASE WHEN id % 100 > 0 THEN 0.1D * (id % 4) ELSE id / 40000D END AS threshold", "id % 2 AS model"
    )
    counts = rows.groupBy("model", "threshold").count()
    sizes = score_ranges(counts, ["model"], 40).groupBy("model", "range").agg(F.count("threshold").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 40 and sizes.count() > 6


def test_grid_points_equal_the_shown_thresholds(spark):
    rows = [(i / 299, i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "pd double, y int")
    for r in M.ks_grid(df, "pd", "y").collect():
        below = [y for s, y in rows if s <= r["threshold"]]
        assert r["cum_class0"] == below.count(0) / 150 and r["cum_class1"] == below.count(1) / 150


def test_summary_of_one_class_is_null(spark):
    from scoreloom.config import CreditConfig
    from scoreloom.plans.training import evaluation

    df = spark.createDataFrame([(0.2, 0, "train"), (0.4, 0, "train")], "pd double, default_12m int, split string")
    values = {r["metric"]: r["value"] for r in evaluation(df, CreditConfig()).collect()}
    assert values["auc"] is None and values["auc_gap"] is None
    shown = {r["label"]: r["interpretation"] for r in M.metric_summary(evaluation(df, CreditConfig()), CreditConfig().limits).collect()}
    assert len(shown) == 9 and shown["AUC-ROC (Test)"] == "—"


@pytest.mark.parametrize("bound", [1_000_000, 50])
def test_many_curves(spark, monkeypatch, bound):
    """10,000 curves, one far larger, one without a name: nothing is read curve by curve."""
    from pyspark.sql.classic.dataframe import DataFrame

    rows = spark.range(60_000).selectExpr(
        "IF(id < 20000, 0, IF(id % 10007 = 5, NULL, id % 10007)) AS curve", "pmod(hash(id), 1000) / 1000D AS s", "CAST(pmod(hash(id, 1), 3) = 0 AS INT) AS y"
    )
    read, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: read.append(collect(self)) or read[-1])
    metrics = M.curve_metrics(roc_table(rows, "s", "y", ["curve"], max_window_rows=bound), ["curve"])
    decided = M.at_optimal_threshold(rows, "s", "y", metrics, ["curve"])
    assert sum(map(len, read)) < 10
    monkeypatch.undo()
    found = {r.curve: r for r in metrics.collect()}
    assert len(found) > 10_000 and None in found
    for curve in (0, 7, 5000, None):
        mine = [(r.s, r.y) for r in rows.where(F.col("curve").eqNullSafe(F.lit(curve))).collect()]
        if len({y for _, y in mine}) == 2:
            auc, ks, (gap, threshold) = brute(mine)
            assert found[curve].auc == pytest.approx(auc) and found[curve].ks == pytest.approx(ks)
            assert found[curve].threshold == (threshold if gap > 0 else inf)
    wrong = decided.where("curve = 0").where(F.col("decision") != (F.col("s") >= found[0].threshold).cast("int"))
    assert decided.count() == 60_000 and wrong.isEmpty()
