"""Exploratory statistics against pandas and numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from scoreloom.config import CreditConfig
from scoreloom.operators import profile as D

CONFIG = CreditConfig()
NUMERIC = list(CONFIG.numeric_columns)


def test_describe_and_shape(applicants, pandas_applicants):
    ours = {r["column"]: r for r in D.describe(applicants, NUMERIC).collect()}
    theirs = pandas_applicants[NUMERIC].describe().T
    shape = {r["column"]: r for r in D.shape_statistics(applicants, NUMERIC).collect()}
    for c in NUMERIC:
        for mine, pandas_name in zip(
            ("count", "mean", "std", "min", "q25", "q50", "q75", "max"),
            ("count", "mean", "std", "min", "25%", "50%", "75%", "max"),
        ):
            assert ours[c][mine] == pytest.approx(theirs.loc[c, pandas_name])
        assert shape[c].skewness == pytest.approx(pandas_applicants[c].skew(), abs=6e-4)
        assert shape[c].kurtosis == pytest.approx(pandas_applicants[c].kurt(), abs=6e-4)


def test_few_values_have_no_shape(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    row = D.shape_statistics(df, ["x"]).first()
    assert row.skewness is None and row.kurtosis is None


def test_histogram_equals_numpy(applicants, pandas_applicants):
    rows = D.class_histogram(applicants, ["monthly_income", "max_dpd_12m"], 40, by="default_12m").toPandas()
    for (variable, y), part in rows.groupby(["variable", "class"]):
        values = pandas_applicants.loc[pandas_applicants.default_12m == y, variable].dropna()
        density, edges = np.histogram(values, bins=40, density=True)
        part = part.sort_values("bin")
        assert part.density.to_numpy() == pytest.approx(density)
        assert part.low.to_numpy() == pytest.approx(edges[:-1])
        assert part.n.sum() == len(values)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(4.0,)] * 5 + [(None,)], "x double")
    rows = D.class_histogram(df, ["x"], 4).orderBy("bin").collect()
    assert (rows[0].low, rows[-1].high) == (3.5, 4.5)
    assert sum(r.n for r in rows) == 5


def test_box_statistics(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, -90.0]
    df = spark.createDataFrame([(0, v) for v in values] + [(1, 2.0), (None, 5.0), (1, None)], "y int, x double")
    zero, one = D.box_statistics(df, ["x"], "y").orderBy("class").collect()
    q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert (zero.q1, zero.median, zero.q3) == pytest.approx((q1, q2, q3))
    assert (zero.whisker_low, zero.whisker_high, zero.n_outside) == (1.0, 5.0, 2)
    assert (one.whisker_low, one.whisker_high, one.n_outside) == (2.0, 2.0, 0)


def test_extreme_outliers_are_strict_and_upper(spark):
    df = spark.createDataFrame([(float(v), -float(v)) for v in [1, 2, 3, 4, 5, 100]], "x double, z double")
    rows = D.extreme_outliers(df, ["x", "z"]).collect()
    assert [(r["column"], r.n_outliers) for r in rows] == [("x", 1)]


def test_buckets_drop_outside_and_lowest_edge(spark):
    edge_rows = [
        (300.0, 0.0, -1, 0.0), (850.0, 10.0, 1000, 1.0), (450.0, 10.5, 1001, 1.0001), (None, 0.2, 0, 0.2),
        (float("nan"), float("nan"), 15, float("nan")),
    ]
    df = spark.createDataFrame(
        [(*r, i % 2) for i, r in enumerate(edge_rows)],
        "bureau_score double, dti double, max_dpd_12m int, utilization_rate double, default_12m int",
    )
    rows = D.rate_by_bucket(df, CONFIG.rate_buckets, "default_12m").collect()
    found = {(r.variable, r.bucket): r.n for r in rows}
    assert found == {
        ("bureau_score", "300-450"): 1, ("bureau_score", "780-850"): 1,
        ("dti", ">100%"): 1, ("dti", "0-20%"): 1,
        ("max_dpd_12m", "0 jours"): 1, ("max_dpd_12m", "1-15"): 1, ("max_dpd_12m", ">90"): 1,
        ("utilization_rate", "0-20%"): 1, ("utilization_rate", "80-100%"): 1,
    }


def test_correlations_are_pairwise_and_null_for_a_constant(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 7.0, 5.0), (4.0, 1.0, 5.0), (float("nan"), 3.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, k double")
    found = {(r.var_a, r.var_b): r.r for r in D.correlations(df, ["a", "b", "k"]).collect()}
    frame = pd.DataFrame(rows, columns=["a", "b", "k"])
    assert found["b", "a"] == pytest.approx(frame.corr().loc["a", "b"])
    assert found["k", "a"] is None


def test_missing_values_count_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (float("nan"), "b"), (2.0, "c")], "x double, s string")
    rows = {r["column"]: r for r in D.missing_table(df, ["x", "s"]).collect()}
    assert (rows["x"].n_missing, rows["x"].pct_missing, rows["x"].above_alert) == (2, 50.0, 1)
    assert rows["s"].n_missing == 1
    assert D.missing_total(df).first().n_missing == 3
    assert D.missing_table(df.where("x = 1"), ["x", "s"]).count() == 0


def test_rate_by_missing_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 0), (float("nan"), 1)], "x double, y int")
    rows = {r.missing: (r.n, r.target_rate) for r in D.rate_by_missing(df, ["x"], "y").collect()}
    assert rows == {0: (1, 1.0), 1: (2, 0.5)}


def test_rate_by_value_overall_counts_rows_without_value(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), (None, 1)], "s string, y int")
    rows = {r.value: (r.n, r.rate_pct, r.overall_rate_pct) for r in D.rate_by_value(df, "s", "y").collect()}
    assert rows == {"a": (2, 50.0, 50.0), "b": (1, 0.0, 50.0)}


def test_target_distribution_of_one_class(spark):
    df = spark.createDataFrame([(0,), (0,), (None,)], "y int")
    row = D.target_distribution(df, "y").first()
    assert (row.n, row.pct, row.imbalance_ratio) == (2, 100.0, None)


def test_correlations_of_many_columns_by_task_moments(spark):
    """50 columns with gaps, constants and far-off means: as pairwise complete, and no row becomes several."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 50)) @ rng.normal(size=(50, 50)) + 1e8 * (np.arange(50) % 3 == 0)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 49], x[:, 48] = 0.1, np.nan
    names = [f"x{i}" for i in range(50)]
    frame = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame(frame).repartition(9)
    table = D.correlations(df, names)
    assert "Generate" not in table._jdf.queryExecution().executedPlan().toString()
    found = {(r.var_a, r.var_b): r.r for r in table.collect()}
    assert len(found) == 50 * 49 // 2
    wanted = frame.corr()
    for (a, b), r in found.items():
        if {a, b} & {"x48", "x49"}:
            assert r is None
        else:
            assert r == pytest.approx(wanted.loc[a, b], abs=1e-6)
    assert all(r.r is None for r in D.correlations(df.limit(0), names[:3]).collect())
