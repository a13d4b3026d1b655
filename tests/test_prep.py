"""Imputation, caps, encoding, standardization, splits and folds."""

from __future__ import annotations

import hashlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloom.config import CreditConfig
from scoreloom.operators import prep as P
from scoreloom.operators import ranks as R

CONFIG = CreditConfig()


def test_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,), (float("nan"),)], "x double")
    assert P.fit_medians(df, ["x"]) == {"x": 2.5}
    filled = [r.x for r in P.impute(df, {"x": 2.5}).collect()]
    assert filled == [1.0, 2.0, 3.0, 4.0, 2.5, 2.5]
    assert 2.0 <= P.fit_medians(df, ["x"], approximate=True)["x"] <= 3.0


def test_column_without_values_stays_missing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    medians = P.fit_medians(df, ["x"])
    assert medians == {"x": None}
    assert [r.x for r in P.impute(df, medians).collect()] == [None, None]


def test_cap_keeps_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (None,), (float("nan"),)], "x double")
    assert [r.x for r in P.cap(df, {"x": 5.0}).collect()] == [1.0, 5.0, None, None]
    row = P.cap_audit(df, {"x": 5.0}).first()
    assert (row.max_before, row.cap, row.max_after) == (9.0, 5.0, 5.0)


def test_caps_are_fitted_after_imputation(applicants, pandas_applicants):
    medians = P.fit_medians(applicants, CONFIG.impute_columns)
    caps = P.fit_caps(P.impute(applicants, medians), CONFIG.cap_columns)
    frame = pandas_applicants.copy()
    for c in CONFIG.impute_columns:
        frame[c] = frame[c].fillna(frame[c].median())
    for c in CONFIG.cap_columns:
        assert caps[c] == pytest.approx(frame[c].quantile(0.99))
        last_edge = next(b.edges[-2] for b in CONFIG.bins if b.variable == c)
        assert caps[c] > last_edge  # capping never moves a value to another class


def test_one_hot_unknown_and_missing_category(spark):
    df = spark.createDataFrame([("Permanent",), ("Student",), ("Retired",), (None,)], "employment_status string")
    rows = P.one_hot(df, "employment_status", CONFIG.categories).collect()
    assert [sum(r) for r in rows] == [0, 1, 0, 0]
    assert rows[1].employment_status_Student == 1
    assert "employment_status_Permanent" not in rows[0].asDict()
    assert P.fit_categories(df, "employment_status") == ["Permanent", "Retired", "Student"]


def test_standardize_uses_population_deviation_and_survives_a_constant(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (8.0, 7.0)], "x double, k double")
    scaler = P.fit_standardizer(df, ["x", "k"])
    assert scaler["x"] == pytest.approx((4.0, float(np.std([1, 3, 8]))))
    assert scaler["k"] == (7.0, 1.0)
    assert [r.k for r in P.standardize(df, scaler).collect()] == [0.0, 0.0, 0.0]


@pytest.mark.parametrize(
    "sizes, expected",
    [
        ({0: 10396, 1: 1604}, {0: 2079, 1: 321}),
        ({0: 10, 1: 10}, {0: 2, 1: 2}),
        ({0: 5, 1: 1}, {0: 1, 1: 1}),
        ({0: 3, 1: 0}, {0: 1, 1: 0}),
    ],
)
def test_split_sizes(sizes, expected):
    assert P.split_sizes(sizes, 0.2) == expected


def hashed(i, seed=42):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


@pytest.mark.parametrize("digits, small", [(3, 1_000_000), (1, 2), (1, 0)])
def test_split_takes_the_first_rows_of_each_class_in_hash_order(spark, monkeypatch, digits, small):
    monkeypatch.setattr(R, "PREFIX_DIGITS", digits)
    rows = [(i, 1 if i % 5 == 0 else 0) for i in range(203)] + [(1000, None)]
    df = spark.createDataFrame(rows, "customer_id long, default_12m int")
    cuts = R.hash_cuts(
        df, "customer_id", "default_12m", lambda n: {0: [0, 1, 40], 1: [8, 41]}, 42, small_bucket_rows=small
    )
    for y, positions in ((0, [1, 40]), (1, [8, 41])):
        order = sorted(hashed(i) for i, c in rows if c == y)
        assert cuts[y][-2:] == [order[p - 1] for p in positions]
    assert cuts[0][0] == ""


def test_split_is_exact_disjoint_and_stable(applicants):
    parts = [
        {r.customer_id: r.split for r in P.stratified_split(applicants.repartition(n), CONFIG).select("customer_id", "split").collect()}
        for n in (1, 17)
    ]
    assert parts[0] == parts[1]
    counts = P.stratified_split(applicants, CONFIG).groupBy("default_12m", "split").count().collect()
    assert {(r[0], r[1]): r[2] for r in counts} == {
        (0, "test"): 260, (0, "train"): 1040, (1, "test"): 40, (1, "train"): 160,
    }


def test_row_without_target_gets_no_split_and_no_fold(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "customer_id long, default_12m int")
    assert P.stratified_split(df, CONFIG).where("customer_id = 3").first().split is None
    assert P.stratified_folds(df, CONFIG).where("customer_id = 3").first().fold is None


def test_folds_differ_by_one_row_at_most(applicants):
    folds = P.stratified_folds(applicants.limit(997), replace(CONFIG, folds=5))
    for y in (0, 1):
        sizes = [r["count"] for r in folds.where(F.col("default_12m") == y).groupBy("fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_copies_of_an_id_stay_together(spark):
    rows = [(7, 0)] * 40 + [(i, 0) for i in range(100, 160)] + [(i, 1) for i in range(200, 220)]
    df = spark.createDataFrame(rows, "customer_id long, default_12m int")
    split = P.stratified_split(df, CONFIG).where("customer_id = 7").select("split").distinct().count()
    assert split == 1


@pytest.mark.parametrize("small", [1_000_000, 0])
def test_strata_without_a_limit(spark, small):
    """10,000 strata of uneven sizes, one of which has a third of the rows."""
    df = spark.range(60_000).selectExpr("id AS customer_id", "IF(id % 3 = 0, 0, CAST(id % 10007 AS INT)) AS default_12m")
    config = replace(CONFIG, small_bucket_rows=small) if small else replace(CONFIG, small_bucket_rows=50)
    sizes = {r.default_12m: r["count"] for r in df.groupBy("default_12m").count().collect()}
    assert len(sizes) > 10_000
    split = P.stratified_split(df, config)
    assert split.where("split IS NULL").isEmpty() and split.count() == 60_000
    found = {r.default_12m: r["count"] for r in split.where("split = 'test'").groupBy("default_12m").count().collect()}
    wanted = P.split_sizes(sizes, CONFIG.test_share)
    assert found == {value: n for value, n in wanted.items() if n}
    hot = sorted((r.customer_id for r in split.where("default_12m = 0 AND split = 'test'").collect()), key=hashed)
    every = sorted((r.customer_id for r in df.where("default_12m = 0").collect()), key=hashed)
    assert hot == every[: wanted[0]]


def test_folds_of_many_strata(spark):
    df = spark.range(3_000).selectExpr("id AS customer_id", "CAST(id % 450 AS INT) AS default_12m")
    folds = P.stratified_folds(df, replace(CONFIG, folds=5)).groupBy("default_12m").pivot("fold", list(range(5))).count().collect()
    assert len(folds) == 450
    assert all(max(f or 0 for f in r[1:]) - min(f or 0 for f in r[1:]) <= 1 for r in folds)
