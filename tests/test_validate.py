"""Domain rules: each bound and one step beyond it."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scoreloom.config import CreditConfig, with_optional
from scoreloom.operators import validate as V

CONFIG = CreditConfig()
DTI_ONLY = replace(CONFIG, rules=tuple(r for r in CONFIG.rules if r.column == "dti"))
GOOD = {
    "bureau_score": 300.0, "monthly_income": 50000.0, "dti": 5.0, "utilization_rate": 2.0,
    "num_credit_lines": 50, "missed_payments_3m": 30, "overdrawn_days_3m": 90, "max_dpd_12m": 365,
    "salary_domiciliation": 0, "employment_status": "Unemployed",
}
SCHEMA = (
    "bureau_score double, monthly_income double, dti double, utilization_rate double, num_credit_lines int, "
    "missed_payments_3m int, overdrawn_days_3m int, max_dpd_12m int, salary_domiciliation int, employment_status string"
)


def errors(spark, rows, allow_null=False):
    df = spark.createDataFrame([(i, *{**GOOD, **r}.values()) for i, r in enumerate(rows)], "i int, " + SCHEMA)
    return [r.errors for r in V.validate(df, CONFIG, allow_null).orderBy("i").collect()]


def test_bounds(spark):
    rows, expected = [{}], [[]]
    for rule in CONFIG.rules:
        if rule.allowed:
            continue
        kind = type(GOOD[rule.column])
        for value, ok in ((rule.low, 1), (rule.high, 1), (rule.low - 1, 0), (rule.high + 1, 0)):
            rows.append({rule.column: kind(value)})
            expected.append([] if ok else [f"{rule.column}:range"])
    assert errors(spark, rows) == expected


def test_category_missing_and_several_errors(spark):
    rows = [
        {"employment_status": "Retired"}, {"bureau_score": None}, {"dti": float("nan")},
        {"bureau_score": 900.0, "dti": 7.0, "employment_status": "x"}, {"employment_status": None},
    ]
    assert errors(spark, rows) == [
        ["employment_status:category"], ["bureau_score:missing"], ["dti:missing"],
        ["bureau_score:range", "dti:range", "employment_status:category"], ["employment_status:missing"],
    ]
    assert errors(spark, rows, allow_null=True) == [
        ["employment_status:category"], [], [],
        ["bureau_score:range", "dti:range", "employment_status:category"], [],
    ]


def test_text_input_of_a_wrong_type(spark):
    df = spark.createDataFrame([("0.4",), ("a lot",), ("9",), (None,)], "dti string")
    assert [r.errors for r in V.validate(df, DTI_ONLY).collect()] == [
        [], ["dti:type"], ["dti:range"], ["dti:missing"],
    ]


def test_valid_and_quarantine_cover_the_table(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (None,)], "dti double")
    valid, refused = V.split_valid(V.validate(df, DTI_ONLY))
    assert valid.columns == ["dti"] and valid.count() == 1
    assert {tuple(r.errors) for r in refused.collect()} == {("dti:range",), ("dti:missing",)}


def test_roles_and_label(applicants):
    table = V.features_and_label(applicants, CONFIG)
    assert "label" in table.columns and "default_12m" not in table.columns
    assert "customer_id" not in V.drop_identifier(applicants, CONFIG).columns
    numeric, binary = V.column_roles([*CONFIG.numeric_columns, *CONFIG.dummy_columns, "salary_domiciliation", "customer_id", "default_12m"], CONFIG)
    assert numeric == list(CONFIG.numeric_columns)
    assert binary == [*CONFIG.dummy_columns, "salary_domiciliation"]


def test_class_values_and_flags(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 1), (float("nan"), 1), (2.0, 0)], "x double, y int")
    assert [r.x for r in V.class_values(df, "x", "y", 1).collect()] == [1.0]
    assert [r.x_missing for r in V.missing_flags(df, ["x"]).collect()] == [0, 1, 1, 0]


@pytest.mark.parametrize("strict, expected", [(False, [0, 1, 1]), (True, [0, 0, 1])])
def test_decision(spark, strict, expected):
    df = spark.createDataFrame([(0.4,), (0.5,), (0.6,)], "p double")
    assert [r.d for r in df.select(V.decide(F.col("p"), 0.5, strict).alias("d")).collect()] == expected


def test_contract_refuses_absent_columns_and_fractions(spark):
    config = CreditConfig()
    df = spark.createDataFrame([(1, 700.0, "1.5", 1.5)], "customer_id long, bureau_score double, missed_payments_3m string, max_dpd_12m double")
    errors = V.validate(df, config).first()["errors"]
    absent = [r.column for r in config.rules if r.column not in df.columns]
    assert errors == [
        f"{r.column}:{'missing' if r.column in absent else 'type'}" for r in config.rules if r.column != "bureau_score"
    ]
    relaxed = replace(config, rules=with_optional(config.rules, *absent))
    assert V.validate(df, relaxed).first()["errors"] == ["missed_payments_3m:type", "max_dpd_12m:type"]
