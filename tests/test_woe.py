"""Binning, WOE, IV and the WOE transform on hand-written rows and against pandas."""

from __future__ import annotations

from math import inf, log

import numpy as np
import pandas as pd
import pytest

from scoreloom.config import FALLING, RISING, BinSpec, CreditConfig
from scoreloom.operators import woe as E

CONFIG = CreditConfig()


def test_classes_are_right_closed_and_keep_everything(spark):
    spec = next(b for b in CONFIG.bins if b.variable == "bureau_score")
    values = [300.0, 500.0, 500.0001, 600.0, 680.0, 850.0, 1e9, -1e9, None, float("nan"), inf, -inf]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, bureau_score double")
    got = [r.bureau_score for r in E.assign_bins(df, [spec]).orderBy("i").collect()]
    assert got == ["C1", "C1", "C2", "C2", "C3", "C4", "C4", "C1", None, None, "C4", "C1"]


def test_same_classes_as_pandas_cut(applicants, pandas_applicants):
    frame = E.assign_bins(applicants, CONFIG.bins).toPandas()
    for spec in CONFIG.bins:
        cut = pd.cut(pandas_applicants[spec.variable], list(spec.edges), labels=list(spec.names), include_lowest=True)
        assert frame[spec.variable].fillna("").tolist() == cut.astype(object).fillna("").tolist()


def test_integer_column_and_finite_edges(spark):
    spec = BinSpec("x", (0, 1, 3), labels=("low", "high"))
    df = spark.createDataFrame([(v,) for v in [-1, 0, 1, 2, 3, 4, None]], "x int")
    with_lowest = [r[0] for r in df.select(E.bin_label(spec, True)).collect()]
    without = [r[0] for r in df.select(E.bin_label(spec, False)).collect()]
    assert with_lowest == [None, "low", "low", "high", "high", None, None]
    assert without == [None, None, "low", "high", "high", None, None]


SPEC = BinSpec("x", (-inf, 0, 1, 2, inf), RISING)


def table(spark, rows):
    df = spark.createDataFrame(rows, "x double, y int")
    return {r.bin: r for r in E.woe_table(df, [SPEC], "y").collect()}, df


def test_zero_shares_get_the_floor_and_missing_rows_count_in_the_totals(spark):
    rows = [(0.0, 0)] * 4 + [(1.0, 1)] * 2 + [(3.0, 1), (3.0, 0)] + [(None, 1), (float("nan"), 0)]
    found, _ = table(spark, rows)
    assert set(found) == {"C1", "C2", "C4"}  # no row for the absent class, none for missing values
    events, others = 4, 6
    assert found["C1"].pct_events == 0.0001 and found["C1"].pct_non_events == pytest.approx(4 / others)
    assert found["C2"].pct_non_events == 0.0001
    assert found["C4"].pct_events == pytest.approx(1 / events)
    assert found["C1"].woe == pytest.approx(log(0.0001 / (4 / others)))
    assert found["C4"].iv == pytest.approx((1 / events - 1 / others) * log((1 / events) / (1 / others)))
    assert (found["C2"].total, found["C2"].rate_pct) == (2, 100.0)


def test_equals_pandas_calculation(applicants, pandas_applicants):
    frame = pandas_applicants
    rows = E.woe_table(applicants, CONFIG.bins, "default_12m").toPandas()
    events = frame.default_12m.sum()
    for spec in CONFIG.bins:
        labels = pd.cut(frame[spec.variable], list(spec.edges), labels=list(spec.names))
        grouped = frame.groupby(labels, observed=True)["default_12m"].agg(["sum", "count"])
        share1 = (grouped["sum"] / events).where(grouped["sum"] > 0, 0.0001)
        share0 = ((grouped["count"] - grouped["sum"]) / (len(frame) - events)).where(
            grouped["count"] > grouped["sum"], 0.0001
        )
        want = np.log(share1 / share0)
        mine = rows[rows.variable == spec.variable].set_index("bin")["woe"]
        assert mine[list(want.index)].to_numpy() == pytest.approx(want.to_numpy())


def test_power_classes(spark):
    rows = [(f"v{i}", iv) for i, iv in enumerate([0.0, 0.02, 0.1, 0.3, 0.5, 0.0199])]
    df = spark.createDataFrame(rows, "variable string, iv double")
    summary = {r.variable: r.power for r in E.iv_summary(df, CONFIG.power_classes).collect()}
    assert summary == {
        "v0": "Tres faible", "v1": "Faible", "v2": "Moyen", "v3": "Fort", "v4": "Tres fort", "v5": "Tres faible",
    }
    kept = {r.variable for r in E.kept_variables(df, CONFIG.minimum_iv).collect()}
    assert kept == {"v1", "v2", "v3", "v4"}
    assert E.total_iv(df).first().total_iv == pytest.approx(0.9399)


def test_unrelated_variable_is_weak(spark):
    rows = [(float(x), y) for x in range(4) for y in [1] + [0] * 5]
    df = spark.createDataFrame(rows, "x double, y int")
    summary = E.iv_summary(E.woe_table(df, [SPEC], "y"), CONFIG.power_classes).first()
    assert summary.iv == pytest.approx(0.0) and summary.power == "Tres faible"


@pytest.mark.parametrize(
    "rates, direction, expected",
    [
        ([1, 2, 3, 4], RISING, (True, True)),
        ([1, 2, 3, 4], FALLING, (False, False)),
        ([4, 3, 2, 1], FALLING, (True, True)),
        ([1, 2, 2, 4], RISING, (True, False)),
        ([1, 3, 2, 4], RISING, (False, False)),
        ([2], RISING, (True, True)),
    ],
)
def test_monotonicity(spark, rates, direction, expected):
    rows = [("x", i, float(r), float(r) - 2.5) for i, r in enumerate(rates, 1)]
    df = spark.createDataFrame(rows, "variable string, bin_no int, rate_pct double, woe double")
    found = E.monotonicity(df, [BinSpec("x", SPEC.edges, direction)]).first()
    assert (found.rate_monotone, found.woe_monotone) == expected


def test_transform_uses_rounded_values_and_gives_null_for_unseen_classes(spark):
    _, df = table(spark, [(0.0, 0)] * 3 + [(1.0, 1)] * 2 + [(5.0, 0), (5.0, 1)])
    maps = E.woe_maps(E.woe_table(df, [SPEC], "y"))
    assert all(v == round(v, 4) for v in maps["x"].values())
    new = spark.createDataFrame([(0, -3.0), (1, 2.0), (2, 9.0), (3, None), (4, float("nan"))], "i int, x double")
    got = [r.x for r in E.apply_woe(new, [SPEC], maps).orderBy("i").collect()]
    assert got == [maps["x"]["C1"], None, maps["x"]["C4"], None, None]


def test_bin_table(spark):
    rows = E.bin_table(spark.range(1), CONFIG.bins).collect()
    assert len(rows) == 8 and rows[0].edges == [-inf, 500.0, 600.0, 680.0, inf]


def test_same_result_for_any_partitioning(applicants):
    results = [
        sorted(map(tuple, E.rounded_woe_table(E.woe_table(applicants.repartition(n), CONFIG.bins, "default_12m")).collect()))
        for n in (1, 17)
    ]
    assert results[0] == results[1]


def test_one_shuffle_before_the_small_windows(applicants):
    plan = E.woe_table(applicants, CONFIG.bins, "default_12m")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("Exchange hashpartitioning") == 2  # groups, then the window over them
    assert "Join" not in plan
