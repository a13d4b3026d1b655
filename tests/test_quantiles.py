"""Exact quantiles against numpy, on the small-group path and on the narrowing path."""

from __future__ import annotations

import math

import numpy as np
import pytest

from scoreloom.operators.quantiles import exact_quantiles, quantile_table

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def expected(values):
    known = [v for v in values if v is not None and not math.isnan(v)]
    return [float(np.quantile(known, p)) for p in PROBABILITIES] if known else [None] * len(PROBABILITIES)


def columns_of_kinds():
    rng = np.random.default_rng(7)
    n = 400
    return {
        "uniform": rng.uniform(-5, 5, n).tolist(),
        "heavy_tail": [float(x) for x in np.exp(rng.normal(0, 6, n))],
        "hot_value": [3.0 if i % 3 == 0 else float(rng.normal(3, 2)) for i in range(n)],
        "constant": [2.5] * n,
        "integers": [float(i % 7) for i in range(n)],
        "with_missing": [None if i % 4 == 0 else (float("nan") if i % 4 == 1 else float(i)) for i in range(n)],
        "clustered": [1e9 + i / 1e4 for i in range(n - 1)] + [-1e12],
        "empty": [None] * n,
    }


@pytest.mark.parametrize("small, cells", [(1_000_000, 1024), (10, 16), (1, 4), (0, 8)])
def test_equals_numpy(spark, small, cells):
    data = columns_of_kinds()
    names = list(data)
    rows = list(zip(*data.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5)
    found = exact_quantiles(df, names, PROBABILITIES, small_group_rows=small, cells=cells)
    for c in names:
        want = expected(data[c])
        if want[0] is None:
            assert found[None, c] == want
        else:
            assert found[None, c] == pytest.approx(want, rel=1e-12), c


@pytest.mark.parametrize("small", [1_000_000, 5])
def test_by_class_skips_rows_without_class(spark, small):
    rows = [(i % 2, float(i)) for i in range(101)] + [(None, 1e6)] * 20
    df = spark.createDataFrame(rows, "y int, x double")
    found = exact_quantiles(df, ["x"], [0.25, 0.5], by="y", small_group_rows=small, cells=4)
    assert set(found) == {(0, "x"), (1, "x")}
    for y in (0, 1):
        values = [x for c, x in rows if c == y]
        assert found[y, "x"] == pytest.approx(list(np.quantile(values, [0.25, 0.5])))


def test_infinite_values(spark):
    values = [float("-inf")] * 3 + [1.0, 2.0, 4.0, 8.0] + [float("inf")] * 3
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = exact_quantiles(df, ["x"], [0.0, 3 / 9, 5 / 9, 1.0], small_group_rows=1, cells=4)[None, "x"]
    assert found[0] == float("-inf") and found[3] == float("inf")
    assert found[1:3] == pytest.approx([1.0, 4.0])


def test_same_result_for_any_partitioning(applicants):
    columns = ["monthly_income", "dti"]
    results = [
        exact_quantiles(applicants.repartition(n), columns, [0.5, 0.99], small_group_rows=50, cells=32)
        for n in (1, 17)
    ]
    assert results[0] == results[1]


@pytest.mark.parametrize("small", [1_000_000, 6])
def test_a_table_of_many_groups(spark, small):
    """Groups of every size, one with a third of the rows; two keys, one of them null in some rows."""
    rng = np.random.default_rng(3)
    rows = [(int(g) if g % 17 else None, "abc"[g % 3], float(x), None if x > 0.5 else float(x)) for g, x in zip(rng.integers(0, 400, 4000), rng.normal(size=4000))]
    rows += [(7, "a", float(x), 1.0) for x in rng.normal(size=2000)] + [(7, "b", None, float("nan"))]
    df = spark.createDataFrame(rows, "g int, h string, x double, y double").repartition(7)
    groups = {}
    for g, h, x, y in rows:
        if g is not None:
            for c, v in (("x", x), ("y", y)):
                groups.setdefault((g, h, c), []).append(v)
    found = {(r.g, r.h, r.variable): r.quantiles for r in quantile_table(df, ["x", "y"], PROBABILITIES, ["g", "h"], small, 8).collect()}
    assert set(found) == set(groups)
    for key, values in groups.items():
        want = expected(values)
        assert found[key] == (want if want[0] is None else pytest.approx(want, rel=1e-12)), key


def test_groups_never_pass_through_the_driver(spark, monkeypatch):
    """10^6 groups, of which one has half of the rows: only sizes are read, group by group nothing."""
    from pyspark.sql.classic.dataframe import DataFrame

    df = spark.range(2_000_000).selectExpr("CASE WHEN id % 2 = 0 THEN -1 ELSE id END AS g", "CAST(id AS DOUBLE) AS x")
    read = []
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: read.append(collect(self)) or read[-1])
    table = quantile_table(df, ["x"], [0.5], ["g"], small_group_rows=1000)
    assert sum(map(len, read)) < 10
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan
    monkeypatch.undo()
    assert table.count() == 1_000_001
    assert table.where("g = -1").first().quantiles == [999_999.0]
    assert table.where("g <> -1 AND quantiles[0] <> g").isEmpty()
