"""Scorecards as a table against the same cards as literals."""

from __future__ import annotations

from dataclasses import replace
from math import inf

import pytest
from pyspark.sql import functions as F

from catalog import frozen
from scoreloom.config import BinSpec, CreditConfig
from scoreloom.functions.columns import blocks, count_up_to
from scoreloom.operators import score as H
from scoreloom.operators.scorecards import card_table, score_many, woe_lookup
from scoreloom.operators.woe import apply_woe

CONFIG = CreditConfig()
CARD = frozen.scorecard({"bureau_score": 575.0, "monthly_income": 1914.0}, {"monthly_income": 4300.0, "dti": 0.93})
VARIABLES = [b.variable for b in CONFIG.bins]


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 100, 1024])
def test_search_in_blocks(spark, n):
    edges = [float(i // 2) for i in range(n)]
    df = spark.createDataFrame([(x, edges) for x in (-1.0, 0.0, 0.5, 7.0, 15.5, 16.0, n / 2, 1e9)], "x double, e array<double>")
    found = df.select("x", F.expr(blocks("e")).alias("b")).selectExpr("x", f"{count_up_to('x', 'b')} AS up", f"{count_up_to('x', 'b', True)} AS below")
    for r in found.collect():
        assert (r.up, r.below) == (sum(e <= r.x for e in edges), sum(e < r.x for e in edges)), r.x


def test_lookup_equals_literals(spark):
    """Each edge and its neighbours, missing values, a bounded specification and many classes."""
    edges = tuple(float(i) for i in range(70))
    bins = (BinSpec("a", (-inf, 0, 1, inf), "croissant"), BinSpec("b", edges, "croissant", tuple(f"k{i}" for i in range(69))))
    woe = {"a": {"C1": -1.0, "C2": 0.5}, "b": {f"k{i}": i / 7 for i in range(69)}}
    card = replace(CARD, bins=bins, woe=woe, coefficients={"a": 1.0, "b": 1.0}, medians={}, caps={})
    values = [None, float("nan"), -inf, inf, -1.0, 0.0, 1e-9, 0.5, 1.0, 1.5, 31.0, 31.5, 32.0, 33.0, 69.0, 69.1]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i int, a double, b double")
    cards = card_table(spark, {"one": card, "other": CARD})
    looked = woe_lookup(df.withColumn("card", F.lit("one")), cards, ["a", "b"], "card").select("i", "a", "b")
    assert sorted(map(tuple, looked.collect())) == sorted(map(tuple, apply_woe(df, bins, woe).collect()))
    unknown = woe_lookup(df.withColumn("card", F.lit("none")), cards, ["a", "b"], "card")
    assert unknown.where("a IS NOT NULL OR b IS NOT NULL").isEmpty() and unknown.count() == len(values)


def test_many_cards_in_one_pass(spark, applicants):
    """400 cards over the applicants: each row as if its card alone had scored it."""
    cards = {f"c{i}": replace(CARD, intercept=-3.0 + i / 100, coefficients={f: b * (1 + i % 5) for f, b in list(CARD.coefficients.items())[i % 3 :]}) for i in range(400)}
    table = card_table(spark, cards)
    rows = applicants.withColumn("segment", F.concat(F.lit("c"), F.col("customer_id") % 450))
    scored = score_many(rows, table, "segment", VARIABLES, ["salary_domiciliation"], "employment_status", ["customer_id"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Sort" not in plan
    found = {r.customer_id: r for r in scored.collect()}
    assert len(found) == 1500
    for i in (0, 1, 2, 137, 399):
        alone = H.score(applicants.where(f"customer_id % 450 = {i}"), cards[f"c{i}"], ["customer_id"]).collect()
        assert alone
        for r in alone:
            got = found[r.customer_id]
            assert got.pd == pytest.approx(r.pd, rel=1e-12) and tuple(got.risk_band) == tuple(r.risk_band)
            assert got.recommendation == r.recommendation and got.pd_score == pytest.approx(r.pd_score, abs=1e-4)
    assert all(r.pd is None and r.risk_band is None for r in found.values() if r.customer_id % 450 >= 400)
