"""Scoring of tables and streams."""

from __future__ import annotations

from math import exp, log

import pytest
from pyspark.sql import functions as F

from catalog import frozen
from scoreloom.config import RISK_BANDS, CreditConfig
from scoreloom.functions.scoring import contributions, risk_band
from scoreloom.operators import score as H
from scoreloom.sources.applicants import (
    APPLICANT_SCHEMA,
    preview,
    read_applicants,
    table_shape,
    write_snapshot,
)
from scoreloom.storage import new_path
from scoreloom.streaming import scoring as S
from scoreloom.streaming.scoring import input_contract, read_applicant_stream, read_batches, score_stream, start_scoring, start_sink

CONFIG = CreditConfig()
CARD = frozen.scorecard({"bureau_score": 575.0, "monthly_income": 1914.0}, {"monthly_income": 4300.0, "dti": 0.93, "utilization_rate": 1.0})
CLIENT = (
    "SELECT 1L AS customer_id, 601D AS bureau_score, 2500D AS monthly_income, 0.5D AS dti, 0.7D AS utilization_rate, "
    "50 AS num_credit_lines, 1 AS missed_payments_3m, 5 AS overdrawn_days_3m, 15 AS max_dpd_12m, "
    "0 AS salary_domiciliation, 'Unemployed' AS employment_status"
)


def test_worked_example_with_an_absent_feature(spark):
    """Without the inquiries column the feature counts as 0; an unused column changes nothing."""
    row = H.score(spark.sql(CLIENT), CARD, keep=["customer_id"]).first()
    logit = 0.8 * (-0.9 + 0.0 - 0.4 + 0.1 + 0.1 + 0.0 + 0.1) + 0.9 - 1.9
    assert log(row.pd / (1 - row.pd)) == pytest.approx(logit)
    assert row.pd == pytest.approx(1 / (1 + exp(-logit)))
    assert (row.pd_score, row.pd_pct) == (0.1419, 14.19)
    assert tuple(row.risk_band) == ("Faible", "#27AE60", "Approuver", 1)
    assert row.recommendation == "Approuver"
    assert len(row.top_drivers) == 5 and len(row.contributions) == len(frozen.COEFFICIENTS)
    assert dict(map(tuple, row.contributions))["number_of_credit_inquiries_6m"] == 0.0


def test_contributions_add_up_to_the_logit(applicants):
    scored = H.score(applicants, CARD, keep=["customer_id"])
    total = F.aggregate("contributions", F.lit(frozen.INTERCEPT), lambda a, e: a + e["value"])
    gap = F.abs(total - F.ln(F.col("pd") / (1 - F.col("pd"))))
    assert scored.agg(F.max(gap)).first()[0] < 1e-9


def test_band_limits(spark):
    values = [0.0, 0.149999, 0.15, 0.35, 0.55, 1.0, None, -0.1]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, pd double")
    levels = [r.b.level if r.b else None for r in df.select("i", risk_band("pd", RISK_BANDS).alias("b")).orderBy("i").collect()]
    assert levels == [1, 1, 2, 3, 4, 4, None, 4]


def test_driver_order(spark):
    df = spark.createDataFrame([(1.0, -1.0, 2.0, 0.0)], "a double, b double, c double, d double")
    weights = {"a": 1.0, "b": 1.0, "c": -1.0, "d": 1.0}
    listed = df.select(F.lit(1).alias("k"), contributions(weights, df.columns).alias("contributions"))
    rows = H.drivers(listed, ["k"], "contributions").orderBy("rank").collect()
    assert [(r.rank, r.feature, r.contribution) for r in rows] == [
        (1, "c", -2.0), (2, "a", 1.0), (3, "b", -1.0), (4, "d", 0.0),
    ]


def test_driver_display(spark):
    df = spark.createDataFrame([("employment_status_Self_Employed", 0.1234), ("max_dpd_12m", -1.0), ("dti", 0.0)], "feature string, contribution double")
    rows = H.driver_display(df, "employment_status").collect()
    assert [(r.effect, r.label, r.text) for r in rows] == [
        ("risk", "emp Self Employed", "+0.123"), ("protective", "max dpd 12m", "-1.000"), ("protective", "dti", "+0.000"),
    ]


def test_display_names(spark):
    df = spark.createDataFrame([("Student", 1), ("Retired", 0), (None, None)], "employment_status string, salary_domiciliation int")
    rows = H.display_categories(df, "employment_status", CONFIG.category_names, "salary_domiciliation", CONFIG.flag_names).collect()
    assert [(r.employment_status_name, r.salary_domiciliation_name) for r in rows] == [
        ("Étudiant", "Oui"), ("Retired", "Non"), (None, None),
    ]


def test_scoring_is_one_stage_of_native_columns(applicants):
    plan = H.score(applicants, CARD, keep=["customer_id"])._jdf.queryExecution().executedPlan().toString()
    for word in ("Exchange", "Join", "BatchEvalPython", "ArrowEvalPython", "Sort "):
        assert word not in plan


def test_scoring_reads_only_the_columns_it_needs(applicants):
    plan = H.score(applicants, CARD).select("pd")._jdf.queryExecution().executedPlan().toString()
    assert "default_12m" not in plan.split("ReadSchema")[1]


def test_portfolio(applicants):
    rows = H.portfolio_summary(H.score(applicants, CARD, keep=["default_12m"]), "default_12m").collect()
    assert sum(r.n for r in rows) == 1500 and {r.level for r in rows} <= {1, 2, 3, 4}
    by_level = sorted(rows, key=lambda r: r.level)
    assert [r.mean_pd for r in by_level] == sorted(r.mean_pd for r in by_level)


def test_stream_equals_batch(spark, applicants):
    folder = new_path(spark, "incoming")
    applicants.repartition(6).write.json(folder)
    scored, refused = score_stream(read_applicant_stream(spark, folder, maxFilesPerTrigger="2"), CARD, CONFIG, ["customer_id"])
    out = {}
    for name, stream in (("scored", scored), ("refused", refused)):
        out[name] = new_path(spark, name)
        query = start_sink(stream, out[name], new_path(spark, name + "-checkpoint"), once=True)
        query.awaitTermination()
    streamed = spark.read.parquet(out["scored"])
    batch = H.score(applicants.where("bureau_score IS NOT NULL AND monthly_income IS NOT NULL"), CARD, ["customer_id"])
    assert "timestamp" in streamed.columns
    assert streamed.drop("timestamp").exceptAll(batch).count() == 0
    assert batch.exceptAll(streamed.drop("timestamp")).count() == 0
    assert streamed.count() + spark.read.parquet(out["refused"]).count() == 1500


def test_one_query_writes_both_tables_also_when_it_ends_between_them(spark, applicants, monkeypatch):
    """Ended after the first of the two writes of the second batch, then started again."""
    folder = new_path(spark, "incoming")
    applicants.repartition(6).write.json(folder)
    paths = [new_path(spark, n) for n in ("scored", "refused", "checkpoint")]
    write, calls = S.write_batch, []

    def write_or_end(rows, path, number):
        calls.append((path, number))
        if len(calls) == 4:
            raise RuntimeError("ended between the writes")
        write(rows, path, number)

    def run():
        stream = read_applicant_stream(spark, folder, maxFilesPerTrigger="2")
        return start_scoring(stream, CARD, CONFIG, ["customer_id"], *paths, once=True)

    monkeypatch.setattr(S, "write_batch", write_or_end)
    with pytest.raises(Exception, match="ended between"):
        run().awaitTermination()
    assert calls == [(paths[0], 0), (paths[1], 0), (paths[0], 1), (paths[1], 1)]
    before = read_batches(spark, paths[0]).where("batch_id = 1").count()
    stamps = read_batches(spark, paths[0]).where("batch_id = 1").select("timestamp").distinct().collect()
    run().awaitTermination()
    assert calls[4:6] == [(paths[0], 1), (paths[1], 1)]
    scored, refused = (read_batches(spark, p) for p in paths[:2])
    assert scored.where("batch_id = 1").count() == before > 0
    assert scored.where("batch_id = 1").select("timestamp").distinct().collect() == stamps
    batch = H.score(applicants.where("bureau_score IS NOT NULL AND monthly_income IS NOT NULL"), CARD, ["customer_id"])
    again = scored.drop("timestamp", "batch_id")
    assert again.exceptAll(batch).isEmpty() and batch.exceptAll(again).isEmpty()
    assert scored.count() + refused.count() == 1500
    assert refused.select("customer_id").distinct().count() == refused.count()
    run().awaitTermination()  # nothing new has arrived
    assert read_batches(spark, paths[0]).count() == scored.count()


def test_a_batch_is_read_and_validated_once(spark, applicants, monkeypatch):
    """Both writes come from the held batch: the plan of neither reads the input."""
    folder, plans = new_path(spark, "incoming"), []
    applicants.coalesce(1).write.json(folder)
    paths = [new_path(spark, n) for n in ("scored", "refused", "checkpoint")]
    monkeypatch.setattr(S, "write_batch", lambda rows, path, number: plans.append(rows._jdf.queryExecution().executedPlan().toString()))
    start_scoring(read_applicant_stream(spark, folder), CARD, CONFIG, ["customer_id"], *paths, once=True).awaitTermination()
    assert len(plans) == 2 and all("InMemoryTableScan" in p for p in plans)


def test_contract_of_a_scorecard():
    required = {r.column for r in input_contract(CONFIG, CARD).rules if r.required}
    assert required == {r.column for r in CONFIG.rules} - {"num_credit_lines"}
    assert {r.column for r in input_contract(CONFIG, CARD).rules} == {r.column for r in CONFIG.rules}


def test_drivers_add_no_filter_on_the_score(applicants):
    """A filter on the list's size would be pushed below the score and evaluate it twice."""
    plan = H.drivers(H.score(applicants, CARD, keep=["customer_id"]), ["customer_id"])._jdf.queryExecution().toString()
    optimized = plan.split("== Optimized Logical Plan ==")[1]
    assert "size(" not in optimized and "posexplode" in optimized


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_scan_formats_and_nan(spark, applicants, fmt):
    path = new_path(spark, fmt)
    writer = applicants.withColumn("dti", F.when(F.col("customer_id") == 5, F.lit(float("nan"))).otherwise(F.col("dti"))).write
    (writer.option("header", "true") if fmt == "csv" else writer).format(fmt).save(path)
    df = read_applicants(spark, path, fmt)
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in APPLICANT_SCHEMA.fields]
    assert df.count() == 1500
    assert df.where("dti IS NULL").select("customer_id").collect()[0].customer_id == 5
    assert df.where("isnan(dti)").count() == 0


def test_shape_preview_and_snapshot(spark, applicants):
    shape = table_shape(applicants).orderBy("position").collect()
    assert [r.column for r in shape] == APPLICANT_SCHEMA.fieldNames() and shape[0].n_rows == 1500
    assert [r.customer_id for r in preview(applicants, 3, "customer_id").collect()] == [0, 1, 2]
    copy = write_snapshot(applicants, new_path(spark, "copy"))
    assert copy.exceptAll(applicants).count() == 0 and copy.count() == 1500
