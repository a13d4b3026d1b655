"""Known numbers of the applicant view at sf0.01, and registered queries beside their SQL."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from catalog import frozen
from catalog import queries as Q
from tools.check_queries import TABLES, differences

SMALL = "/root/testdata/sf0.01"
TINY = "/root/testdata/sf0.001"

# class rows and events, WOE per class, at sf0.01 with imputed medians
WOE = {
    "bureau_score": [(4071, 1458, 1.2861), (4785, 539, -0.1945), (3278, 7, -4.2774), (2866, 0, -7.6986)],
    "max_dpd_12m": [(8996, 1200, -0.0018), (1693, 0, -7.1722), (3056, 300, -0.3483), (1255, 504, 1.4707)],
    "dti": [(1495, 0, -7.0478), (4456, 64, -2.3592), (5735, 835, 0.0999), (3314, 1105, 1.1768)],
    "monthly_income": [(4220, 1037, 0.7480), (6349, 607, -0.3775), (4094, 342, -0.5257), (337, 18, -1.0053)],
}
IV = {
    "bureau_score": 3.4470, "max_dpd_12m": 1.2402, "dti": 1.9848, "utilization_rate": 4.2527,
    "missed_payments_3m": 2.1843, "overdrawn_days_3m": 1.3263, "number_of_credit_inquiries_6m": 1.4465,
    "monthly_income": 0.3340,
}
BANDS = {1: (7440, 0.0405, 0.0023), 2: (2142, 0.2396, 0.0654), 3: (1743, 0.4525, 0.2008), 4: (3675, 0.7553, 0.4073)}


def test_woe_numbers(spark):
    rows = {(r.variable, r.bin_no): r for r in Q.e3_woe_table(spark, SMALL).collect()}
    for variable, classes in WOE.items():
        for i, (total, events, woe) in enumerate(classes, 1):
            r = rows[variable, i]
            assert (r.total, r.events, r.woe) == (total, events, pytest.approx(woe, abs=1e-4))


def test_iv_numbers(spark):
    assert {r.variable: r.iv for r in Q.e4_iv_summary(spark, SMALL).collect()} == pytest.approx(IV, abs=1e-4)


def test_not_monotone_variables(spark):
    rows = Q.e8_monotonicity(spark, SMALL).collect()
    assert {r.variable for r in rows if not r.woe_monotone} == {"max_dpd_12m", "missed_payments_3m", "overdrawn_days_3m"}


def test_band_numbers(spark):
    found = {r.level: (r.n, r.mean_pd, r.default_rate) for r in Q.h10_portfolio_summary(spark, SMALL).collect()}
    assert set(found) == set(BANDS)
    for level, values in BANDS.items():
        assert found[level] == pytest.approx(values, abs=1e-4)


def test_outlier_and_missing_numbers(spark):
    assert {r["column"]: r.n_missing for r in Q.d2_missing_values(spark, SMALL).collect()} == {
        "bureau_score": 366, "monthly_income": 518,
    }
    assert {r["column"]: r.n_outliers for r in Q.d9_extreme_outliers(spark, SMALL).collect()}["monthly_income"] == 149


CHECKED = (
    "a2_table_shape a4_fitted_parameters b6_quarantine c4_cap_audit c8_split c9_split_summary d3_rate_by_missing "
    "d6_class_histograms d8_box_statistics d10_rate_other_table d12_correlations d14_rate_by_bucket "
    "e3_woe_with_missing e3_woe_other_table e7_woe_dataset f2_balanced_saturated_fit f4_folds g3_roc_curve_ranges "
    "a5_run_log b6_contract c8_split_deep d8_box_narrowed e2_bin_table f3_optimality g5_optimal_threshold g6_ks_curve g10_classification_report h2_batch_scoring h5_top_drivers h9_stream_scoring "
    "h9_stream_quarantine g13_metric_summary"
).split()


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{TINY}/{t}.parquet')")
    return db


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, database, name):
    ours = entry.queries()[name](spark, TINY).toPandas()
    assert not differences(ours, database.execute(entry.oracle_sql()[name]).df())


def test_registration():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(Q.all_queries()) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_applicant_view_is_lazy_and_current(spark, tmp_path):
    from scoreloom.sources.applicants import applicant_table

    for name in ("orders", "customer"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    view = applicant_table(spark, str(tmp_path))
    read = view.select("customer_id", "employment_status")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in plan and "struct<c_custkey:bigint,c_mktsegment:string>" in plan
    assert {f.rsplit("/", 2)[-2] for f in read.inputFiles()} == {"orders.parquet", "customer.parquet"}
    before = view.count()
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").selectExpr("* EXCEPT (o_orderkey)", "o_orderkey + 1000000 AS o_orderkey").write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    assert applicant_table(spark, str(tmp_path)).count() == 2 * before


def test_unknown_parameters_are_kept_as_null(spark, tmp_path):
    from scoreloom.operators import prep as P
    from scoreloom.sources import params

    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    medians = P.fit_medians(df, ["a", "b"])
    caps = P.fit_caps(df, ["a", "b"])
    assert medians["a"] is None and caps["a"] is None
    audit = {r["column"]: (r["cap"], r["max_after"]) for r in P.cap_audit(df, caps).collect()}
    assert audit["a"] == (None, None)
    card = frozen.scorecard(medians, caps)
    card.save(spark, f"{tmp_path}/card")
    assert params.Scorecard.load(spark, f"{tmp_path}/card").medians == medians
    params.log_run(spark, f"{tmp_path}/runs", "r", "n", {}, {"auc": None, "f1": 0.5})
    assert {r["key"]: r["value"] for r in params.read_run_log(spark, f"{tmp_path}/runs").collect()} == {"auc": None, "f1": "0.5"}
