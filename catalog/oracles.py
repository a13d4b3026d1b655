"""DuckDB SQL equivalent to each registered query, over the given tables."""

from __future__ import annotations

from math import inf, isinf

from catalog import frozen
from catalog.newton import newton_parts
from catalog.queries import CORRELATED, DOCUMENT_BINS, NUMERIC, SEGMENTS, STRICT_RULES
from scoreloom.config import BinSpec
from scoreloom.sources.applicants import APPLICANT_SCHEMA, applicants_sql

CONFIG = frozen.CONFIG
ID, TARGET = CONFIG.id_column, CONFIG.target
COLUMNS = APPLICANT_SCHEMA.fieldNames()
DUMMIES = CONFIG.dummy_columns
RAW_NUMERIC = [
    "bureau_score", "monthly_income", "dti", "utilization_rate", "missed_payments_3m",
    "overdrawn_days_3m", "max_dpd_12m", "number_of_credit_inquiries_6m",
]


def r(expression: str, digits: int = 6) -> str:
    return f"(round_even(CAST({expression} AS DOUBLE) * 1e{digits}, 0) / 1e{digits} + 0e0)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return text(value)
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    return str(value)


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def case_bins(spec: BinSpec, results: list, lowest: bool = True) -> str:
    v, low = spec.variable, spec.edges[0]
    whens = []
    if not isinf(low):
        whens.append(f"WHEN {v} {'<' if lowest else '<='} {low} THEN NULL")
    for edge, result in zip(spec.edges[1:], results):
        test = f"{v} IS NOT NULL" if edge == inf else f"{v} <= {edge}"
        whens.append(f"WHEN {test} THEN {literal(result)}")
    return f"CASE {' '.join(whens)} END"


# --- Common table expressions ------------------------------------------------

CTE: dict[str, str] = {
    "applicants": applicants_sql(),
    "medians": "SELECT quantile_cont(bureau_score, 0.5) AS m_score, quantile_cont(monthly_income, 0.5) AS m_income FROM applicants",
    "imputed": "SELECT a.* REPLACE (coalesce(bureau_score, m_score) AS bureau_score, coalesce(monthly_income, m_income) AS monthly_income) FROM applicants a, medians",
    "caps": "SELECT " + ", ".join(f"quantile_cont({c}, 0.99) AS cap_{c}" for c in CONFIG.cap_columns) + " FROM imputed",
    "capped": "SELECT i.* REPLACE ("
    + ", ".join(f"CASE WHEN {c} > cap_{c} THEN cap_{c} ELSE {c} END AS {c}" for c in CONFIG.cap_columns)
    + ") FROM imputed i, caps",
    "hashed": f"SELECT {ID}, {TARGET}, md5(concat({ID}, ':42')) AS h FROM applicants",
    "ranked": f"SELECT {ID}, {TARGET}, row_number() OVER (PARTITION BY {TARGET} ORDER BY h, {ID}) AS rk, ntile(5) OVER (PARTITION BY {TARGET} ORDER BY h, {ID}) - 1 AS fold FROM hashed",
    "sizes": f"SELECT {TARGET}, count(*) AS n, 0.2e0 * count(*) AS exact FROM applicants GROUP BY {TARGET}",
    "takes": f"SELECT {TARGET}, floor(exact) AS base, row_number() OVER (ORDER BY floor(exact) - exact, {TARGET}) AS fr, ceil(0.2e0 * sum(n) OVER ()) - sum(floor(exact)) OVER () AS missing FROM sizes",
    "split": f"SELECT {ID}, CASE WHEN rk <= base + CASE WHEN fr <= missing THEN 1 ELSE 0 END THEN 'test' ELSE 'train' END AS split FROM ranked JOIN takes USING ({TARGET})",
    "encoded": "SELECT * EXCLUDE (employment_status), "
    + ", ".join(f"CASE WHEN employment_status = '{v}' THEN 1 ELSE 0 END AS employment_status_{v}" for v in CONFIG.categories[1:])
    + " FROM capped JOIN split USING (customer_id)",
    "scaler": "SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in RAW_NUMERIC) + " FROM encoded WHERE split = 'train'",
    "standardized": "SELECT e.* REPLACE (" + ", ".join(f"(CAST({c} AS DOUBLE) - m_{c}) / s_{c} AS {c}" for c in RAW_NUMERIC) + ") FROM encoded e, scaler",
    "features": "SELECT c.* REPLACE ("
    + ", ".join(case_bins(b, [float(w) for w in frozen.WOE[b.variable]]) + f" AS {b.variable}" for b in CONFIG.bins)
    + "), "
    + ", ".join(f"CASE WHEN employment_status = '{v}' THEN 1 ELSE 0 END AS employment_status_{v}" for v in CONFIG.categories[1:])
    + " FROM capped c",
    "probabilities": "SELECT *, 1e0 / (1e0 + exp(-("
    + literal(frozen.INTERCEPT) + " + " + " + ".join(f"{literal(b)} * {f}" for f, b in frozen.COEFFICIENTS.items())
    + "))) AS p FROM features",
    "scored": f"SELECT {ID}, {TARGET}, {r('p', 8)} AS pd FROM probabilities",
    "woe_long": union([
        f"SELECT '{b.variable}' AS variable, {case_bins(b, list(range(1, 5)))} AS bin_no, {TARGET} AS y FROM imputed"
        for b in CONFIG.bins
    ]),
}


def woe_parts(source: str) -> dict[str, str]:
    """WOE measures of a long table ``(variable, bin_no, y)``."""
    floor = "CASE WHEN {0} = 0 THEN 0.0001e0 ELSE {0} END"
    share_events = "CAST(sum(y) AS DOUBLE) / any_value(all_events)"
    share_rest = "CAST(count(*) - sum(y) AS DOUBLE) / any_value(all_rows - all_events)"
    return {
        "totals": f"SELECT variable, sum(y) AS all_events, count(*) AS all_rows FROM {source} GROUP BY variable",
        "shares": f"SELECT variable, bin_no, sum(y) AS events, count(*) AS total, {floor.format('(' + share_events + ')')} AS pe, {floor.format('(' + share_rest + ')')} AS pn FROM {source} JOIN totals USING (variable) WHERE bin_no IS NOT NULL GROUP BY variable, bin_no",
        "woe": "SELECT *, ln(pe / pn) AS woe, (pe - pn) * ln(pe / pn) AS iv, 100e0 * events / total AS rate FROM shares",
    }


CTE |= woe_parts("woe_long")

WOE_COLUMNS = (
    "variable, bin_no, concat('C', bin_no) AS bin, " + big("events") + " AS events, " + big("total") + " AS total, "
    + big("total - events") + f" AS non_events, {r('pe', 4)} AS pct_events, {r('pn', 4)} AS pct_non_events, "
    + f"{r('woe', 4)} AS woe, {r('iv', 4)} AS iv, {r('rate', 4)} AS rate_pct"
)

CHAINS = {
    "applicants": ["applicants"],
    "imputed": ["applicants", "medians", "imputed"],
    "capped": ["applicants", "medians", "imputed", "caps", "capped"],
    "ranked": ["applicants", "hashed", "ranked"],
    "split": ["applicants", "hashed", "ranked", "sizes", "takes", "split"],
    "woe": ["applicants", "medians", "imputed", "woe_long", "totals", "shares", "woe"],
    "features": ["applicants", "medians", "imputed", "caps", "capped", "features"],
    "scored": ["applicants", "medians", "imputed", "caps", "capped", "features", "probabilities", "scored"],
}
CHAINS["encoded"] = [*CHAINS["split"], "medians", "imputed", "caps", "capped", "encoded"]
CHAINS["standardized"] = [*CHAINS["encoded"], "scaler", "standardized"]
CHAINS["scored_split"] = [*CHAINS["split"], *CHAINS["scored"][1:]]


def given(chain: str, body: str, **more: str) -> str:
    parts = [f"{n} AS MATERIALIZED (\n{CTE[n]}\n)" for n in CHAINS[chain]] + [f"{n} AS (\n{q}\n)" for n, q in more.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def recursive(chain: str, body: str, **more: str) -> str:
    return "WITH RECURSIVE " + given(chain, body, **more).removeprefix("WITH ")


def auc_sql(source: str, by: str = "") -> str:
    """Mann-Whitney form, from average ranks: independent of the curve."""
    part = f"PARTITION BY {by}" if by else ""
    both = f"PARTITION BY {by}, pd" if by else "PARTITION BY pd"
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return (
        f"SELECT {keys}(sum(CASE WHEN {TARGET} = 1 THEN ar END) - p * (p + 1) / 2) / (p * n) AS auc FROM ("
        f"SELECT *, rank() OVER ({part} ORDER BY pd) + (count(*) OVER ({both}) - 1) / 2e0 AS ar, "
        f"CAST(sum({TARGET}) OVER ({part}) AS DOUBLE) AS p, CAST(sum(1 - {TARGET}) OVER ({part}) AS DOUBLE) AS n FROM {source}) q "
        + (f"{group}, p, n" if by else "GROUP BY p, n")
    )


def curve_sql(source: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return (
        f"SELECT *, CAST(tp AS DOUBLE) / positives AS tpr, CAST(fp AS DOUBLE) / negatives AS fpr FROM ("
        f"SELECT {keys}threshold, pos, neg, sum(pos) OVER ({part} ORDER BY threshold DESC) AS tp, sum(neg) OVER ({part} ORDER BY threshold DESC) AS fp, "
        f"sum(pos) OVER ({part}) AS positives, sum(neg) OVER ({part}) AS negatives FROM ("
        f"SELECT {keys}pd AS threshold, sum({TARGET}) AS pos, sum(1 - {TARGET}) AS neg FROM {source} GROUP BY {keys}pd) c) d"
    )


def best_sql(curve: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"SELECT {keys}threshold, tpr - fpr AS gap FROM (SELECT *, row_number() OVER ({part} ORDER BY tpr - fpr DESC, threshold DESC) AS o FROM {curve}) q WHERE o = 1"


def cells_sql(source: str, decision: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    cells = ", ".join(
        f"{big(f'count(*) FILTER (WHERE {TARGET} = {y} AND {decision} = {d})')} AS {name}"
        for name, y, d in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    )
    return f"SELECT {keys}{cells} FROM {source}" + (f" GROUP BY {by}" if by else "")


MEASURES = (
    "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision, "
    "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall, "
    "coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, "
    "CAST(tn AS DOUBLE) / nullif(tn + fp, 0) AS specificity"
)

DECIDED = {
    "curve": curve_sql("scored"),
    "best": best_sql("curve"),
    "decided": "SELECT s.*, CASE WHEN pd >= threshold THEN 1 ELSE 0 END AS decision FROM scored s, best",
    "cells": cells_sql("decided", "decision"),
}


def histogram_sql(long: str, bins: int, digits: int, by_class: bool = True) -> dict[str, str]:
    """Parts ending in ``histogram``: equal-width bins per group of ``(variable, class, x)``."""
    return {
        "edges": f"SELECT variable, class, CASE WHEN min(x) = max(x) THEN min(x) - 0.5e0 ELSE min(x) END AS lo, CASE WHEN min(x) = max(x) THEN max(x) + 0.5e0 ELSE max(x) END AS hi, count(x) AS total FROM {long} WHERE x IS NOT NULL GROUP BY variable, class",
        "placed": f"SELECT variable, class, CAST(least(floor(round_even((x - lo) / (hi - lo) * {bins} * 1e9, 0) / 1e9) + 1, {bins}) AS INT) AS bin FROM {long} JOIN edges USING (variable, class) WHERE x IS NOT NULL",
        "counted": "SELECT variable, class, bin, count(*) AS n FROM placed GROUP BY variable, class, bin",
        "grid": f"SELECT variable, class, lo, hi, total, CAST(b AS INT) AS bin FROM edges, range(1, {bins + 1}) t(b)",
        "histogram": f"SELECT variable, class, bin, {r(f'lo + (bin - 1) * ((hi - lo) / {bins}e0)', digits)} AS low, {r(f'lo + bin * ((hi - lo) / {bins}e0)', digits)} AS high, {big('coalesce(n, 0)')} AS n, {r(f'coalesce(n, 0) / (total * ((hi - lo) / {bins}e0))', digits)} AS density FROM grid LEFT JOIN counted USING (variable, class, bin)",
    }


def contribution_long() -> str:
    return union([
        f"SELECT {ID}, {i} AS position, '{f}' AS feature, {literal(b)} * {f} AS contribution FROM features"
        for i, (f, b) in enumerate(frozen.COEFFICIENTS.items())
    ])


def driver_ranks(k: int) -> dict[str, str]:
    return {
        "terms": contribution_long(),
        "ranks": f"SELECT *, CAST(row_number() OVER (PARTITION BY {ID} ORDER BY abs(contribution) DESC, position) AS INT) AS rank FROM terms QUALIFY row_number() OVER (PARTITION BY {ID} ORDER BY abs(contribution) DESC, position) <= {k}",
    }


def band_field(field: str) -> str:
    uppers = [b.lower for b in CONFIG.bands[1:]]
    whens = " ".join(f"WHEN p < {u}e0 THEN {literal(getattr(b, field))}" for b, u in zip(CONFIG.bands, uppers))
    return f"CASE {whens} ELSE {literal(getattr(CONFIG.bands[-1], field))} END"


def errors_sql(rules, allow_null: bool) -> str:
    found = []
    for rule in rules:
        if rule.column not in COLUMNS:
            continue
        if not allow_null:
            found.append(f"CASE WHEN {rule.column} IS NULL THEN '{rule.column}:missing' END")
        if rule.allowed:
            found.append(f"CASE WHEN {rule.column} NOT IN ({', '.join(map(text, rule.allowed))}) THEN '{rule.column}:category' END")
        else:
            found.append(f"CASE WHEN {rule.column} < {rule.low} OR {rule.column} > {rule.high} THEN '{rule.column}:range' END")
    listed = ", ".join(found)
    counted = " + ".join(f"CAST(({f}) IS NOT NULL AS INT)" for f in found)
    return f"SELECT {ID}, concat_ws('|', {listed}) AS errors, {counted} AS n_errors FROM applicants"


def all_oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    columns = ", ".join(COLUMNS)
    kinds = {"bigint": "bigint", "double": "double", "int": "int", "string": "string"}

    o["a1_applicant_scan"] = given("applicants", "SELECT * FROM applicants")
    shape = ", ".join(
        f"({i}, '{f.name}', '{kinds[f.dataType.simpleString()]}')" for i, f in enumerate(APPLICANT_SCHEMA.fields, 1)
    )
    o["a2_table_shape"] = given(
        "applicants",
        f"SELECT c.position, c.\"column\", c.\"type\", n_rows FROM (VALUES {shape}) c(position, \"column\", \"type\"), (SELECT count(*) AS n_rows FROM applicants) n",
    )
    o["a3_raw_snapshot"] = o["a1_applicant_scan"]
    median_rows = [
        f"SELECT 'bureau_score' AS \"column\", 'median' AS stat, {r('m_score')} AS value FROM medians",
        f"SELECT 'monthly_income', 'median', {r('m_income')} FROM medians",
    ]
    o["a4_fitted_parameters"] = given(
        "capped", union(median_rows + [f"SELECT '{c}', 'cap', {r(f'cap_{c}')} FROM caps" for c in CONFIG.cap_columns])
    )
    o["a6_preview"] = given("applicants", f"SELECT * FROM applicants ORDER BY {ID} LIMIT 5")

    o["b1_drop_identifier"] = given("applicants", f"SELECT * EXCLUDE ({ID}) FROM applicants")
    features = ", ".join(c for c in COLUMNS if c not in (ID, TARGET))
    o["b2_features_and_label"] = given("applicants", f"SELECT {ID}, {features}, {TARGET} AS label FROM applicants")
    role_columns = [(c, "numeric", c) for c in RAW_NUMERIC] + [("salary_domiciliation", "binary", "salary_domiciliation")] + [
        (d, "binary", f"CASE WHEN employment_status = '{d.removeprefix('employment_status_')}' THEN 1 ELSE 0 END") for d in DUMMIES
    ]
    o["b3_column_roles"] = given(
        "applicants", union([f"SELECT '{c}' AS \"column\", '{role}' AS role, {r(f'avg({e})')} AS mean FROM applicants" for c, role, e in role_columns])
    )
    o["b4_class_values"] = given("applicants", f"SELECT bureau_score FROM applicants WHERE {TARGET} = 1 AND bureau_score IS NOT NULL")
    o["b5_missing_flags"] = given(
        "applicants", f"SELECT {ID}, CAST(bureau_score IS NULL AS INT) AS bureau_score_missing, CAST(monthly_income IS NULL AS INT) AS monthly_income_missing FROM applicants"
    )
    o["b6_validation"] = given("applicants", errors_sql(CONFIG.rules, False))
    o["b6_quarantine"] = given("applicants", f"SELECT * FROM ({errors_sql(STRICT_RULES, True)}) e WHERE n_errors > 0")
    o["b7_decision"] = given("scored", f"SELECT {ID}, CAST(pd >= 0.35e0 AS INT) AS decision, CAST(pd > 0.5e0 AS INT) AS default_decision FROM scored")

    o["c1_medians"] = given("imputed", union(median_rows))
    o["c2_imputed"] = given("imputed", f"SELECT {ID}, {r('bureau_score')} AS bureau_score, {r('monthly_income')} AS monthly_income FROM imputed")
    o["c3_capped"] = given("capped", f"SELECT {ID}, " + ", ".join(f"{r(c)} AS {c}" for c in CONFIG.cap_columns) + " FROM capped")
    o["c4_cap_audit"] = given(
        "capped",
        union([
            f"SELECT '{c}' AS \"column\", {r(f'(SELECT max({c}) FROM imputed)', 2)} AS max_before, {r(f'(SELECT cap_{c} FROM caps)', 2)} AS cap, {r(f'(SELECT max({c}) FROM capped)', 2)} AS max_after"
            for c in CONFIG.cap_columns
        ]),
    )
    dummies = ", ".join(f"CASE WHEN employment_status = '{d.removeprefix('employment_status_')}' THEN 1 ELSE 0 END AS {d}" for d in DUMMIES)
    o["c5_one_hot"] = given("applicants", f"SELECT {ID}, {dummies} FROM applicants")
    o["c6_standardized"] = given(
        "standardized",
        f"SELECT {ID}, split, salary_domiciliation, {', '.join(DUMMIES)}, " + ", ".join(f"{r(c)} AS {c}" for c in RAW_NUMERIC) + " FROM standardized",
    )
    n = len(RAW_NUMERIC)
    o["c7_standardization_check"] = given(
        "standardized",
        "SELECT " + r("(" + " + ".join(f"avg({c})" for c in RAW_NUMERIC) + f") / {n}e0") + " AS mean_of_means, "
        + r("(" + " + ".join(f"stddev_samp({c})" for c in RAW_NUMERIC) + f") / {n}e0") + " AS mean_of_deviations FROM standardized WHERE split = 'train'",
    )
    o["c8_split"] = given("split", f"SELECT {ID}, split FROM split")
    o["c9_split_summary"] = given(
        "split",
        f"SELECT split, count(*) AS n_rows, {r('count(*) / CAST(any_value(n) AS DOUBLE)')} AS share, {r(f'avg({TARGET})')} AS target_rate, {len(CONFIG.woe_features)} AS n_features FROM split JOIN applicants USING ({ID}), (SELECT count(*) AS n FROM applicants) a GROUP BY split",
    )

    o["d1_target_distribution"] = given(
        "applicants",
        f"SELECT {TARGET} AS class, count(*) AS n, {r('100e0 * count(*) / any_value(total)')} AS pct, {big('any_value(zeros // ones)')} AS imbalance_ratio FROM applicants, (SELECT count(*) AS total, sum(1 - {TARGET}) AS zeros, sum({TARGET}) AS ones FROM applicants) t GROUP BY {TARGET}",
    )
    o["d2_missing_values"] = given(
        "applicants",
        "SELECT \"column\", n_missing, pct_missing, CAST(pct_missing > 5 AS INT) AS above_alert FROM ("
        + union([f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing, {r(f'(count(*) - count({c})) * 100e0 / count(*)', 2)} AS pct_missing FROM applicants" for c in COLUMNS])
        + ") m WHERE n_missing > 0",
    )
    o["d2_missing_left"] = given("imputed", "SELECT " + big("sum(" + " + ".join(f"CAST({c} IS NULL AS INT)" for c in COLUMNS) + ")") + " AS n_missing FROM imputed")
    o["d3_rate_by_missing"] = given(
        "applicants",
        union([f"SELECT '{c}' AS \"column\", CAST({c} IS NULL AS INT) AS missing, count(*) AS n, {r(f'avg({TARGET})')} AS target_rate FROM applicants GROUP BY 1, 2" for c in CONFIG.impute_columns]),
    )
    o["d4_describe"] = given(
        "applicants",
        union([
            f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, {r(f'min({c})')} AS min, {r(f'quantile_cont({c}, 0.25)')} AS q25, {r(f'quantile_cont({c}, 0.5)')} AS q50, {r(f'quantile_cont({c}, 0.75)')} AS q75, {r(f'max({c})')} AS max FROM applicants"
            for c in NUMERIC
        ]),
    )
    o["d5_shape"] = given(
        "applicants", union([f"SELECT '{c}' AS \"column\", {r(f'skewness({c})', 3)} AS skewness, {r(f'kurtosis({c})', 3)} AS kurtosis FROM applicants" for c in NUMERIC])
    )
    long = union([f"SELECT '{c}' AS variable, {TARGET} AS class, CAST({c} AS DOUBLE) AS x FROM applicants" for c in NUMERIC])
    o["d6_class_histograms"] = given("applicants", "SELECT * FROM histogram", long=long, **histogram_sql("long", 40, 8))
    o["d7_capping_histograms"] = given(
        "capped",
        "SELECT 'capping' AS step, class AS stage, variable, bin, low, high, n FROM histogram",
        long=union([
            "SELECT 'monthly_income' AS variable, 'before' AS class, monthly_income AS x FROM applicants",
            "SELECT 'monthly_income', 'after', monthly_income FROM capped",
        ]),
        **histogram_sql("long", 60, 6),
    )
    o["d7_scaling_histograms"] = given(
        "standardized",
        "SELECT 'scaling' AS step, class AS stage, variable, bin, low, high, n FROM histogram",
        long=union([
            "SELECT 'bureau_score' AS variable, 'before' AS class, bureau_score AS x FROM encoded WHERE split = 'train'",
            "SELECT 'bureau_score', 'after', bureau_score FROM standardized WHERE split = 'train'",
        ]),
        **histogram_sql("long", 40, 6),
    )
    o["d8_box_statistics"] = given(
        "applicants",
        f"SELECT variable, class, {r('q1')} AS q1, {r('q2')} AS median, {r('q3')} AS q3, {r('least(min(CASE WHEN x >= q1 - 1.5e0 * (q3 - q1) THEN x END), q1)')} AS whisker_low, {r('greatest(max(CASE WHEN x <= q3 + 1.5e0 * (q3 - q1) THEN x END), q3)')} AS whisker_high, {big('count(CASE WHEN x < q1 - 1.5e0 * (q3 - q1) OR x > q3 + 1.5e0 * (q3 - q1) THEN 1 END)')} AS n_outside FROM long JOIN quartiles USING (variable, class) GROUP BY variable, class, q1, q2, q3",
        long=long,
        quartiles="SELECT variable, class, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2, quantile_cont(x, 0.75) AS q3 FROM long GROUP BY variable, class",
    )
    o["d9_extreme_outliers"] = given(
        "applicants",
        f"SELECT variable AS \"column\", {r('top')} AS upper_limit, count(*) AS n_outliers FROM long JOIN tops USING (variable) WHERE x > top GROUP BY variable, top",
        long=long,
        tops="SELECT variable, quantile_cont(x, 0.75) + 3 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) AS top FROM long GROUP BY variable",
    )

    def rates(source: str, column: str, target: str) -> str:
        return f"SELECT {column} AS value, count({target}) AS n, {r(f'avg({target})')} AS rate, {r(r(f'CAST(sum({target}) AS DOUBLE) / count({target}) * 100', 2))} AS rate_pct, {r(f'(SELECT avg({target}) * 100 FROM {source})')} AS overall_rate_pct FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"

    o["d10_rate_by_employment"] = given("applicants", rates("applicants", "employment_status", TARGET) + " ORDER BY rate DESC, value")
    o["d11_rate_by_salary_flag"] = given("applicants", rates("applicants", "salary_domiciliation", TARGET) + " ORDER BY value")
    pairs = [(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[:i]]
    o["d12_correlations"] = given(
        "applicants", union([f"SELECT '{a}' AS var_a, '{b}' AS var_b, {r(f'corr({a}, {b})')} AS r FROM applicants" for a, b in pairs])
    )
    o["d13_target_correlations"] = given(
        "applicants",
        "SELECT variable, r, CASE WHEN r > 0 THEN 'risk' WHEN r <= 0 THEN 'protective' END AS effect FROM ("
        + union([f"SELECT '{c}' AS variable, {r(f'corr({c}, {TARGET})')} AS r FROM applicants" for c in CORRELATED[:-1]])
        + ") c ORDER BY r",
    )
    o["d14_rate_by_bucket"] = given(
        "applicants",
        union([
            f"SELECT '{b.variable}' AS variable, {case_bins(b, list(range(1, len(b.names) + 1)), False)} AS position, {case_bins(b, list(b.names), False)} AS bucket, count(*) AS n, {r(f'avg({TARGET}) * 100')} AS rate_pct FROM applicants WHERE {case_bins(b, list(b.names), False)} IS NOT NULL GROUP BY 1, 2, 3"
            for b in CONFIG.rate_buckets
        ]),
    )

    o["e1_bin_labels"] = given("applicants", f"SELECT {ID}, " + ", ".join(f"{case_bins(b, list(b.names))} AS {b.variable}" for b in CONFIG.bins) + " FROM applicants")
    o["e3_woe_table"] = given("woe", f"SELECT {WOE_COLUMNS} FROM woe")
    raw_long = CTE["woe_long"].replace("FROM imputed", "FROM applicants")
    o["e3_woe_with_missing"] = given("applicants", f"SELECT {WOE_COLUMNS} FROM woe", raw_long=raw_long, **woe_parts("raw_long"))
    power = "CASE " + " ".join(f"WHEN iv < {b}e0 THEN '{n}'" for b, n in CONFIG.power_classes[:-1]) + f" ELSE '{CONFIG.power_classes[-1][1]}' END"
    direction = "CASE variable " + " ".join(f"WHEN '{b.variable}' THEN '{b.direction}'" for b in CONFIG.bins) + " END"
    iv = "SELECT variable, sum(iv) AS iv FROM woe GROUP BY variable"
    o["e4_iv_summary"] = given("woe", f"SELECT variable, {r('iv', 4)} AS iv, {power} AS power, {direction} AS direction FROM ({iv}) s")
    o["e5_total_iv"] = given("woe", f"SELECT {r('sum(iv)', 4)} AS total_iv FROM woe")

    def woe_case(b: BinSpec) -> str:
        picks = [f"(SELECT {r('woe', 4)} FROM woe WHERE variable = '{b.variable}' AND bin_no = {i})" for i in range(1, 5)]
        whens = " ".join(f"WHEN {b.variable} <= {e} THEN {p}" for e, p in zip(b.edges[1:-1], picks))
        return f"CASE {whens} WHEN {b.variable} IS NOT NULL THEN {picks[-1]} END AS {b.variable}"

    woe_columns = ", ".join(woe_case(b) for b in CONFIG.bins)
    o["e6_woe_values"] = given("woe", f"SELECT {ID}, {woe_columns} FROM applicants")
    o["e6_table_lookup"] = o["e6_woe_values"]
    o["e7_woe_dataset"] = given("woe", f"SELECT {ID}, {woe_columns}, salary_domiciliation, {dummies}, {TARGET} FROM imputed")
    o["e8_monotonicity"] = given(
        "woe",
        f"SELECT variable, direction, CAST(coalesce(bool_and(dr >= 0), TRUE) AS INT) AS rate_monotone, CAST(coalesce(bool_and(dw > 0), TRUE) AS INT) AS woe_monotone FROM (SELECT variable, direction, s * (rate - lag(rate) OVER w) AS dr, s * (woe - lag(woe) OVER w) AS dw FROM (SELECT *, {direction} AS direction, CASE WHEN {direction} = 'croissant' THEN 1 ELSE -1 END AS s FROM woe) d WINDOW w AS (PARTITION BY variable ORDER BY bin_no)) q GROUP BY variable, direction",
    )
    o["e9_kept_variables"] = given("woe", f"SELECT variable, {r('iv', 4)} AS iv FROM ({iv}) s WHERE iv >= 1.4e0")
    documents = "SELECT lang, n_chars, toxic FROM documents JOIN labels USING (doc_id)"
    spec = DOCUMENT_BINS[0]
    doc_parts = {
        "docs": documents,
        "doc_long": f"SELECT 'n_chars' AS variable, {case_bins(spec, list(range(1, 5)))} AS bin_no, toxic AS y FROM docs",
        **woe_parts("doc_long"),
    }
    o["e3_woe_other_table"] = "WITH " + ",\n".join(f"{n} AS (\n{q}\n)" for n, q in doc_parts.items()) + f"\nSELECT {WOE_COLUMNS} FROM woe"
    o["d10_rate_other_table"] = f"WITH docs AS ({documents})\n" + rates("docs", "lang", "toxic")

    status_rates = f"SELECT employment_status AS s, CAST(sum({TARGET}) AS DOUBLE) AS e, CAST(sum(1 - {TARGET}) AS DOUBLE) AS g FROM applicants GROUP BY 1"
    base = "SELECT ln(e / g) AS b FROM rates WHERE s = 'Permanent'"

    def saturated(shift: str) -> str:
        return (
            f"SELECT 'intercept' AS term, {r(f'b + {shift}', 3)} AS beta FROM base, weights UNION ALL "
            f"SELECT concat('employment_status_', s), {r('ln(e / g) - b', 3)} FROM rates, base WHERE s <> 'Permanent'"
        )

    weights = f"SELECT sum({TARGET}) AS ones, sum(1 - {TARGET}) AS zeros FROM applicants"
    fit = {"rates": status_rates, "base": base, "weights": weights}
    o["f1_saturated_fit"] = given("applicants", saturated("0"), **fit)
    o["f2_balanced_saturated_fit"] = given("applicants", saturated("ln(CAST(zeros AS DOUBLE) / ones)"), **fit)
    o["f2_class_weights"] = given(
        "applicants", f"SELECT {TARGET} AS class, {r('any_value(n) / (2e0 * count(*))')} AS weight FROM applicants, (SELECT count(*) AS n FROM applicants) t GROUP BY {TARGET}"
    )
    o["f4_folds"] = given("ranked", f"SELECT {ID}, CAST(fold AS INT) AS fold FROM ranked")
    per_fold_parts = {
        "rows": f"SELECT a.{ID}, a.{TARGET}, employment_status AS s, CAST(fold AS INT) AS fold FROM applicants a JOIN ranked USING ({ID})",
        "counts": f"SELECT fold, s, CAST(sum({TARGET}) AS DOUBLE) AS e, CAST(sum(1 - {TARGET}) AS DOUBLE) AS g FROM rows GROUP BY fold, s",
        "fits": "SELECT k.fold, c.s, sum(c.e) AS e, sum(c.g) AS g FROM (SELECT DISTINCT fold FROM counts) k JOIN counts c ON c.fold <> k.fold GROUP BY k.fold, c.s",
        "fitted": "SELECT fold, s, (e / sum(e) OVER w) / (e / sum(e) OVER w + g / sum(g) OVER w) AS p FROM fits WINDOW w AS (PARTITION BY fold)",
        "held": f"SELECT fold, {TARGET}, {r('p', 9)} AS pd, CAST(p > 0.5 AS INT) AS decision FROM rows JOIN fitted USING (fold, s)",
        "aucs": auc_sql("held", "fold"),
        "folds_cells": cells_sql("held", "decision", "fold"),
        "per_fold": f"SELECT fold, auc, f1 FROM aucs JOIN (SELECT fold, {MEASURES} FROM folds_cells) m USING (fold)",
    }
    o["f5_saturated_cross_validation"] = given("ranked", f"SELECT fold, {r('auc')} AS auc, {r('f1')} AS f1 FROM per_fold", **per_fold_parts)
    o["f5_saturated_summary"] = given(
        "ranked",
        f"SELECT {r('avg(auc)')} AS cv_auc_mean, {r('stddev_pop(auc)')} AS cv_auc_std, {r('avg(f1)')} AS cv_f1_mean, {r('stddev_pop(f1)')} AS cv_f1_std FROM per_fold",
        **per_fold_parts,
    )
    logged = [
        ("param", "C", "'1000000000000'"), ("param", "class_weight", "'balanced'"), ("param", "solver", "'lbfgs'"),
        ("param", "max_iter", "'1000'"), ("param", "n_features", f"'{len(DUMMIES)}'"),
        ("param", "train_size", "(SELECT CAST(count(*) AS VARCHAR) FROM applicants)"),
        *[
            ("metric", name, f"(SELECT CAST(round_even({value}, 4) AS VARCHAR) FROM per_fold)")
            for name, value in (
                ("cv_auc_mean", "avg(auc)"), ("cv_auc_std", "stddev_pop(auc)"), ("cv_f1_mean", "avg(f1)"), ("cv_f1_std", "stddev_pop(f1)"),
            )
        ],
    ]
    o["a5_run_log"] = given(
        "ranked",
        union([f"SELECT 'saturated' AS run_id, 'LogisticRegression_v1' AS run_name, '{kind}' AS kind, '{key}' AS key, {value} AS value" for kind, key, value in logged]),
        **per_fold_parts,
    )
    o["f6_coefficient_table"] = given(
        "applicants",
        f"SELECT concat('employment_status_', s) AS feature, {r('ln(e / g) - b', 3)} AS coefficient, {r('exp(ln(e / g) - b)', 3)} AS odds_ratio, CASE WHEN ln(e / g) > b THEN 'Risque' ELSE 'Protection' END AS effect FROM rates, base WHERE s <> 'Permanent' ORDER BY abs(coefficient) DESC, feature",
        rates=status_rates,
        base=base,
    )
    o["f7_probability"] = given("scored", f"SELECT {ID}, pd FROM scored")

    with_split = f"SELECT s.*, split FROM scored s JOIN split USING ({ID})"
    o["g1_auc_by_split"] = given("scored_split", f"SELECT split, {r('auc')} AS auc FROM aucs", split_scores=with_split, aucs=auc_sql("split_scores", "split"))
    o["g2_gini"] = given("scored", f"SELECT {r('auc')} AS auc, {r('2 * auc - 1')} AS gini FROM aucs", aucs=auc_sql("scored"))
    curve = {"curve": curve_sql("scored")}
    o["g3_roc_curve"] = given(
        "scored", f"SELECT {r('threshold', 8)} AS threshold, {r('fpr', 8)} AS fpr, {r('tpr', 8)} AS tpr FROM curve UNION ALL SELECT CAST('inf' AS DOUBLE), 0e0, 0e0", **curve
    )
    o["g3_roc_curve_ranges"] = given(
        "scored",
        f"SELECT {r('threshold', 8)} AS threshold, {big('pos')} AS pos, {big('neg')} AS neg, {big('tp')} AS tp, {big('fp')} AS fp, {r('fpr', 8)} AS fpr, {r('tpr', 8)} AS tpr FROM curve",
        **curve,
    )
    o["g4_ks"] = given(
        "scored",
        f"SELECT {r('max(abs(f1 - f0))')} AS ks FROM (SELECT pd, CAST(sum(pos) OVER w AS DOUBLE) / sum(pos) OVER () AS f1, CAST(sum(neg) OVER w AS DOUBLE) / sum(neg) OVER () AS f0 FROM (SELECT pd, sum({TARGET}) AS pos, sum(1 - {TARGET}) AS neg FROM scored GROUP BY pd) c WINDOW w AS (ORDER BY pd)) d",
    )
    o["g5_optimal_threshold"] = given("scored", f"SELECT {r('threshold', 8)} AS threshold, {r('gap', 8)} AS ks_curve FROM best", curve=curve_sql("scored"), best=best_sql("curve"))
    o["g6_ks_curve"] = given(
        "scored",
        f"SELECT point, {r('point / 299e0')} AS threshold, {r('c0')} AS cum_class0, {r('c1')} AS cum_class1, {r('abs(c1 - c0)')} AS gap, CAST(row_number() OVER (ORDER BY abs(c1 - c0) DESC, point) = 1 AS INT) AS is_largest FROM shares",
        points="SELECT CAST(i AS INT) AS point FROM range(0, 300) t(i)",
        shares=f"SELECT point, CAST(count(*) FILTER (WHERE {TARGET} = 0 AND pd <= point / 299e0) AS DOUBLE) / count(*) FILTER (WHERE {TARGET} = 0) AS c0, CAST(count(*) FILTER (WHERE {TARGET} = 1 AND pd <= point / 299e0) AS DOUBLE) / count(*) FILTER (WHERE {TARGET} = 1) AS c1 FROM points, scored GROUP BY point",
    )
    o["g7_confusion"] = given("scored", "SELECT tn, fp, fn, tp FROM cells", **DECIDED)
    o["g8_confusion_shares"] = given(
        "scored",
        f"SELECT {TARGET} AS actual, decision AS predicted, count(*) AS n, {r('count(*) / CAST(any_value(total) AS DOUBLE)')} AS share FROM decided JOIN (SELECT {TARGET}, count(*) AS total FROM decided GROUP BY {TARGET}) t USING ({TARGET}) GROUP BY {TARGET}, decision",
        **DECIDED,
    )
    o["g9_threshold_metrics"] = given(
        "scored",
        f"SELECT tn, fp, fn, tp, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1, {r('specificity')} AS specificity FROM (SELECT *, {MEASURES} FROM cells) m",
        **DECIDED,
    )
    classes = (
        "SELECT 'Non-defaut' AS row, CAST(tn AS DOUBLE) / (tn + fn) AS p, CAST(tn AS DOUBLE) / (tn + fp) AS re, 2e0 * tn / (2 * tn + fn + fp) AS f, tn + fp AS support FROM cells UNION ALL "
        "SELECT 'Defaut', CAST(tp AS DOUBLE) / (tp + fp), CAST(tp AS DOUBLE) / (tp + fn), 2e0 * tp / (2 * tp + fp + fn), tp + fn FROM cells"
    )
    o["g10_classification_report"] = given(
        "scored",
        f"SELECT row, {r('p')} AS precision, {r('re')} AS recall, {r('f')} AS f1, {big('support')} AS support FROM ("
        "SELECT * FROM classes UNION ALL "
        "SELECT 'accuracy', CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp), CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp), CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp), tn + fp + fn + tp FROM cells UNION ALL "
        "SELECT 'macro avg', avg(p), avg(re), avg(f), sum(support) FROM classes UNION ALL "
        "SELECT 'weighted avg', sum(p * support) / sum(support), sum(re * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM classes) q",
        **DECIDED,
        classes=classes,
    )
    o["g11_score_histogram"] = given(
        "scored", "SELECT * FROM histogram", long=f"SELECT 'pd' AS variable, {TARGET} AS class, pd AS x FROM scored", **histogram_sql("long", 50, 7)
    )
    o["g12_score_summary"] = given(
        "scored",
        f"SELECT {r('min(pd)')} AS min_score, {r('max(pd)')} AS max_score, {r(f'avg(pd) FILTER (WHERE {TARGET} = 1)')} AS mean_class1, {r(f'avg(pd) FILTER (WHERE {TARGET} = 0)')} AS mean_class0 FROM scored",
    )
    gate = {
        "split_scores": with_split,
        "aucs": auc_sql("split_scores", "split"),
        "test_rows": "SELECT * FROM split_scores WHERE split = 'test'",
        "curve": curve_sql("test_rows"),
        "best": best_sql("curve"),
        "decided": "SELECT t.*, CASE WHEN pd >= threshold THEN 1 ELSE 0 END AS decision FROM test_rows t, best",
        "cells": cells_sql("decided", "decision"),
        "measures": f"SELECT {MEASURES} FROM cells",
        "test_auc": "SELECT auc FROM aucs WHERE split = 'test'",
        "long": "SELECT 'auc' AS metric, auc AS value FROM test_auc UNION ALL SELECT 'gini', 2 * auc - 1 FROM test_auc UNION ALL "
        "SELECT 'ks', max(abs(tpr - fpr)) FROM curve UNION ALL SELECT 'f1', f1 FROM measures UNION ALL "
        "SELECT 'auc_gap', abs(max(auc) - min(auc)) FROM aucs",
        "limits": "SELECT * FROM (VALUES " + ", ".join(f"('{x.metric}', '{x.relation}', {literal(float(x.bound))})" for x in CONFIG.limits) + ") v(metric, relation, bound)",
    }
    o["g13_benchmark_gate"] = given(
        "scored_split",
        f"SELECT metric, {r('value')} AS value, relation, bound, CAST(CASE relation WHEN '>=' THEN value >= bound WHEN '>' THEN value > bound WHEN '<' THEN value < bound END AS INT) AS passed FROM long LEFT JOIN limits USING (metric)",
        **gate,
    )
    linear = literal(frozen.STANDARDIZED_INTERCEPT) + " + " + " + ".join(f"{literal(b)} * {f}" for f, b in frozen.STANDARDIZED_COEFFICIENTS.items())
    compared = [
        ("AUC-ROC", "auc"), ("Gini", "2 * auc - 1"), ("KS", "ks"), ("Rappel", "recall"), ("Precision", "precision"),
        ("F1-Score", "f1"), ("TP", "tp"), ("FP", "fp"), ("FN", "fn"), ("TN", "tn"),
    ]
    CHAINS["comparison"] = [*CHAINS["standardized"], "features", "probabilities", "scored"]
    o["g14_model_comparison"] = given(
        "comparison",
        "SELECT position, metric, max(value) FILTER (WHERE model = 'before') AS before_woe, max(value) FILTER (WHERE model = 'after') AS after_woe FROM ("
        + union([f"SELECT {i} AS position, '{m}' AS metric, model, {r(e, 4)} AS value FROM per_model" for i, (m, e) in enumerate(compared)])
        + ") l GROUP BY position, metric",
        two_models=f"SELECT 'before' AS model, {TARGET}, {r(f'1e0 / (1e0 + exp(-({linear})))', 8)} AS pd FROM standardized WHERE split = 'test' UNION ALL SELECT 'after', {TARGET}, pd FROM scored JOIN split USING ({ID}) WHERE split = 'test'",
        aucs=auc_sql("two_models", "model"),
        curve=curve_sql("two_models", "model"),
        best=best_sql("curve", "model"),
        decided="SELECT b.*, CASE WHEN pd >= threshold THEN 1 ELSE 0 END AS decision FROM two_models b JOIN best USING (model)",
        cells=cells_sql("decided", "decision", "model"),
        kss="SELECT model, max(abs(tpr - fpr)) AS ks FROM curve GROUP BY model",
        per_model=f"SELECT *, {MEASURES} FROM cells JOIN aucs USING (model) JOIN kss USING (model)",
    )

    aligned = ", ".join(
        f"CAST({'0' if f == 'number_of_credit_inquiries_6m' else f} AS DOUBLE) AS {f}" for f in frozen.COEFFICIENTS
    )
    o["h1_aligned_features"] = given("features", f"SELECT {ID}, {aligned} FROM features")
    rounded_pd = f"{r('round_even(p, 4)', 8)} AS pd_score, {r('round_even(p * 100, 2)', 8)} AS pd_pct"
    bands = ", ".join(f"{band_field(f)} AS {f}" for f in ("label", "color", "level", "recommendation"))
    o["h2_batch_scoring"] = given(
        "scored",
        f"SELECT {ID}, {r('p', 8)} AS pd, {rounded_pd}, {bands}, top_drivers FROM probabilities JOIN (SELECT {ID}, string_agg(feature, '|' ORDER BY rank) AS top_drivers FROM ranks GROUP BY {ID}) d USING ({ID})",
        **driver_ranks(5),
    )
    o["h3_risk_bands"] = given("scored", f"SELECT {ID}, {bands} FROM probabilities")
    shifted = CTE["probabilities"].replace(literal(frozen.INTERCEPT) + " + ", f"{literal(frozen.INTERCEPT)} + 0.25e0 * ({ID} % {SEGMENTS}) + ", 1)
    o["h3_scorecard_by_segment"] = given(
        "features",
        f"SELECT {ID}, concat('segment ', {ID} % {SEGMENTS}) AS segment, {r('p', 8)} AS pd, "
        + ", ".join(f"{band_field(f)} AS {f}" for f in ("level", "recommendation"))
        + " FROM segments",
        segments=shifted,
    )
    o["h4_contributions"] = given("features", f"SELECT {ID}, feature, {r('contribution')} AS contribution FROM terms", terms=contribution_long())
    o["h5_top_drivers"] = given("features", f"SELECT {ID}, rank, feature, {r('contribution')} AS contribution FROM ranks", **driver_ranks(5))
    o["h6_driver_display"] = given(
        "features",
        f"SELECT {ID}, rank, CASE WHEN contribution > 0 THEN 'risk' ELSE 'protective' END AS effect, replace(replace(feature, 'employment_status_', 'emp_'), '_', ' ') AS label, printf('%+.3f', contribution + 0e0) AS text FROM ranks",
        **driver_ranks(7),
    )
    o["h7_rounded_output"] = given("scored", f"SELECT {ID}, round_even(p, 4) AS pd_score, round_even(p * 100, 2) AS pd_pct FROM probabilities")
    names = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in CONFIG.category_names.items())
    o["h8_display_names"] = given(
        "applicants",
        f"SELECT {ID}, CASE employment_status {names} ELSE employment_status END AS employment_status_name, CASE salary_domiciliation WHEN 1 THEN 'Oui' WHEN 0 THEN 'Non' END AS salary_domiciliation_name FROM applicants",
    )
    o["h9_stream_scoring"] = given(
        "scored",
        f"SELECT {ID}, {r('p', 8)} AS pd, {rounded_pd}, {band_field('level')} AS level, {band_field('recommendation')} AS recommendation FROM probabilities JOIN (SELECT {ID} FROM ({errors_sql(CONFIG.rules, False)}) e WHERE n_errors = 0) v USING ({ID})",
    )
    o["h10_portfolio_summary"] = given(
        "scored",
        f"SELECT {band_field('level')} AS level, {band_field('label')} AS label, count(*) AS n, {r('avg(p)')} AS mean_pd, {r(f'avg({TARGET})')} AS default_rate FROM probabilities GROUP BY 1, 2",
    )
    for name, same in (
        ("c3_capped_narrowed", "c3_capped"),
        ("c8_split_deep", "c8_split"),
        ("d4_describe_narrowed", "d4_describe"),
        ("d8_box_narrowed", "d8_box_statistics"),
    ):
        o[name] = o[same]
    # The input contract, written from its schema: all fields required, five of them integers.
    k = ID
    contract = [
        "CASE WHEN bureau_score IS NULL THEN 'bureau_score:missing' END",
        "CASE WHEN bureau_score < 300 OR bureau_score > 850 THEN 'bureau_score:range' END",
        "CASE WHEN monthly_income IS NULL THEN 'monthly_income:missing' END",
        "CASE WHEN monthly_income < 0 OR monthly_income > 50000 THEN 'monthly_income:range' END",
        f"CASE WHEN dti + CASE WHEN {k} % 5 = 0 THEN 5 ELSE 0 END > 5 THEN 'dti:range' END",
        "CASE WHEN utilization_rate < 0 OR utilization_rate > 2 THEN 'utilization_rate:range' END",
        f"CASE WHEN {k} % 11 = 0 THEN 'num_credit_lines:type' END",
        f"CASE WHEN {k} % 11 <> 0 AND {k} % 60 > 50 THEN 'num_credit_lines:range' END",
        f"CASE WHEN {k} % 7 = 0 THEN 'missed_payments_3m:type' END",
        f"CASE WHEN missed_payments_3m + CASE WHEN {k} % 7 = 0 THEN 0.5e0 ELSE 0 END > 30 THEN 'missed_payments_3m:range' END",
        "CASE WHEN overdrawn_days_3m > 90 THEN 'overdrawn_days_3m:range' END",
        "'max_dpd_12m:missing'",
        "CASE WHEN salary_domiciliation NOT IN (0, 1) THEN 'salary_domiciliation:range' END",
        f"CASE WHEN {k} % 13 = 0 THEN 'employment_status:category' END",
    ]
    counted = " + ".join(f"CAST(({c}) IS NOT NULL AS INT)" for c in contract)
    o["b6_contract"] = given(
        "applicants", f"SELECT {ID}, concat_ws('|', {', '.join(contract)}) AS errors, {counted} AS n_errors FROM applicants"
    )
    arriving = [
        "CASE WHEN bureau_score IS NULL THEN 'bureau_score:missing' END",
        "CASE WHEN bureau_score < 300 OR bureau_score > 850 THEN 'bureau_score:range' END",
        "CASE WHEN monthly_income IS NULL THEN 'monthly_income:missing' END",
        "CASE WHEN monthly_income < 0 OR monthly_income > 50000 THEN 'monthly_income:range' END",
        "CASE WHEN dti < 0 OR dti > 5 THEN 'dti:range' END",
        "CASE WHEN utilization_rate < 0 OR utilization_rate > 2 THEN 'utilization_rate:range' END",
        "CASE WHEN missed_payments_3m < 0 OR missed_payments_3m > 30 THEN 'missed_payments_3m:range' END",
        "CASE WHEN overdrawn_days_3m < 0 OR overdrawn_days_3m > 90 THEN 'overdrawn_days_3m:range' END",
        "CASE WHEN max_dpd_12m < 0 OR max_dpd_12m > 365 THEN 'max_dpd_12m:range' END",
        "CASE WHEN salary_domiciliation NOT IN (0, 1) THEN 'salary_domiciliation:range' END",
        "CASE WHEN employment_status NOT IN ('Permanent', 'Self_Employed', 'Student', 'Temporary', 'Unemployed') THEN 'employment_status:category' END",
    ]
    counted = " + ".join(f"CAST(({c}) IS NOT NULL AS INT)" for c in arriving)
    o["h9_stream_quarantine"] = given(
        "applicants",
        f"SELECT * FROM (SELECT {ID}, concat_ws('|', {', '.join(arriving)}) AS errors, {counted} AS n_errors FROM applicants) e WHERE n_errors > 0",
    )
    o["e2_bin_table"] = given(
        "applicants",
        union([
            f"SELECT '{b.variable}' AS variable, 'C{i}' AS bin, {literal(float(high)) if not isinf(high) else 'CAST(' + text('inf') + ' AS DOUBLE)'} AS upper, "
            f"'{b.direction}' AS direction, {big('count(*)')} AS n_rows FROM applicants WHERE {case_bins(b, list(range(1, len(b.edges))))} = {i}"
            for b in CONFIG.bins
            for i, high in enumerate(b.edges[1:], start=1)
        ]),
    )
    terms = ["intercept", *RAW_NUMERIC, "salary_domiciliation", *DUMMIES]
    o["f1_optimality"] = union([f"SELECT '{t}' AS term, 1 AS optimal" for t in terms])
    o["f3_optimality"] = union([f"SELECT '{t}' AS term, 1 AS optimal" for t in ["intercept", *CONFIG.woe_features]])
    summary = [
        ("AUC-ROC (Test)", "auc", ">=", 0.75, "Excellent", "Insuffisant"),
        ("AUC-ROC (Train)", "auc_train", ">=", 0.75, "Excellent", "Insuffisant"),
        ("Ecart Train / Test", "auc_gap", "<", 0.02, "Pas d'overfitting", "Overfitting"),
        ("Coefficient Gini", "gini", ">=", 0.5, "Excellent", "Insuffisant"),
        ("KS Statistic", "ks", ">=", 0.3, "Bon", "Insuffisant"),
        ("F1-Score", "f1", ">", 0.45, "Bon", "Insuffisant"),
        ("Precision", "precision", None, None, None, None),
        ("Rappel (Sensibilite)", "recall", None, None, None, None),
        ("Specificite", "specificity", None, None, None, None),
    ]
    rows = [
        f"SELECT {i} AS position, {text(shown)} AS label, {r(r(metric, 4))} AS value, CAST({literal(relation)} AS VARCHAR) AS relation, "
        f"CAST({literal(bound)} AS DOUBLE) AS bound, "
        + (f"CASE WHEN {metric} {relation} {bound}e0 THEN {text(good)} ELSE {text(bad)} END" if relation else "'—'")
        + " AS interpretation FROM wide"
        for i, (shown, metric, relation, bound, good, bad) in enumerate(summary, start=1)
    ]
    o["g13_metric_summary"] = given(
        "scored_split",
        union(rows),
        **gate,
        wide="SELECT m.*, t.auc, n.auc AS auc_train, abs(n.auc - t.auc) AS auc_gap, 2 * t.auc - 1 AS gini, k.ks FROM measures m, test_auc t, "
        "(SELECT auc FROM aucs WHERE split = 'train') n, (SELECT max(abs(tpr - fpr)) AS ks FROM curve) k",
    )

    # Penalized fits, solved by Newton steps.
    standardized = [*RAW_NUMERIC, "salary_domiciliation", *DUMMIES]

    def coefficients(names: list[str]) -> str:
        values = union([f"SELECT {text(f)} AS feature, beta[{i}] AS b FROM fitted" for i, f in enumerate(names, start=2)])
        return (
            f"SELECT feature, {r(r('b', 4), 3)} AS coefficient, {r(r('exp(b)', 4), 3)} AS odds_ratio, "
            f"CASE WHEN b > 0 THEN 'Risque' ELSE 'Protection' END AS effect FROM ({values}) v"
        )

    def probability_of(names: list[str]) -> str:
        return f"1e0 / (1e0 + exp(-list_dot_product(beta, [1e0, {', '.join(f'CAST({f} AS DOUBLE)' for f in names)}])))"

    CHAINS["woe_split"] = [*CHAINS["split"], *CHAINS["woe"][1:]]
    o["f1_standardized_fit"] = recursive(
        "standardized",
        coefficients(standardized),
        train="SELECT * FROM standardized WHERE split = 'train'",
        **newton_parts("train", standardized, TARGET),
    )
    features = list(CONFIG.woe_features)
    woe_rows = f"SELECT {ID}, {woe_columns}, salary_domiciliation, {dummies}, {TARGET}, split FROM {{0}} JOIN split USING ({ID})"
    o["f3_woe_fit"] = recursive(
        "woe_split",
        coefficients(features),
        train=f"SELECT * FROM ({woe_rows.format('imputed')}) w WHERE split = 'train'",
        **newton_parts("train", features, TARGET),
    )
    balanced = f"CAST(count(*) OVER (PARTITION BY k.fold) AS DOUBLE) / (2e0 * count(*) OVER (PARTITION BY k.fold, {TARGET}))"
    o["f5_cross_validation"] = recursive(
        "standardized",
        f"SELECT fold, {r('auc', 3)} AS auc, {r('f1', 3)} AS f1 FROM aucs JOIN (SELECT fold, {MEASURES} FROM folds_cells) m USING (fold)",
        train_folds=f"SELECT s.*, CAST(ntile(5) OVER (PARTITION BY s.{TARGET} ORDER BY h, s.{ID}) - 1 AS INT) AS fold FROM standardized s JOIN hashed x ON s.{ID} = x.{ID} WHERE split = 'train'",
        training=f"SELECT k.fold AS left_out, {balanced} AS weight, t.* FROM (SELECT DISTINCT fold FROM train_folds) k JOIN train_folds t ON t.fold <> k.fold",
        **newton_parts("training", standardized, TARGET, weight="weight", key="left_out"),
        held=f"SELECT fold, {TARGET}, p AS pd, CAST(p > 0.5 AS INT) AS decision FROM (SELECT fold, {TARGET}, {probability_of(standardized)} AS p FROM train_folds JOIN fitted ON k = fold) q",
        aucs=auc_sql("held", "fold"),
        folds_cells=cells_sql("held", "decision", "fold"),
    )
    o["g13_trained_summary"] = recursive(
        "split",
        f"SELECT * REPLACE ({r('value', 3)} AS value) FROM ({union(rows)}) s",
        learned=f"SELECT a.* FROM applicants a JOIN split USING ({ID}) WHERE split = 'train'",
        learned_medians=CTE["medians"].replace("FROM applicants", "FROM learned"),
        all_imputed=CTE["imputed"].replace("medians", "learned_medians"),
        learned_long=CTE["woe_long"].replace("FROM imputed", f"FROM all_imputed JOIN split USING ({ID}) WHERE split = 'train'"),
        **woe_parts("learned_long"),
        woe_rows=woe_rows.format("all_imputed"),
        train="SELECT * FROM woe_rows WHERE split = 'train'",
        **newton_parts("train", features, TARGET),
        **gate
        | {
            "split_scores": f"SELECT {ID}, {TARGET}, split, {probability_of(features)} AS pd FROM woe_rows, fitted",
            "wide": "SELECT m.*, t.auc, n.auc AS auc_train, abs(n.auc - t.auc) AS auc_gap, 2 * t.auc - 1 AS gini, k.ks FROM measures m, test_auc t, "
            "(SELECT auc FROM aucs WHERE split = 'train') n, (SELECT max(abs(tpr - fpr)) AS ks FROM curve) k",
        },
    )
    return o
