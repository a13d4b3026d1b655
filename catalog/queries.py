"""One query per operator, over the applicant table that Spark derives from the given tables.

Doubles are rounded where the two engines may differ in the last bits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import frozen
from scoreloom.config import BinSpec, CreditConfig, DomainRule
from scoreloom.functions.columns import even, literal, name, round_even, stack
from scoreloom.functions.scoring import contributions, probability, risk_band
from scoreloom.operators import metrics as M
from scoreloom.operators import model as L
from scoreloom.operators import prep as P
from scoreloom.operators import profile as D
from scoreloom.operators import score as H
from scoreloom.operators import validate as V
from scoreloom.operators import woe as E
from scoreloom.operators.curve import roc_table
from scoreloom.operators.scorecards import card_table, score_many, woe_lookup
from scoreloom.plans.training import evaluation, prepare, standardized_split, train_scorecard, woe_dataset
from scoreloom.sources import params
from scoreloom.sources.applicants import (
    applicant_table,
    preview,
    table_shape,
    write_snapshot,
)
from scoreloom.storage import new_path, written
from scoreloom.streaming.scoring import read_applicant_stream, read_batches, start_scoring

Query = Callable[[SparkSession, str], DataFrame]

CONFIG = frozen.CONFIG
ID, TARGET = CONFIG.id_column, CONFIG.target
VARIABLES = tuple(b.variable for b in CONFIG.bins)
NUMERIC = CONFIG.numeric_columns
CORRELATED = (*NUMERIC, "salary_domiciliation", TARGET)

# Segments with a scorecard each.
SEGMENTS = 7

STRICT_RULES = (
    DomainRule("bureau_score", 400, 800),
    DomainRule("monthly_income", 700, 4000),
    DomainRule("dti", 0.2, 0.8),
    DomainRule("max_dpd_12m", 0, 40),
    DomainRule("employment_status", allowed=("Permanent", "Self_Employed", "Temporary", "Unemployed")),
)

DOCUMENT_BINS = (
    BinSpec("n_chars", (float("-inf"), 200, 600, 2000, float("inf")), "croissant"),
)

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column; adding 0 turns a negative zero into a plain one."""
    doubles = [n for n, t in df.dtypes if t == "double" and n not in keep]
    return df.withColumns({c: F.expr(f"{even(name(c), digits)} + 0.0D") for c in doubles})


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """The applicant view written as a table, for queries that pass over it several times."""
    return written(applicant_table(spark, folder), "applicants")


# --- A. Scans, sources, sinks ------------------------------------------------


@query
def a1_applicant_scan(spark: SparkSession, folder: str) -> DataFrame:
    return applicant_table(spark, folder)


@query
def a2_table_shape(spark: SparkSession, folder: str) -> DataFrame:
    return table_shape(applicant_table(spark, folder))


@query
def a3_raw_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return write_snapshot(applicant_table(spark, folder), new_path(spark, "snapshot"))


@query
def a4_fitted_parameters(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    medians, caps = _medians_and_caps(df)
    card = frozen.scorecard(medians, caps)
    path = new_path(spark, "scorecard")
    card.save(spark, path)
    loaded = params.Scorecard.load(spark, path)
    return rounded(params.stats_table(spark, {"median": loaded.medians, "cap": loaded.caps}))


@query
def a5_run_log(spark: SparkSession, folder: str) -> DataFrame:
    """A logged run: parameters and cross-validated metrics of the saturated model."""
    folds = P.stratified_folds(_encoded(spark, folder), CONFIG)
    config = replace(CONFIG, class_weight="balanced", c=UNPENALIZED)
    summary = L.cross_validation_summary(L.cross_validate(folds, DUMMIES, config, patterns=True)).first()
    path = new_path(spark, "runs")
    params.log_run(
        spark,
        path,
        run_id="saturated",
        run_name="LogisticRegression_v1",
        params={
            "C": int(UNPENALIZED),
            "class_weight": config.class_weight,
            "solver": "lbfgs",
            "max_iter": CONFIG.max_iter,
            "n_features": len(DUMMIES),
            "train_size": folds.count(),
        },
        metrics=summary.asDict(),
    )
    return params.read_run_log(spark, path).drop("logged_at")


@query
def a6_preview(spark: SparkSession, folder: str) -> DataFrame:
    return preview(applicant_table(spark, folder), 5, ID)


# --- B. Projections, filters, predicates -------------------------------------


@query
def b1_drop_identifier(spark: SparkSession, folder: str) -> DataFrame:
    return V.drop_identifier(applicant_table(spark, folder), CONFIG)


@query
def b2_features_and_label(spark: SparkSession, folder: str) -> DataFrame:
    return V.features_and_label(applicant_table(spark, folder), CONFIG)


@query
def b3_column_roles(spark: SparkSession, folder: str) -> DataFrame:
    df = P.one_hot(_stored(spark, folder), CONFIG.category_column, CONFIG.categories)
    numeric, binary = V.column_roles(df.columns, CONFIG)
    roles = [*((c, "numeric") for c in numeric), *((c, "binary") for c in binary)]
    wide = df.agg(*[F.avg(c).alias(c) for c, _ in roles])
    return rounded(stack(wide, ["column", "role", "mean"], [[literal(c), literal(r), name(c)] for c, r in roles]))


@query
def b4_class_values(spark: SparkSession, folder: str) -> DataFrame:
    return V.class_values(applicant_table(spark, folder), "bureau_score", TARGET, 1)


@query
def b5_missing_flags(spark: SparkSession, folder: str) -> DataFrame:
    flagged = V.missing_flags(applicant_table(spark, folder), CONFIG.impute_columns)
    return flagged.select(ID, *[f"{c}_missing" for c in CONFIG.impute_columns])


def _errors(validated: DataFrame) -> DataFrame:
    return validated.select(
        ID, F.array_join("errors", "|").alias("errors"), F.size("errors").alias("n_errors")
    )


@query
def b6_validation(spark: SparkSession, folder: str) -> DataFrame:
    return _errors(V.validate(applicant_table(spark, folder), CONFIG))


@query
def b6_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    strict = replace(CONFIG, rules=STRICT_RULES)
    _, refused = V.split_valid(V.validate(applicant_table(spark, folder), strict, allow_null=True))
    return _errors(refused)


@query
def b7_decision(spark: SparkSession, folder: str) -> DataFrame:
    scored = _stable_score(applicant_table(spark, folder))
    return scored.select(
        ID,
        V.decide(F.col("pd"), 0.35).alias("decision"),
        V.decide(F.col("pd"), 0.5, strict=True).alias("default_decision"),
    )


@query
def b6_contract(spark: SparkSession, folder: str) -> DataFrame:
    """The full input contract on a table that breaks it: an absent column, fractions, ranges, gaps."""
    k = F.col(ID)
    broken = (
        applicant_table(spark, folder)
        .drop("max_dpd_12m")
        .withColumns(
            {
                "num_credit_lines": F.when(k % 11 == 0, "many").otherwise((k % 60).cast("string")),
                "missed_payments_3m": F.col("missed_payments_3m") + F.when(k % 7 == 0, 0.5).otherwise(0.0),
                "dti": F.when(k % 5 == 0, F.col("dti") + 5).otherwise(F.col("dti")),
                "employment_status": F.when(k % 13 == 0, "Retired").otherwise(F.col("employment_status")),
            }
        )
    )
    return _errors(V.validate(broken, CreditConfig()))


# --- C. Preparation ----------------------------------------------------------


def _medians_and_caps(df: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    medians = P.fit_medians(df, CONFIG.impute_columns)
    return medians, P.fit_caps(P.impute(df, medians), CONFIG.cap_columns, CONFIG.cap_quantile)


def _split(df: DataFrame) -> DataFrame:
    return P.stratified_split(df, CONFIG)


@query
def c1_medians(spark: SparkSession, folder: str) -> DataFrame:
    medians = P.fit_medians(_stored(spark, folder), CONFIG.impute_columns)
    return rounded(params.stats_table(spark, {"median": medians}))


@query
def c2_imputed(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    imputed = P.impute(df, P.fit_medians(df, CONFIG.impute_columns))
    return rounded(imputed.select(ID, *CONFIG.impute_columns))


@query
def c3_capped(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    medians, caps = _medians_and_caps(df)
    return rounded(P.cap(P.impute(df, medians), caps).select(ID, *CONFIG.cap_columns))


@query
def c3_capped_narrowed(spark: SparkSession, folder: str) -> DataFrame:
    """The same caps by narrowing, as for large tables."""
    df = _stored(spark, folder)
    medians = P.fit_medians(df, CONFIG.impute_columns)
    imputed = P.impute(df, medians)
    caps = P.fit_caps(imputed, CONFIG.cap_columns, CONFIG.cap_quantile, small_group_rows=20)
    return rounded(P.cap(imputed, caps).select(ID, *CONFIG.cap_columns))


@query
def c4_cap_audit(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    medians, caps = _medians_and_caps(df)
    return P.cap_audit(P.impute(df, medians), caps)


@query
def c5_one_hot(spark: SparkSession, folder: str) -> DataFrame:
    df = applicant_table(spark, folder)
    categories = P.fit_categories(df, CONFIG.category_column)
    encoded = P.one_hot(df, CONFIG.category_column, categories)
    return encoded.select(ID, *[f"{CONFIG.category_column}_{v}" for v in categories[1:]])


@query
def c6_standardized(spark: SparkSession, folder: str) -> DataFrame:
    data, features = standardized_split(_stored(spark, folder), CONFIG)
    return rounded(data.select(ID, "split", *features))


@query
def c7_standardization_check(spark: SparkSession, folder: str) -> DataFrame:
    data, features = standardized_split(_stored(spark, folder), CONFIG)
    numeric, _ = V.column_roles(features, CONFIG)
    return rounded(P.standardization_check(data.where(F.col("split") == "train"), numeric))


@query
def c8_split(spark: SparkSession, folder: str) -> DataFrame:
    return _split(_stored(spark, folder)).select(ID, "split")


@query
def c8_split_deep(spark: SparkSession, folder: str) -> DataFrame:
    """The same split by longer hash prefixes, as for large classes."""
    config = replace(CONFIG, small_bucket_rows=1)
    return P.stratified_split(_stored(spark, folder), config).select(ID, "split")


@query
def c9_split_summary(spark: SparkSession, folder: str) -> DataFrame:
    split = _split(_stored(spark, folder))
    return rounded(P.split_summary(split, TARGET, len(CONFIG.woe_features)))


# --- D. Exploratory aggregates -----------------------------------------------


@query
def d1_target_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.target_distribution(applicant_table(spark, folder), TARGET))


@query
def d2_missing_values(spark: SparkSession, folder: str) -> DataFrame:
    df = applicant_table(spark, folder)
    return D.missing_table(df, df.columns, CONFIG.missing_alert_pct)


@query
def d2_missing_left(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    return D.missing_total(P.impute(df, P.fit_medians(df, CONFIG.impute_columns)))


@query
def d3_rate_by_missing(spark: SparkSession, folder: str) -> DataFrame:
    df = applicant_table(spark, folder)
    return rounded(D.rate_by_missing(df, CONFIG.impute_columns, TARGET))


@query
def d4_describe(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.describe(_stored(spark, folder), NUMERIC))


@query
def d4_describe_narrowed(spark: SparkSession, folder: str) -> DataFrame:
    """The same statistics by narrowing, as for large tables."""
    return rounded(D.describe(_stored(spark, folder), NUMERIC, small_group_rows=50))


@query
def d5_shape(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.shape_statistics(applicant_table(spark, folder), NUMERIC))


@query
def d6_class_histograms(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.class_histogram(_stored(spark, folder), NUMERIC, 40, by=TARGET), 8)


@query
def d7_capping_histograms(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    medians, caps = _medians_and_caps(df)
    capped = P.cap(P.impute(df, medians), caps)
    return rounded(D.before_after_histograms(df, capped, "monthly_income", 60, "capping"))


@query
def d7_scaling_histograms(spark: SparkSession, folder: str) -> DataFrame:
    prepared, _, _ = prepare(_stored(spark, folder), CONFIG)
    train = _split(prepared).where(F.col("split") == "train")
    scaled = P.standardize(train, P.fit_standardizer(train, ["bureau_score"]))
    return rounded(D.before_after_histograms(train, scaled, "bureau_score", 40, "scaling"))


@query
def d8_box_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.box_statistics(_stored(spark, folder), NUMERIC, TARGET))


@query
def d8_box_narrowed(spark: SparkSession, folder: str) -> DataFrame:
    """The same statistics by narrowing, as for large classes."""
    return rounded(D.box_statistics(_stored(spark, folder), NUMERIC, TARGET, small_group_rows=50))


@query
def d9_extreme_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.extreme_outliers(_stored(spark, folder), NUMERIC))


@query
def d10_rate_by_employment(spark: SparkSession, folder: str) -> DataFrame:
    rates = D.rate_by_value(applicant_table(spark, folder), CONFIG.category_column, TARGET)
    return rounded(rates).orderBy(F.col("rate").desc(), "value")


@query
def d11_rate_by_salary_flag(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.rate_by_value(applicant_table(spark, folder), "salary_domiciliation", TARGET)).orderBy("value")


@query
def d12_correlations(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.correlations(applicant_table(spark, folder), CORRELATED))


@query
def d13_target_correlations(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.target_correlations(applicant_table(spark, folder), CORRELATED[:-1], TARGET))


@query
def d14_rate_by_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.rate_by_bucket(applicant_table(spark, folder), CONFIG.rate_buckets, TARGET))


# --- E. Binning, Weight of Evidence, Information Value -----------------------


def _imputed(spark: SparkSession, folder: str) -> DataFrame:
    df = applicant_table(spark, folder)
    return P.impute(df, P.fit_medians(df, CONFIG.impute_columns))


def _woe(spark: SparkSession, folder: str) -> DataFrame:
    return E.woe_table(_imputed(spark, folder), CONFIG.bins, TARGET)


@query
def e1_bin_labels(spark: SparkSession, folder: str) -> DataFrame:
    return E.assign_bins(_stored(spark, folder), CONFIG.bins).select(ID, *VARIABLES)


@query
def e2_bin_table(spark: SparkSession, folder: str) -> DataFrame:
    """The bins, with the applicants that fall into each class."""
    df = _stored(spark, folder)
    edges = E.bin_table(df, CONFIG.bins).select(
        "variable", "direction", F.posexplode(F.slice("edges", 2, 100)).alias("place", "upper")
    )
    labels = E.assign_bins(df, CONFIG.bins).select(
        F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("bin")) for v in VARIABLES])).alias("b")
    )
    counts = labels.groupBy("b.variable", "b.bin").agg(F.count(F.lit(1)).alias("n_rows"))
    named = edges.withColumn("bin", F.concat(F.lit("C"), (F.col("place") + 1).cast("string")))
    return named.join(counts, ["variable", "bin"], "left").select(
        "variable", "bin", "upper", "direction", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows")
    )


@query
def e3_woe_table(spark: SparkSession, folder: str) -> DataFrame:
    return E.rounded_woe_table(_woe(spark, folder))


@query
def e3_woe_with_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Missing scores and incomes belong to no class but count in the totals."""
    return E.rounded_woe_table(E.woe_table(_stored(spark, folder), CONFIG.bins, TARGET))


@query
def e4_iv_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(E.iv_summary(_woe(spark, folder), CONFIG.power_classes, CONFIG.bins), 4)


@query
def e5_total_iv(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(E.total_iv(E.iv_summary(_woe(spark, folder), CONFIG.power_classes)), 4)


@query
def e6_woe_values(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    maps = E.woe_maps(E.woe_table(P.impute(df, P.fit_medians(df, CONFIG.impute_columns)), CONFIG.bins, TARGET))
    return E.apply_woe(df, CONFIG.bins, maps).select(ID, *VARIABLES)


@query
def e6_table_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The same WOE values, looked up in a table of scorecards."""
    df = _stored(spark, folder)
    maps = E.woe_maps(E.woe_table(P.impute(df, P.fit_medians(df, CONFIG.impute_columns)), CONFIG.bins, TARGET))
    cards = card_table(spark, {"fitted": replace(frozen.scorecard({}, {}), woe=maps)})
    return woe_lookup(df.withColumn("card", F.lit("fitted")), cards, VARIABLES, "card").select(ID, *VARIABLES)


@query
def e7_woe_dataset(spark: SparkSession, folder: str) -> DataFrame:
    data, _, _ = woe_dataset(_stored(spark, folder), CONFIG)
    return data


@query
def e8_monotonicity(spark: SparkSession, folder: str) -> DataFrame:
    checked = E.monotonicity(_woe(spark, folder), CONFIG.bins)
    return checked.withColumns({c: F.col(c).cast("int") for c in ("rate_monotone", "woe_monotone")})


@query
def e9_kept_variables(spark: SparkSession, folder: str) -> DataFrame:
    summary = E.iv_summary(_woe(spark, folder), CONFIG.power_classes)
    return rounded(E.kept_variables(summary, 1.4), 4)


def _labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "n_chars")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    return documents.join(labels, "doc_id")


@query
def e3_woe_other_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same operator on another table, target and bins."""
    return E.rounded_woe_table(E.woe_table(_labelled_documents(spark, folder), DOCUMENT_BINS, "toxic"))


@query
def d10_rate_other_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.rate_by_value(_labelled_documents(spark, folder), "lang", "toxic"))


# --- F. Model fitting --------------------------------------------------------

# Without a penalty, a model with one 0/1 column per category reproduces the
# observed log-odds, which SQL can state.
UNPENALIZED = 1e12
DUMMIES = list(CONFIG.dummy_columns)


def _encoded(spark: SparkSession, folder: str) -> DataFrame:
    return P.one_hot(_stored(spark, folder), CONFIG.category_column, CONFIG.categories)


def _saturated(spark: SparkSession, folder: str, class_weight: str | None):
    patterns = L.feature_patterns(_encoded(spark, folder), DUMMIES, TARGET)
    model = L.fit_logistic(
        patterns, DUMMIES, TARGET, UNPENALIZED, class_weight, weight=L.ROWS, tolerance=1e-12
    )
    return {"intercept": float(model.intercept), **L.coefficients_of(model, DUMMIES)}


@query
def f1_standardized_fit(spark: SparkSession, folder: str) -> DataFrame:
    data, features = standardized_split(_stored(spark, folder), CONFIG)
    model = L.fit_logistic(data.where(F.col("split") == "train"), features, TARGET, CONFIG.c)
    return rounded(L.coefficient_table(spark, L.coefficients_of(model, features)), 3)


def _at_optimum(gradients: DataFrame) -> DataFrame:
    """Whether each term of a fit is at its optimum: SQL knows the terms, and that all are."""
    return gradients.select("term", (F.abs("gradient") < 1e-6).cast("int").alias("optimal"))


@query
def f1_optimality(spark: SparkSession, folder: str) -> DataFrame:
    """The penalized fit on standardized columns solves its equations."""
    data, features = standardized_split(_stored(spark, folder), CONFIG)
    train = data.where(F.col("split") == "train")
    model = L.fit_logistic(train, features, TARGET, CONFIG.c)
    return _at_optimum(L.optimality(train, features, TARGET, model, CONFIG.c))


@query
def f1_saturated_fit(spark: SparkSession, folder: str) -> DataFrame:
    fitted = _saturated(spark, folder, None)
    return rounded(spark.createDataFrame(list(fitted.items()), "term string, beta double"), 3)


@query
def f2_class_weights(spark: SparkSession, folder: str) -> DataFrame:
    weights = L.class_weights(_stored(spark, folder), TARGET)
    return rounded(spark.createDataFrame(list(weights.items()), "class int, weight double"))


@query
def f2_balanced_saturated_fit(spark: SparkSession, folder: str) -> DataFrame:
    fitted = _saturated(spark, folder, "balanced")
    return rounded(spark.createDataFrame(list(fitted.items()), "term string, beta double"), 3)


@query
def f3_woe_fit(spark: SparkSession, folder: str) -> DataFrame:
    data, _, _ = woe_dataset(_split(_stored(spark, folder)), CONFIG)
    features = list(CONFIG.woe_features)
    patterns = L.feature_patterns(data.where(F.col("split") == "train"), features, TARGET).persist()
    model = L.fit_logistic(patterns, features, TARGET, CONFIG.c, weight=L.ROWS)
    patterns.unpersist()
    return rounded(L.coefficient_table(spark, L.coefficients_of(model, features), by_size=True), 3)


@query
def f3_optimality(spark: SparkSession, folder: str) -> DataFrame:
    """The penalized fit on WOE columns, balanced classes, solves its equations."""
    data, _, _ = woe_dataset(_split(_stored(spark, folder)), CONFIG)
    features = list(CONFIG.woe_features)
    patterns = L.feature_patterns(data.where(F.col("split") == "train"), features, TARGET)
    model = L.fit_logistic(patterns, features, TARGET, CONFIG.c, "balanced", weight=L.ROWS)
    return _at_optimum(L.optimality(patterns, features, TARGET, model, CONFIG.c, "balanced", L.ROWS))


@query
def f4_folds(spark: SparkSession, folder: str) -> DataFrame:
    return P.stratified_folds(_stored(spark, folder), CONFIG).select(ID, "fold")


@query
def f5_cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    data, features = standardized_split(_stored(spark, folder), CONFIG)
    folds = P.stratified_folds(data.where(F.col("split") == "train"), CONFIG)
    return rounded(L.cross_validate(folds, features, replace(CONFIG, class_weight="balanced")), 3)


@query
def f5_saturated_cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    folds = P.stratified_folds(_encoded(spark, folder), CONFIG)
    config = replace(CONFIG, class_weight="balanced", c=UNPENALIZED)
    per_fold = L.cross_validate(
        folds, DUMMIES, config, patterns=True
    )
    return rounded(per_fold)


@query
def f5_saturated_summary(spark: SparkSession, folder: str) -> DataFrame:
    folds = P.stratified_folds(_encoded(spark, folder), CONFIG)
    config = replace(CONFIG, class_weight="balanced", c=UNPENALIZED)
    per_fold = L.cross_validate(
        folds, DUMMIES, config, patterns=True
    )
    return rounded(L.cross_validation_summary(per_fold))


@query
def f6_coefficient_table(spark: SparkSession, folder: str) -> DataFrame:
    fitted = _saturated(spark, folder, None)
    table = L.coefficient_table(spark, {f: fitted[f] for f in DUMMIES}, by_size=True)
    return rounded(table, 3)


@query
def f7_probability(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_scored(_stored(spark, folder)).select(ID, "pd"), 8)


# --- G. Evaluation -----------------------------------------------------------


Fitted = tuple[dict[str, float], dict[str, float]]


def _features(df: DataFrame, fitted: Fitted | None = None) -> DataFrame:
    medians, caps = fitted or _medians_and_caps(df)
    return H.woe_features(df, frozen.scorecard(medians, caps))


def _scored(df: DataFrame, fitted: Fitted | None = None) -> DataFrame:
    """Applicants with the probability of the fixed WOE scorecard."""
    features = _features(df, fitted)
    return features.withColumn("pd", probability(frozen.COEFFICIENTS, frozen.INTERCEPT, features.columns))


def _stable_score(df: DataFrame, fitted: Fitted | None = None) -> DataFrame:
    """Key, target and score to 8 decimals, so that ties are the same in both engines."""
    scored = _scored(df, fitted)
    kept = [c for c in (ID, TARGET, "split") if c in df.columns]
    return scored.select(*kept, round_even("pd", 8).alias("pd"))


def _curve(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return roc_table(_stable_score(df), "pd", TARGET, by)


def _decided(df: DataFrame) -> DataFrame:
    scored = _stable_score(df)
    ranking = M.curve_metrics(
        roc_table(scored, "pd", TARGET)
    )
    return M.at_optimal_threshold(scored, "pd", TARGET, ranking)


@query
def g1_auc_by_split(spark: SparkSession, folder: str) -> DataFrame:
    split = _split(_stored(spark, folder))
    return rounded(M.curve_metrics(_curve(split, ("split",)), ["split"]).select("split", "auc"))


@query
def g2_gini(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(M.curve_metrics(_curve(_stored(spark, folder))).select("auc", "gini"))


@query
def g3_roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    scored = _stable_score(_stored(spark, folder))
    curve = roc_table(scored, "pd", TARGET, origin=True)
    return rounded(curve.select("threshold", "fpr", "tpr"), 8)


@query
def g3_roc_curve_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The same curve by score ranges, as for scores of any number."""
    scored = _stable_score(_stored(spark, folder))
    curve = roc_table(scored, "pd", TARGET, max_window_rows=500)
    return rounded(curve.select("threshold", "pos", "neg", "tp", "fp", "fpr", "tpr"), 8)


@query
def g4_ks(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(M.curve_metrics(_curve(_stored(spark, folder))).select("ks"))


@query
def g5_optimal_threshold(spark: SparkSession, folder: str) -> DataFrame:
    metrics = M.curve_metrics(_curve(_stored(spark, folder)))
    return rounded(metrics.select("threshold", "ks_curve"), 8)


@query
def g6_ks_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(M.ks_grid(_stable_score(_stored(spark, folder)), "pd", TARGET))


@query
def g7_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return M.confusion(_decided(_stored(spark, folder)), TARGET, "decision")


@query
def g8_confusion_shares(spark: SparkSession, folder: str) -> DataFrame:
    cells = M.confusion(_decided(_stored(spark, folder)), TARGET, "decision")
    return rounded(M.confusion_long(cells))


@query
def g9_threshold_metrics(spark: SparkSession, folder: str) -> DataFrame:
    cells = M.confusion(_decided(_stored(spark, folder)), TARGET, "decision")
    return rounded(M.threshold_metrics(cells))


@query
def g10_classification_report(spark: SparkSession, folder: str) -> DataFrame:
    cells = M.confusion(_decided(_stored(spark, folder)), TARGET, "decision")
    return rounded(M.classification_report(cells, CONFIG.target_names))


@query
def g11_score_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(D.class_histogram(_stable_score(_stored(spark, folder)), ["pd"], 50, by=TARGET), 7)


@query
def g12_score_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(M.score_summary(_stable_score(_stored(spark, folder)), "pd", TARGET))


@query
def g13_benchmark_gate(spark: SparkSession, folder: str) -> DataFrame:
    scored = _stable_score(_split(_stored(spark, folder)))
    curve = roc_table(scored, "pd", TARGET, ["split"])
    ranking = M.curve_metrics(curve, ["split"])
    by_split = {r["split"]: r for r in ranking.collect()}
    test = by_split["test"]
    decided = scored.where(F.col("split") == "test").withColumn(
        "decision", V.decide(F.col("pd"), test["threshold"])
    )
    cells = M.threshold_metrics(M.confusion(decided, TARGET, "decision"))
    values = {
        "auc": literal(test["auc"]),
        "gini": literal(test["gini"]),
        "ks": literal(test["ks"]),
        "f1": "f1",
        "auc_gap": literal(abs(by_split["train"]["auc"] - test["auc"])),
    }
    long = stack(cells, ["metric", "value"], [[literal(m), v] for m, v in values.items()])
    return rounded(M.benchmark_gate(long, CONFIG.limits))


@query
def g13_metric_summary(spark: SparkSession, folder: str) -> DataFrame:
    """All nine metrics of the fixed scorecard with what they mean."""
    scored = _stable_score(_split(_stored(spark, folder)))
    return rounded(M.metric_summary(evaluation(scored, CONFIG), CONFIG.limits))


@query
def g13_trained_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way: train a scorecard on the categories that occur, score, evaluate and interpret."""
    trained = train_scorecard(_stored(spark, folder), CONFIG, fit_on_train=True, fit_categories=True)
    return rounded(M.metric_summary(evaluation(trained.scored, CONFIG), CONFIG.limits), 3)


@query
def g14_model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    df = _split(_stored(spark, folder))
    fitted = _medians_and_caps(df)
    standardized, _ = standardized_split(df, CONFIG, fitted)
    before = standardized.select(
        TARGET,
        F.lit("before").alias("model"),
        "split",
        probability(
            frozen.STANDARDIZED_COEFFICIENTS, frozen.STANDARDIZED_INTERCEPT, standardized.columns
        ).alias("pd"),
    ).withColumn("pd", round_even("pd", 8))
    after = _stable_score(df, fitted).select(TARGET, F.lit("after").alias("model"), "split", "pd")
    both = before.unionByName(after).where(F.col("split") == "test")
    ranking = M.curve_metrics(roc_table(both, "pd", TARGET, ["model"]), ["model"])
    # Two rows, read once and used twice.
    ranking = spark.createDataFrame(ranking.collect(), ranking.schema)
    decided = M.at_optimal_threshold(both, "pd", TARGET, ranking, ["model"])
    cells = M.confusion(decided, TARGET, "decision", ["model"])
    return M.compare_models(ranking, cells, {"before": "before_woe", "after": "after_woe"})


# --- H. Scoring tables and streams -------------------------------------------

FEATURES = list(frozen.COEFFICIENTS)


def _card(df: DataFrame) -> params.Scorecard:
    return frozen.scorecard(*_medians_and_caps(df))


@query
def h1_aligned_features(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    features = H.woe_features(df, _card(df)).drop("number_of_credit_inquiries_6m")
    return H.align_features(features, FEATURES, keep=[ID])


@query
def h2_batch_scoring(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    scored = H.score(df, _card(df), keep=[ID])
    return rounded(
        scored.select(
            ID,
            "pd",
            "pd_score",
            "pd_pct",
            "risk_band.label",
            "risk_band.color",
            "risk_band.level",
            "recommendation",
            F.array_join(F.transform("top_drivers", lambda d: d["feature"]), "|").alias("top_drivers"),
        ),
        8,
    )


@query
def h3_risk_bands(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored(_stored(spark, folder))
    return scored.select(ID, risk_band("pd", CONFIG.bands).alias("b")).select(ID, "b.*")


@query
def h3_scorecard_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    """Every row under the scorecard of its segment, all segments in one pass."""
    df = _stored(spark, folder)
    card = _card(df)
    shifted = {f"segment {i}": replace(card, intercept=card.intercept + 0.25 * i) for i in range(SEGMENTS)}
    segments = df.withColumn("segment", F.concat(F.lit("segment "), F.col(ID) % SEGMENTS))
    scored = score_many(
        segments, card_table(spark, shifted), "segment", VARIABLES, CONFIG.binary_columns, CONFIG.category_column, [ID]
    )
    return rounded(scored.select(ID, "segment", "pd", "risk_band.level", "recommendation"), 8)


@query
def h4_contributions(spark: SparkSession, folder: str) -> DataFrame:
    features = _features(_stored(spark, folder))
    terms = features.select(ID, contributions(frozen.COEFFICIENTS, features.columns).alias("terms"))
    return rounded(H.drivers(terms, [ID], "terms").drop("rank"))


@query
def h5_top_drivers(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    return rounded(H.drivers(H.score(df, _card(df), keep=[ID], top=5), [ID]))


@query
def h6_driver_display(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    top = H.drivers(H.score(df, _card(df), keep=[ID], top=7), [ID])
    plain = top.withColumn("contribution", F.col("contribution") + F.lit(0.0))
    return H.driver_display(plain, CONFIG.category_column).drop("contribution", "feature")


@query
def h7_rounded_output(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    return H.score(df, _card(df), keep=[ID]).select(ID, "pd_score", "pd_pct")


@query
def h8_display_names(spark: SparkSession, folder: str) -> DataFrame:
    shown = H.display_categories(
        applicant_table(spark, folder),
        CONFIG.category_column,
        CONFIG.category_names,
        "salary_domiciliation",
        CONFIG.flag_names,
    )
    return shown.select(ID, "employment_status_name", "salary_domiciliation_name")


def _arriving(spark: SparkSession, folder: str) -> tuple[DataFrame, params.Scorecard]:
    applicants = _stored(spark, folder)
    card = _card(applicants)
    arrived = new_path(spark, "arriving")
    write_snapshot(applicants, arrived)
    arriving = read_applicant_stream(spark, arrived, "parquet")
    return arriving, card


def _streamed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Scored and refused rows that one pass over the arriving files has written."""
    arriving, card = _arriving(spark, folder)
    paths = [new_path(spark, f"{name}-stream") for name in ("scored", "refused", "checkpoint")]
    start_scoring(arriving, card, CONFIG, [ID], *paths, timestamp=False, once=True).awaitTermination()
    scored, refused = (read_batches(spark, path) for path in paths[:2])
    return scored, refused


@query
def h9_stream_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Applicant files arrive in a folder; each row is validated, and scored if valid."""
    scored, _ = _streamed(spark, folder)
    return rounded(scored.select(ID, "pd", "pd_score", "pd_pct", "risk_band.level", "recommendation"), 8)


@query
def h9_stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that the stream refuses, with all reasons; with the scored ones they are every row."""
    _, refused = _streamed(spark, folder)
    return _errors(refused)


@query
def h10_portfolio_summary(spark: SparkSession, folder: str) -> DataFrame:
    df = _stored(spark, folder)
    scored = H.score(df, _card(df), keep=[ID, TARGET])
    return rounded(H.portfolio_summary(scored, TARGET))
