"""Scoring of applicant tables: one chain of projections, valid for batch and stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.columns import number
from scoreloom.functions.scoring import aligned, contributions, display_name, probability, risk_band
from scoreloom.operators.prep import cap, impute, one_hot
from scoreloom.operators.woe import apply_woe
from scoreloom.sources.params import Scorecard

TOP_DRIVERS = 5


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the training features, in order; an absent feature counts as 0."""
    return df.select(*keep, *[F.expr(aligned(f, df.columns)).alias(f) for f in features])


def woe_features(df: DataFrame, card: Scorecard) -> DataFrame:
    """Impute, cap, encode and replace by WOE, in the order scoring needs.

    Steps of columns the table does not have are skipped.
    """
    present = set(df.columns)
    prepared = impute(df, {c: m for c, m in card.medians.items() if c in present})
    prepared = cap(prepared, {c: v for c, v in card.caps.items() if c in present})
    column = card.category_column
    if column in present:
        prepared = one_hot(prepared, column, card.categories)
    return apply_woe(prepared, card.bins, card.woe)


def score(df: DataFrame, card: Scorecard, keep: Sequence[str] = (), top: int = TOP_DRIVERS) -> DataFrame:
    """Score every row: ``(keep…, pd, pd_score, pd_pct, risk_band, top_drivers,
    contributions, recommendation)``.

    ``pd`` is unrounded and decides the band; ``keep`` names raw input columns.
    """
    raw = {f"raw_{c}": F.col(c) for c in keep}
    features = woe_features(df.withColumns(raw) if raw else df, card)
    available = features.columns
    p = probability(card.coefficients, card.intercept, available)
    ranked = contributions(card.coefficients, available)
    scored = features.select(
        *[F.col(f"raw_{c}").alias(c) for c in keep], p.alias("pd"), ranked.alias("contributions")
    )
    return scored.select(
        *keep,
        "pd",
        F.bround("pd", 4).alias("pd_score"),
        F.bround(F.col("pd") * 100, 2).alias("pd_pct"),
        risk_band("pd", card.bands).alias("risk_band"),
        F.slice("contributions", 1, top).alias("top_drivers"),
        "contributions",
    ).withColumn("recommendation", F.col("risk_band.recommendation"))


def drivers(scored: DataFrame, keep: Sequence[str], column: str = "top_drivers") -> DataFrame:
    """Ranked contributions in long form: ``(keep…, rank, feature, contribution)``.

    The outer explode is on purpose: lists are never empty, and the plain one adds a
    filter on their size that is pushed below the score, into joins and scans.
    """
    return scored.select(*keep, F.posexplode_outer(column).alias("at", "driver")).select(
        *keep,
        (F.col("at") + 1).alias("rank"),
        F.col("driver.feature").alias("feature"),
        F.col("driver.value").alias("contribution"),
    )


def driver_display(driver_rows: DataFrame, category_column: str) -> DataFrame:
    """Add the effect, the short label and the signed text of each driver."""
    label = F.replace(
        F.replace(F.col("feature"), F.lit(f"{category_column}_"), F.lit("emp_")), F.lit("_"), F.lit(" ")
    )
    return driver_rows.withColumns(
        {
            "effect": F.when(F.col("contribution") > 0, "risk").otherwise("protective"),
            "label": label,
            "text": F.format_string("%+.3f", F.col("contribution")),
        }
    )


def display_categories(
    df: DataFrame, category: str, category_names: Mapping[str, str], flag: str, flag_names: Mapping[int, str]
) -> DataFrame:
    """Add readable names of the category code and of the 0/1 flag."""
    return df.withColumns(
        {
            f"{category}_name": display_name(category, category_names),
            f"{flag}_name": display_name(flag, flag_names),
        }
    )


def portfolio_summary(scored: DataFrame, target: str | None = None) -> DataFrame:
    """Rows, mean probability and observed default rate by risk band."""
    rate: list[Column] = [F.avg(number(target)).alias("default_rate")] if target else []
    return scored.groupBy(
        F.col("risk_band.level").alias("level"), F.col("risk_band.label").alias("label")
    ).agg(F.count(F.lit(1)).alias("n"), F.avg("pd").alias("mean_pd"), *rate)
