"""Supervised binning: Weight of Evidence and Information Value.

A positive WOE marks a class with more than its share of events.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.config import BinSpec, CreditConfig, FALLING, RISING, ZERO_SHARE_FLOOR
from scoreloom.functions.columns import cut, literal, quotient, round_even, text_map


def bin_label(spec: BinSpec, include_lowest: bool = True) -> Column:
    """Class label of the variable's value; missing values have no class."""
    return cut(spec.variable, spec.edges, spec.names, include_lowest)


def assign_bins(df: DataFrame, bins: Sequence[BinSpec]) -> DataFrame:
    """Replace every binned variable by its class label, in one projection."""
    return df.withColumns({b.variable: bin_label(b) for b in bins})


def bin_table(df: DataFrame, bins: Sequence[BinSpec]) -> DataFrame:
    """The bin specification as a table ``(variable, edges, direction)``."""
    return df.sparkSession.createDataFrame(
        [(b.variable, [float(e) for e in b.edges], b.direction) for b in bins],
        "variable string, edges array<double>, direction string",
    )


def woe_table(df: DataFrame, bins: Sequence[BinSpec], target: str) -> DataFrame:
    """Unrounded WOE/IV row per variable and occurring class, all variables in one pass.

    ``(variable, bin_no, bin, events, total, non_events, pct_events,
    pct_non_events, woe, iv, rate_pct)``. Shares are of all rows, also those
    whose variable is missing; a share of exactly 0 counts as 0.0001.
    """
    numbered = df.where(F.col(target).isNotNull()).select(
        F.col(target).cast("long").alias("y"),
        *[
            cut(b.variable, b.edges, list(range(1, len(b.names) + 1)), True).alias(b.variable)
            for b in bins
        ],
    )
    grouped = (
        numbered.unpivot(["y"], [b.variable for b in bins], "variable", "bin_no")
        .groupBy("variable", "bin_no")
        .agg(F.sum("y").alias("events"), F.count(F.lit(1)).alias("total"))
    )
    per_variable = W.partitionBy("variable")  # a handful of rows per variable
    totals = grouped.withColumns(
        {
            "all_events": F.sum("events").over(per_variable),
            "all_rows": F.sum("total").over(per_variable),
        }
    ).where(F.col("bin_no").isNotNull())

    def share(part: str, whole: str) -> Column:
        value = quotient(part, whole)
        return F.expr(f"CASE WHEN {value} = 0 THEN {literal(ZERO_SHARE_FLOOR)} ELSE {value} END")

    names = text_map({b.variable: b.names for b in bins})
    return totals.select(
        "variable",
        "bin_no",
        F.expr(f"element_at({names}[variable], bin_no)").alias("bin"),
        "events",
        "total",
        F.expr("total - events").alias("non_events"),
        share("events", "all_events").alias("pct_events"),
        share("total - events", "all_rows - all_events").alias("pct_non_events"),
    ).select(
        "*",
        F.expr(f"ln({quotient('pct_events', 'pct_non_events')})").alias("woe"),
    ).select(
        "*",
        F.expr("(pct_events - pct_non_events) * woe").alias("iv"),
        F.expr(f"{quotient('events', 'total')} * 100").alias("rate_pct"),
    )


def rounded_woe_table(table: DataFrame, digits: int = 4) -> DataFrame:
    """The table as shown: every measure rounded."""
    measures = ["pct_events", "pct_non_events", "woe", "iv", "rate_pct"]
    return table.withColumns({c: round_even(c, digits) for c in measures})


def iv_summary(
    table: DataFrame, power_classes: Sequence[tuple[float, str]], bins: Sequence[BinSpec] = ()
) -> DataFrame:
    """Information value per variable, from unrounded terms, with power class and direction."""
    per_variable = table.groupBy("variable").agg(F.sum("iv").alias("iv"))
    ladder = " ".join(f"WHEN iv < {literal(float(b))} THEN {literal(n)}" for b, n in power_classes[:-1])
    power = F.expr(f"CASE {ladder} ELSE {literal(power_classes[-1][1])} END")
    summary = per_variable.withColumn("power", power)
    if bins:
        summary = summary.withColumn("direction", _direction(bins))
    return summary


def total_iv(summary: DataFrame) -> DataFrame:
    return summary.agg(F.sum("iv").alias("total_iv"))


def _direction(bins: Sequence[BinSpec]) -> Column:
    return F.expr(f"{text_map({b.variable: b.direction for b in bins})}[variable]")


def monotonicity(table: DataFrame, bins: Sequence[BinSpec]) -> DataFrame:
    """Whether rate and WOE move in the stated direction over all occurring classes.

    The rate may stand still between two classes, the WOE may not.
    """
    order = W.partitionBy("variable").orderBy("bin_no")
    sign = F.when(_direction(bins) == RISING, 1.0).when(_direction(bins) == FALLING, -1.0)
    rate_step = (F.col("rate_pct") - F.lag("rate_pct").over(order)) * sign
    woe_step = (F.col("woe") - F.lag("woe").over(order)) * sign
    steps = table.select("variable", rate_step.alias("rate_step"), woe_step.alias("woe_step"))
    return (
        steps.groupBy("variable")
        .agg(
            F.coalesce(F.bool_and(F.col("rate_step") >= 0), F.lit(True)).alias("rate_monotone"),
            F.coalesce(F.bool_and(F.col("woe_step") > 0), F.lit(True)).alias("woe_monotone"),
        )
        .select("variable", _direction(bins).alias("direction"), "rate_monotone", "woe_monotone")
    )


def kept_variables(summary: DataFrame, minimum_iv: float = CreditConfig.minimum_iv) -> DataFrame:
    """Variables with enough information value to be used."""
    return summary.where(F.col("iv") >= minimum_iv).select("variable", "iv")


def woe_maps(table: DataFrame, digits: int = 4) -> dict[str, dict[str, float]]:
    """Fitted WOE per variable and class, rounded as they are applied.

    The table has one row per class, so it fits the driver.
    """
    maps: dict[str, dict[str, float]] = {}
    rows = table.select("variable", "bin", round_even("woe", digits).alias("woe")).collect()
    for row in rows:
        maps.setdefault(row["variable"], {})[row["bin"]] = row["woe"]
    return maps


def woe_value(spec: BinSpec, woe: Mapping[str, float]) -> Column:
    """WOE of the variable's value; missing values and classes unseen in fitting give null."""
    return cut(spec.variable, spec.edges, [woe.get(n) for n in spec.names], True).cast("double")


def apply_woe(
    df: DataFrame, bins: Sequence[BinSpec], maps: Mapping[str, Mapping[str, float]]
) -> DataFrame:
    """Replace every binned variable by its WOE, in one projection without a join."""
    return df.withColumns(
        {b.variable: woe_value(b, maps[b.variable]) for b in bins if b.variable in df.columns}
    )
