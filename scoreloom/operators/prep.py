"""Data preparation: fit gives a few literals, transform is a projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.config import CreditConfig
from scoreloom.functions.columns import even, known, literal, name, number, quotient, stack, when_class
from scoreloom.operators.quantiles import SMALL_GROUP_ROWS, exact_quantiles
from scoreloom.operators.ranks import cut_table, passed_cuts, stratum_sizes



def fit_medians(
    df: DataFrame, columns: Sequence[str], approximate: bool = False
) -> dict[str, float]:
    """Median per column, exact unless ``approximate`` asks for a sketch."""
    if approximate:
        row = df.agg(*[F.percentile_approx(number(c), 0.5).alias(c) for c in columns]).first()
        return {c: row[c] for c in columns}
    found = exact_quantiles(df, columns, [0.5])
    return {c: found[None, c][0] for c in columns}


def impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Replace missing values by the fitted medians."""
    return df.withColumns(
        {
            c: F.expr(f"coalesce({known(c)}, {literal(float(m))})")
            for c, m in medians.items()
            if m is not None
        }
    )


def fit_caps(
    df: DataFrame, columns: Sequence[str], quantile: float = 0.99, small_group_rows: int = SMALL_GROUP_ROWS
) -> dict[str, float]:
    """Upper cap per column; fit it on the imputed table."""
    found = exact_quantiles(df, columns, [quantile], small_group_rows=small_group_rows)
    return {c: found[None, c][0] for c in columns}


def cap(df: DataFrame, caps: Mapping[str, float]) -> DataFrame:
    """Lower every value above its cap to the cap; missing values stay missing."""
    return df.withColumns(
        {
            c: F.expr(f"CASE WHEN {known(c)} > {literal(float(v))} THEN {literal(float(v))} ELSE {known(c)} END")
            for c, v in caps.items()
            if v is not None
        }
    )


def cap_audit(df: DataFrame, caps: Mapping[str, float], digits: int = 2) -> DataFrame:
    """``(column, max_before, cap, max_after)`` of a capping step, in one aggregate.

    A column without a cap keeps its values.
    """
    top = df.agg(*[F.max(number(c)).alias(c) for c in caps])
    return stack(
        top,
        ["column", "max_before", "cap", "max_after"],
        [
            [
                literal(c),
                even(name(c), digits),
                "CAST(NULL AS DOUBLE)" if v is None else even(literal(float(v)), digits),
                even(f"least({name(c)}, {'NULL' if v is None else literal(float(v))})", digits),
            ]
            for c, v in caps.items()
        ],
    )


def fit_categories(df: DataFrame, column: str, most: int = CreditConfig.max_categories) -> list[str]:
    """Categories present, in alphabetical order; the first is the reference.

    Each becomes a column, so a column of more than ``most`` values is refused.
    """
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} categories")
    return sorted(r[column] for r in rows)


def one_hot(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """0/1 column per category but the first; unknown or missing gives all zeros."""
    dummies = {
        f"{column}_{v}": F.expr(f"CASE WHEN {name(column)} = {literal(v)} THEN 1 ELSE 0 END")
        for v in categories[1:]
    }
    return df.withColumns(dummies).drop(column)


def fit_standardizer(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """``{column: (mean, population deviation)}``; a zero deviation counts as 1."""
    row = df.agg(
        *[F.avg(number(c)).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(number(c)).alias(f"s_{c}") for c in columns],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def standardize(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {
            c: F.expr(f"({known(c)} - {literal(float(m))}) / {literal(float(s))}")
            for c, (m, s) in scaler.items()
            if m is not None
        }
    )


def standardization_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean of the column means and mean of the sample deviations, one row."""
    row = df.agg(
        *[F.avg(number(c)).alias(f"m_{c}") for c in columns],
        *[F.stddev_samp(number(c)).alias(f"s_{c}") for c in columns],
    )

    def mean_of(prefix: str) -> str:
        total = " + ".join(name(f"{prefix}_{c}") for c in columns)
        return f"({total}) / {literal(float(len(columns)))}"

    return row.selectExpr(
        f"{mean_of('m')} AS mean_of_means", f"{mean_of('s')} AS mean_of_deviations"
    )


def split_sizes(sizes: Mapping[object, int], share: float) -> dict[object, int]:
    """Test rows per class: ``ceil(share * n)`` in all, in proportion to the classes.

    Each class gets the floor of its part; rows still missing go to the classes
    with the largest fractions.
    """
    exact = {value: share * n for value, n in sizes.items()}
    taken = {value: floor(x) for value, x in exact.items()}
    left = ceil(share * sum(sizes.values())) - sum(taken.values())
    by_fraction = sorted(exact, key=lambda value: (taken[value] - exact[value], value))
    for value in by_fraction[:left]:
        taken[value] += 1
    return taken


def held_out_positions(sizes: DataFrame, share: float) -> DataFrame:
    """``(stratum, position)``: ``split_sizes`` of a table ``(stratum, n)`` of any number of classes."""
    exact = F.lit(share) * F.col("n")
    parts = sizes.select("stratum", F.floor(exact).alias("taken"), (F.floor(exact) - exact).alias("order"))
    total = sizes.agg(F.sum("n").alias("n"), F.sum(F.floor(exact)).alias("taken")).first()
    left = ceil(share * (total["n"] or 0)) - (total["taken"] or 0)
    more = parts.orderBy("order", "stratum").limit(left).select("stratum", F.lit(1).alias("more"))
    return parts.join(more, "stratum", "left").selectExpr("stratum", "taken + coalesce(more, 0) AS position")


def stratified_split(df: DataFrame, config: CreditConfig) -> DataFrame:
    """Add ``split``: the first rows of each class in hash order are the test rows.

    Exact class sizes, the same rows whatever the partitioning, any number of
    classes. Rows without a target get no split.
    """
    positions = held_out_positions(stratum_sizes(df, config.target), config.test_share)
    cuts = cut_table(df, config.id_column, config.target, positions, config.seed, config.small_bucket_rows)
    beyond = passed_cuts(df, config.id_column, config.target, cuts, config.seed, "beyond")
    return beyond.withColumn("split", F.expr("CASE beyond WHEN 0 THEN 'test' WHEN 1 THEN 'train' END")).drop("beyond")


def stratified_folds(df: DataFrame, config: CreditConfig) -> DataFrame:
    """Add ``fold`` (0-based): consecutive parts of each class in hash order.

    Class sizes of two folds differ by one row at most.
    """
    k = config.folds
    if k < 2:
        return df.withColumn("fold", F.when(F.col(config.target).isNotNull(), 0))
    ends = stratum_sizes(df, config.target).selectExpr(
        "stratum", f"explode(transform(sequence(1, {k - 1}), i -> (n div {k}) * i + least(i, n % {k}))) AS position"
    )
    cuts = cut_table(df, config.id_column, config.target, ends, config.seed, config.small_bucket_rows)
    return passed_cuts(df, config.id_column, config.target, cuts, config.seed, "fold")


def split_summary(df: DataFrame, target: str, n_features: int) -> DataFrame:
    """Rows, share of all rows and target rate per split."""
    per_split = df.where(F.col("split").isNotNull()).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(target).alias("target_rate")
    )
    # Two or three rows: a global total over the finished groups.
    total = per_split.groupBy().agg(
        F.sum("n_rows").alias("n"), F.collect_list(F.struct("split", "n_rows", "target_rate")).alias("s")
    )
    return total.select("n", F.inline("s")).select(
        "split",
        "n_rows",
        F.expr(quotient("n_rows", "n")).alias("share"),
        "target_rate",
        F.lit(n_features).alias("n_features"),
    )
