"""Exploratory statistics. One aggregate job per table wherever the statistic allows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.config import BinSpec
from scoreloom.functions.columns import (
    cut,
    even,
    literal,
    name,
    number,
    quotient,
    ratio,
    stack,
    text_map,
)
from scoreloom.operators.quantiles import SMALL_GROUP_ROWS, exact_quantiles, quantile_table
from scoreloom.operators.validate import number_missing
from scoreloom.storage import written


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows and percent per class, with the whole-number ratio of class 0 to class 1."""
    classes = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("class")).agg(
        F.count(F.lit(1)).alias("n")
    )
    everything = W.partitionBy(F.lit(0))  # one row per class
    zeros = F.sum(F.when(F.col("class") == 0, F.col("n"))).over(everything)
    ones = F.sum(F.when(F.col("class") == 1, F.col("n"))).over(everything)
    return classes.select(
        "class",
        "n",
        (ratio(F.col("n"), F.sum("n").over(everything)) * 100).alias("pct"),
        F.when(ones > 0, F.floor(zeros / ones)).cast("long").alias("imbalance_ratio"),
    )


def missing_table(df: DataFrame, columns: Sequence[str], alert_pct: float = 5.0) -> DataFrame:
    """Columns with missing values: count, percent to 2 decimals and the alert flag."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n_all"), *[F.count_if(number_missing(df, c)).alias(c) for c in columns]
    )
    long = stack(
        counted,
        ["column", "n_missing", "pct_missing"],
        [
            [literal(c), name(c), even(quotient(f"{name(c)} * 100.0D", "n_all"), 2)]
            for c in columns
        ],
    )
    return long.where(F.col("n_missing") > 0).withColumn(
        "above_alert", (F.col("pct_missing") > alert_pct).cast("int")
    )


def missing_total(df: DataFrame) -> DataFrame:
    """Missing values left in the whole table, one row."""
    counts = [F.count_if(number_missing(df, c)) for c in df.columns]
    return df.agg(sum(counts[1:], counts[0]).alias("n_missing"))


def rate_by_missing(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Target rate and rows by missing flag, for every column in one pass."""
    flags = df.select(target, *[number(c).isNull().cast("int").alias(c) for c in columns])
    return (
        flags.unpivot([target], list(columns), "column", "missing")
        .groupBy("column", "missing")
        .agg(F.count(target).alias("n"), F.avg(target).alias("target_rate"))
    )


def describe(
    df: DataFrame, columns: Sequence[str], small_group_rows: int = SMALL_GROUP_ROWS
) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles, maximum per column."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], small_group_rows=small_group_rows)
    wide = df.agg(*[_moments(number(c)).alias(c) for c in columns])
    return stack(
        wide,
        ["column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"],
        [
            [
                literal(c),
                *[f"{name(c)}.{field}" for field in ("count", "mean", "std", "min")],
                *[f"CAST({literal(q)} AS DOUBLE)" for q in quartiles[None, c]],
                f"{name(c)}.max",
            ]
            for c in columns
        ],
    )


def _moments(x: Column) -> Column:
    return F.struct(
        F.count(x).alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )


def shape_statistics(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Bias-adjusted skewness and excess kurtosis per column.

    The built-in moments are those of the population; fewer than 3 (skewness) or
    4 (kurtosis) values give null.
    """
    wide = df.agg(
        *[
            F.struct(
                F.count(number(c)).cast("double").alias("n"),
                F.skewness(number(c)).alias("g1"),
                F.kurtosis(number(c)).alias("g2"),
            ).alias(c)
            for c in columns
        ]
    )

    def skew(c: str) -> str:
        n = f"{name(c)}.n"
        return f"CASE WHEN {n} > 2 THEN {name(c)}.g1 * sqrt({n} * ({n} - 1)) / ({n} - 2) END"

    def kurt(c: str) -> str:
        n = f"{name(c)}.n"
        return (
            f"CASE WHEN {n} > 3 THEN ({n} - 1) / (({n} - 2) * ({n} - 3)) "
            f"* (({n} + 1) * {name(c)}.g2 + 6) END"
        )

    return stack(
        wide,
        ["column", "skewness", "kurtosis"],
        [[literal(c), even(skew(c), digits), even(kurt(c), digits)] for c in columns],
    )


def class_histogram(
    df: DataFrame, columns: Sequence[str], bins: int, by: str | None = None
) -> DataFrame:
    """Equal-width histogram per column (and class), empty bins included.

    ``(variable, class, bin, low, high, n, density)``; every class has its own
    range, the maximum belongs to the last bin, and a constant column gets a
    range of width 1 around its value. The density integrates to 1.
    """
    keys = [by] if by else []
    data = df.select(*keys, *[number(c).alias(c) for c in columns])
    if by:
        data = data.where(F.col(by).isNotNull())
    values = data.select(F.expr(name(by) if by else "0").alias("class"), *columns).unpivot(
        ["class"], list(columns), "variable", "x"
    )
    ranges = written(_ranges(data, columns, by), "ranges")
    counts = (
        values.where(F.col("x").isNotNull())
        .join(ranges, ["class", "variable"])
        .groupBy("variable", "class", _bin_number(bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    width = (F.col("range_high") - F.col("range_low")) / F.lit(float(bins))
    total = F.sum("n").over(W.partitionBy("variable", "class"))
    result = (
        grid.join(counts, ["variable", "class", "bin"], "left")
        .withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
        .select(
            "variable",
            "class",
            "bin",
            (F.col("range_low") + (F.col("bin") - 1) * width).alias("low"),
            (F.col("range_low") + F.col("bin") * width).alias("high"),
            "n",
            (F.col("n") / (total * width)).alias("density"),
        )
    )
    return result if by else result.drop("class")


def _ranges(data: DataFrame, columns: Sequence[str], by: str | None) -> DataFrame:
    """``(class, variable, range_low, range_high)`` of columns with values."""
    wide = data.groupBy(*([by] if by else [])).agg(
        *[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]
    )
    entries = ", ".join(f"named_struct('variable', {literal(c)}, 'r', {name(c)})" for c in columns)
    found = wide.select(F.expr(name(by) if by else "0").alias("class"), F.expr(f"inline(array({entries}))"))
    return found.where("r.low IS NOT NULL").selectExpr(
        "class",
        "variable",
        "CASE WHEN r.low = r.high THEN r.low - 0.5D ELSE r.low END AS range_low",
        "CASE WHEN r.low = r.high THEN r.high + 0.5D ELSE r.high END AS range_high",
    )


def _bin_number(bins: int) -> Column:
    """1-based bin of ``x`` in its range.

    A value on an edge opens the upper bin, also when scaling left it a rounding
    error below the edge; the maximum belongs to the last bin.
    """
    position = f"(x - range_low) / (range_high - range_low) * {bins}"
    return F.expr(f"CAST(least(floor({even(position, 9)}) + 1, {bins}) AS INT)")


def before_after_histograms(
    before: DataFrame, after: DataFrame, column: str, bins: int, step: str
) -> DataFrame:
    """Counts of one column before and after a preparation step."""
    parts = [
        class_histogram(df, [column], bins).select(
            F.lit(step).alias("step"), F.lit(stage).alias("stage"), "variable", "bin", "low", "high", "n"
        )
        for stage, df in (("before", before), ("after", after))
    ]
    return parts[0].unionByName(parts[1])


def box_statistics(
    df: DataFrame, columns: Sequence[str], by: str, small_group_rows: int = SMALL_GROUP_ROWS
) -> DataFrame:
    """Quartiles, whiskers and number of outside points per column and class.

    A whisker ends at the last value within 1.5 interquartile ranges of the box,
    never inside the box.
    """
    quartiles = quantile_table(df, columns, [0.25, 0.5, 0.75], [by], small_group_rows)
    boxes = quartiles.selectExpr(
        "variable",
        f"{name(by)} AS class",
        *[f"quantiles[{i}] AS {q}" for i, q in enumerate(("q1", "median", "q3"))],
        "quantiles[0] - 1.5D * (quantiles[2] - quantiles[0]) AS low",
        "quantiles[2] + 1.5D * (quantiles[2] - quantiles[0]) AS high",
    )
    boxes = written(boxes, "boxes")
    data = df.where(F.col(by).isNotNull()).select(F.col(by).alias("class"), *[number(c).alias(c) for c in columns])
    outside = (
        data.unpivot(["class"], list(columns), "variable", "x")
        .join(boxes.select("variable", "class", "low", "high"), ["variable", "class"])
        .groupBy("variable", "class")
        .agg(
            F.expr("min(CASE WHEN x >= low THEN x END)").alias("whisker_low"),
            F.expr("max(CASE WHEN x <= high THEN x END)").alias("whisker_high"),
            F.expr("count_if(x < low OR x > high)").alias("n_outside"),
        )
    )
    return boxes.join(outside, ["variable", "class"]).select(
        "variable",
        "class",
        "q1",
        "median",
        "q3",
        F.least("whisker_low", "q1").alias("whisker_low"),
        F.greatest("whisker_high", "q3").alias("whisker_high"),
        "n_outside",
    )


def extreme_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with values above q3 + 3 interquartile ranges, and their number."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    filled = [c for c in columns if quartiles[None, c][0] is not None]

    def limit(c: str) -> float:
        q1, q3 = quartiles[None, c]
        return q3 + 3 * (q3 - q1)

    wide = df.agg(*[F.count_if(number(c) > F.lit(limit(c))).alias(c) for c in filled])
    long = stack(
        wide,
        ["column", "upper_limit", "n_outliers"],
        [[literal(c), literal(limit(c)), name(c)] for c in filled],
    )
    return long.where(F.col("n_outliers") > 0)


def rate_by_value(df: DataFrame, column: str, target: str) -> DataFrame:
    """Rows and target rate per value of a column, with the overall rate.

    ``rate_pct`` is rounded to 2 decimals; order the result by what is shown. The
    overall rate also counts the rows without a value. It is a scalar subquery, so
    a column of many values needs no window over all of them.
    """
    overall = df.agg((F.avg(target) * 100).alias("overall")).scalar()
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(target).alias("n"), F.avg(target).alias("rate"))
        .select(
            "value",
            "n",
            "rate",
            F.expr(even("rate * 100", 2)).alias("rate_pct"),
            overall.alias("overall_rate_pct"),
        )
    )


MOMENTS = "pair int, n long, mean_x double, mean_y double, xx double, yy double, xy double"


def _task_moments(first: np.ndarray, second: np.ndarray):
    """Moments of each pair of columns over the rows of a task where both are known.

    Matrix products give the sums of all pairs at once. They are taken around the
    medians of the first batch, so a constant column has sums of exactly 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, sums = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
            there = ~np.isnan(x)
            if shift is None:
                shift = np.array([np.median(c[t]) if t.any() else 0.0 for c, t in zip(x.T, there.T)])
                shift = np.where(np.isfinite(shift), shift, 0.0)
            x, there = np.where(there, x - shift, 0.0), there.astype(float)
            # Per pair (i, j): rows, sum of x_i, sum of x_i squared, sum of x_i x_j.
            found = np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
            sums = found if sums is None else sums + found
        if sums is None:
            return
        n, total, squares, products = sums
        rows = n[first, second]
        some = np.maximum(rows, 1)
        mean_x, mean_y = total[first, second] / some, total[second, first] / some
        moments = {
            "pair": np.arange(len(first), dtype=np.int32),
            "n": rows.astype(np.int64),
            "mean_x": mean_x + shift[first],
            "mean_y": mean_y + shift[second],
            "xx": squares[first, second] - rows * mean_x**2,
            "yy": squares[second, first] - rows * mean_y**2,
            "xy": products[first, second] - rows * mean_x * mean_y,
        }
        yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in moments.items()})

    return run


def _pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(var_a, var_b, r)`` of each pair over the rows where both are known.

    Each task reduces its rows to the moments of all pairs by matrix products, one
    row per pair and task; these are merged around their common means. A column
    without variation gives null, where the built-in correlation fails.
    """
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    place = {c: i for i, c in enumerate(columns)}
    first, second = (np.array([place[p[side]] for p in pairs]) for side in (0, 1))
    data = df.select(*[number(c).alias(f"c{i}") for i, c in enumerate(columns)])
    moments = data.mapInArrow(_task_moments(first, second), MOMENTS).where("n > 0")
    whole = W.partitionBy("pair")
    # Distances from the least mean, which are exactly 0 for a constant column; then from the common mean.
    apart = moments.withColumns({f"d{v}": F.col(f"mean_{v}") - F.min(f"mean_{v}").over(whole) for v in "xy"})
    common = apart.withColumns(
        {f"d{v}": F.col(f"d{v}") - F.sum(F.col("n") * F.col(f"d{v}")).over(whole) / F.sum("n").over(whole) for v in "xy"}
    )
    merged = common.groupBy("pair").agg(
        F.expr("sum(xy + n * dx * dy)").alias("xy"),
        F.expr("sum(xx + n * dx * dx)").alias("xx"),
        F.expr("sum(yy + n * dy * dy)").alias("yy"),
    )
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, var_a string, var_b string")
    return names.join(merged, "pair", "left").selectExpr("var_a", "var_b", "try_divide(xy, sqrt(xx * yy)) AS r")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, pairwise complete, in one pass.

    Lower triangle as ``(var_a, var_b, r)``, ``var_b`` standing before ``var_a``
    in ``columns``.
    """
    return _pair_correlations(df, [(a, b) for b, a in combinations(columns, 2)])


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, ascending, with its reading."""
    found = _pair_correlations(df, [(c, target) for c in columns])
    effect = F.when(F.col("r") > 0, "risk").when(F.col("r") <= 0, "protective")
    return found.select(F.col("var_a").alias("variable"), "r", effect.alias("effect")).orderBy("r")


def rate_by_bucket(df: DataFrame, buckets: Sequence[BinSpec], target: str) -> DataFrame:
    """Rows and target rate (percent) per fixed bucket; only buckets that occur.

    Buckets are ``(a, b]``: values outside, and the lowest edge itself, vanish.
    """
    positions = {b.variable: list(range(1, len(b.names) + 1)) for b in buckets}
    binned = df.select(
        target, *[cut(b.variable, b.edges, positions[b.variable]).alias(b.variable) for b in buckets]
    )
    grouped = (
        binned.unpivot([target], [b.variable for b in buckets], "variable", "position")
        .where(F.col("position").isNotNull())
        .groupBy("variable", "position")
        .agg(F.count(target).alias("n"), (F.avg(target) * 100).alias("rate_pct"))
    )
    names = text_map({b.variable: b.names for b in buckets})
    return grouped.select(
        "variable",
        "position",
        F.expr(f"element_at({names}[variable], position)").alias("bucket"),
        "n",
        "rate_pct",
    )
