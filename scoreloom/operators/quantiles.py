"""Exact quantiles (linear interpolation) with bounded memory, for any number of groups.

The built-in ``percentile`` keeps every distinct value of a group in one buffer.
That is used only where the group is proven small. Larger groups are narrowed:
each pass counts a fixed number of cells between the current bounds, keeps the
cell holding the wanted rank, and shrinks the bounds to that cell's own minimum
and maximum, until few rows are left or all of them are equal. Every pass is a
scan with a map-side combine; no pass sorts or collects the column. The bounds
are a table of their own, joined to the rows, so neither they nor the result
pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.columns import literal, name, number
from scoreloom.storage import written

SMALL_GROUP_ROWS = 1_000_000
CELLS = 1024


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: str | None = None,
    small_group_rows: int = SMALL_GROUP_ROWS,
    cells: int = CELLS,
) -> dict[tuple[object, str], list[float | None]]:
    """Quantiles of each column, per value of ``by``, as ``{(group, column): values}``.

    For results that the driver needs: one entry per group and column. Many groups
    belong in ``quantile_table``.
    """
    table = quantile_table(df, columns, probabilities, [by] if by else [], small_group_rows, cells)
    return {(r[by] if by else None, r["variable"]): list(r["quantiles"]) for r in table.collect()}


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    small_group_rows: int = SMALL_GROUP_ROWS,
    cells: int = CELLS,
) -> DataFrame:
    """``(by…, variable, quantiles)``: the quantiles of each column in each group, in order.

    Missing values are skipped; a group without values gives nulls, rows where a
    key is null belong to no group. Only one number is read on the way, the size
    of the largest group (and of what is left of it, pass by pass).
    """
    keys = list(by)
    data = df.select(*keys, *[number(c).alias(c) for c in columns])
    for key in keys:
        data = data.where(F.col(key).isNotNull())
    sizes = data.groupBy(*keys).agg(
        *[
            F.struct(F.count(c).alias("rows"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c)
            for c in columns
        ]
    )
    if keys:
        sizes = written(sizes, "group-sizes")
    largest = sizes.agg(F.max(F.greatest(*[F.col(c)["rows"] for c in columns], F.lit(0).cast("long")))).first()[0] or 0
    if largest <= small_group_rows:
        return _by_column(data.groupBy(*keys).agg(*[_percentiles(c, probabilities).alias(c) for c in columns]), keys, columns, "quantiles")
    if not keys:
        sizes = written(sizes, "group-sizes")
    target = [*keys, "variable"]
    groups = _by_column(sizes, keys, columns, "size").select(*target, "size.rows", "size.low", "size.high")
    long = data.unpivot(keys, list(columns), "variable", "value")
    large = groups.where(F.col("rows") > small_group_rows)
    small = (
        long.join(large.select(*target), target, "left_anti")
        .groupBy(*target)
        .agg(_percentiles("value", probabilities).alias("quantiles"))
    )
    return small.unionByName(_narrowed(long.where(F.col("value").isNotNull()), large, target, probabilities, small_group_rows, cells))


def _percentiles(column: str, probabilities: Sequence[float]):
    """The built-in percentiles of a group; an array of nulls for a group without values."""
    wanted = ", ".join(literal(float(p)) for p in probabilities)
    return F.expr(f"coalesce(percentile({name(column)}, array({wanted})), array_repeat(CAST(NULL AS DOUBLE), {len(probabilities)}))")


def _by_column(wide: DataFrame, keys: Sequence[str], columns: Sequence[str], value: str) -> DataFrame:
    """One row per group and column of a table with one row per group."""
    entries = ", ".join(f"named_struct('variable', {literal(c)}, '{value}', {name(c)})" for c in columns)
    return wide.select(*keys, F.expr(f"inline(array({entries}))"))


def _narrowed(
    long: DataFrame, large: DataFrame, target: Sequence[str], probabilities: Sequence[float], small_group_rows: int, cells: int
) -> DataFrame:
    """Quantiles of the large groups, ``(target…, quantiles)``."""
    positions = ", ".join(f"{literal(float(p))} * (rows - 1)" for p in probabilities)
    # One bracket per group, column and wanted rank: ``rows`` values from ``low`` to
    # ``high``, after ``below`` smaller ones. ``value`` stands at ``rank``, ``following`` after it.
    start = large.withColumn("place", F.expr(f"explode(array_distinct(transform(array({positions}), x -> CAST(floor(x) AS BIGINT))))"))
    brackets = start.select(
        *target, F.col("place").alias("rank"), F.lit(0).cast("long").alias("below"), "rows", "low", "high",
        F.lit(None).cast("double").alias("value"), F.lit(None).cast("double").alias("following"),
    )
    brackets = written(_settled(brackets), "brackets")
    done = brackets.where(F.col("value").isNotNull())
    todo = brackets.where(F.col("value").isNull())
    while True:
        most = todo.agg(F.max("rows")).first()[0]
        if most is None:
            break
        wide = most > small_group_rows
        step = _cells_of(long, todo, target, cells) if wide else _values_of(long, todo, target)
        step = written(_settled(step), "brackets")
        done = done.unionByName(step.where(F.col("value").isNotNull()))
        todo = step.where(F.col("value").isNull())
    found = done.groupBy(*target).agg(F.map_from_entries(F.collect_list(F.struct("rank", F.struct("value", "following")))).alias("at"))
    # Equal neighbours are not interpolated, which also keeps infinite values intact.
    interpolated = (
        f"transform(array({positions}), x -> CASE WHEN x = floor(x) OR at[CAST(floor(x) AS BIGINT)].value = at[CAST(floor(x) AS BIGINT)].following "
        "THEN at[CAST(floor(x) AS BIGINT)].value "
        "ELSE (1 - (x - floor(x))) * at[CAST(floor(x) AS BIGINT)].value + (x - floor(x)) * at[CAST(floor(x) AS BIGINT)].following END)"
    )
    return found.join(large, list(target)).select(*target, F.expr(interpolated).alias("quantiles"))


def _settled(brackets: DataFrame) -> DataFrame:
    """Fill ``value`` and ``following`` where the bounds tell them."""
    value = F.expr(
        "CASE WHEN value IS NOT NULL THEN value WHEN low = high THEN low WHEN rank = below + rows - 1 THEN high END"
    )
    following = F.expr(
        "CASE WHEN following IS NOT NULL THEN following WHEN rank + 1 < below + rows THEN CASE WHEN low = high THEN low END "
        "WHEN value IS NOT NULL OR rank = below + rows - 1 THEN high END"
    )
    return brackets.withColumns({"value": value, "following": following})


def _inside(long: DataFrame, brackets: DataFrame, target: Sequence[str]) -> DataFrame:
    """The rows of each bracket; a small bracket table is broadcast by the planner, which knows its size."""
    return long.withColumnRenamed("value", "x").join(brackets, list(target)).where(F.col("x").between(F.col("low"), F.col("high")))


def _cells_of(long: DataFrame, brackets: DataFrame, target: Sequence[str], cells: int) -> DataFrame:
    """Each bracket shrunk to the cell that holds its rank."""
    # Infinite bounds leave the finite values in one cell, infinities in cells of their own.
    finite_low, finite_high = F.greatest("low", F.lit(-1e300)), F.least("high", F.lit(1e300))
    cell = (
        F.when(F.col("x") < finite_low, 0)
        .when(F.col("x") > finite_high, cells + 1)
        .otherwise(F.least(F.width_bucket("x", finite_low, finite_high, F.lit(cells)), F.lit(cells)))
    )
    bracket = [*target, "rank"]
    counted = (
        _inside(long, brackets, target)
        .groupBy(*bracket, cell.alias("cell"))
        .agg(
            F.first("below").alias("before"),
            F.first("following").alias("following"),
            F.count(F.lit(1)).alias("rows"),
            F.min("x").alias("low"),
            F.max("x").alias("high"),
        )
    )
    return _holding(counted, bracket, "cell").select(
        *bracket, "below", "rows", "low", "high", F.lit(None).cast("double").alias("value"), "following"
    )


def _values_of(long: DataFrame, brackets: DataFrame, target: Sequence[str]) -> DataFrame:
    """Each bracket, of a bounded number of rows, shrunk to the value at its rank."""
    bracket = [*target, "rank"]
    counted = (
        _inside(long, brackets, target)
        .groupBy(*bracket, F.col("x").alias("low"))
        .agg(F.first("below").alias("before"), F.first("following").alias("following"), F.count(F.lit(1)).alias("rows"))
        .withColumn("high", F.col("low"))
    )
    return _holding(counted, bracket, "low").select(
        *bracket, "below", "rows", "low", "high", F.lit(None).cast("double").alias("value"), "following"
    )


def _holding(counted: DataFrame, bracket: Sequence[str], order: str) -> DataFrame:
    """The counted part of each bracket that holds its rank, and the value after it where that ends the part."""
    up_to = W.partitionBy(*bracket).orderBy(order)  # a bounded number of parts
    placed = counted.withColumns({"through": F.sum("rows").over(up_to), "next_low": F.lead("low").over(up_to)})
    return (
        placed.withColumn("below", F.col("before") + F.col("through") - F.col("rows"))
        .where("rank >= below AND rank < below + rows")
        .withColumn("following", F.expr("coalesce(following, CASE WHEN rank = below + rows - 1 THEN next_low END)"))
    )
