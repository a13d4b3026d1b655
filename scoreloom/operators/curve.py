"""Exact ROC table, the base of every ranking metric."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.columns import blocks, count_up_to, literal, number, same_rows
from scoreloom.storage import written

MAX_WINDOW_ROWS = 1_000_000
RANGES_PER_LEVEL = 1_024


def roc_table(
    df: DataFrame,
    score: str,
    label: str,
    by: Sequence[str] = (),
    weight: str | None = None,
    origin: bool = False,
    max_window_rows: int = MAX_WINDOW_ROWS,
) -> DataFrame:
    """``(by…, threshold, pos, neg, tp, fp, positives, negatives, tpr, fpr)`` per distinct score.

    ``score >= threshold`` is a positive decision. Rows without score or label
    are left out; ``weight`` is an integer row multiplicity. With ``origin`` the
    point (0, 0) at an infinite threshold is added.

    Rows are first reduced to distinct scores, which are counted. If there are at
    most ``max_window_rows``, one window per curve does the running sums.
    Otherwise the distinct scores are cut into ranges, level by level until each
    holds at most so many; each range has a window of its own and starts from the
    totals of the ranges above it.
    """
    keys = list(by)
    multiplicity = F.col(weight) if weight else F.lit(1)
    s = number(score)
    known = df.select(
        *keys,
        s.alias("threshold"),
        F.when((F.col(label) == 1) & s.isNotNull(), multiplicity).otherwise(0).alias("pos"),
        F.when((F.col(label) == 0) & s.isNotNull(), multiplicity).otherwise(0).alias("neg"),
    )
    # Rows without score or label are dropped after counting: a filter before it
    # would evaluate the score a second time.
    counts = (
        known.groupBy(*keys, "threshold")
        .agg(F.sum("pos").cast("long").alias("pos"), F.sum("neg").cast("long").alias("neg"))
        .where(F.col("pos") + F.col("neg") > 0)
    )
    # Written once: all that follows reads counts, not scores.
    counts = written(counts, "curve-counts")
    ranged = score_ranges(counts, keys, max_window_rows)
    if ranged is not None:
        group = [*keys, "range"]
        inside = W.partitionBy(*group).orderBy(F.col("threshold").desc())
        above = W.partitionBy(*(keys or [F.lit(0)])).orderBy(F.col("range").desc())
        whole = W.partitionBy(*(keys or [F.lit(0)]))
        # One row per range and curve.
        totals = ranged.groupBy(*group).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
            *group,
            (F.sum("p").over(above) - F.col("p")).alias("tp_above"),
            (F.sum("n").over(above) - F.col("n")).alias("fp_above"),
            F.sum("p").over(whole).alias("positives"),
            F.sum("n").over(whole).alias("negatives"),
        )
        running = ranged.withColumns({"tp": F.sum("pos").over(inside), "fp": F.sum("neg").over(inside)})
        curve = same_rows(running, written(totals, "range-totals"), group).withColumns(
            {"tp": F.col("tp") + F.col("tp_above"), "fp": F.col("fp") + F.col("fp_above")}
        )
    else:
        part = keys or [F.lit(0)]
        above = W.partitionBy(*part).orderBy(F.col("threshold").desc())
        whole = W.partitionBy(*part)
        curve = counts.withColumns(
            {
                "tp": F.sum("pos").over(above),
                "fp": F.sum("neg").over(above),
                "positives": F.sum("pos").over(whole),
                "negatives": F.sum("neg").over(whole),
            }
        )
    columns = [*keys, "threshold", "pos", "neg", "tp", "fp", "positives", "negatives"]
    curve = curve.select(*columns)
    if origin:
        start = curve.groupBy(*keys).agg(
            F.first("positives").alias("positives"), F.first("negatives").alias("negatives")
        )
        zero = F.lit(0).cast("long")
        curve = curve.unionByName(
            start.select(
                *keys,
                F.lit(float("inf")).alias("threshold"),
                *[zero.alias(c) for c in ("pos", "neg", "tp", "fp")],
                "positives",
                "negatives",
            )
        )
    return curve.withColumns(
        {
            "tpr": F.try_divide(F.col("tp").cast("double"), F.col("positives").cast("double")),
            "fpr": F.try_divide(F.col("fp").cast("double"), F.col("negatives").cast("double")),
        }
    )


def score_ranges(counts: DataFrame, keys: Sequence[str], max_window_rows: int) -> DataFrame | None:
    """``counts`` with ``range``, in score order, of at most ``max_window_rows`` distinct scores each.

    None if every curve has at most so many. The cuts of a range are percentiles of
    its distinct scores, so parts hold few of them however the rows are spread, and
    each curve has cuts of its own in a table. A level cuts every range that is too
    large into at most ``RANGES_PER_LEVEL``; two levels serve 10^12 scores a curve.
    The driver reads one number per level.
    """
    ranged = counts.withColumn("range", F.lit(0).cast("long"))
    group, level = [*keys, "range"], 0
    while True:
        largest = ranged.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
        if largest <= max_window_rows:
            return ranged if level else None
        steps = min(RANGES_PER_LEVEL, ceil(2 * largest / max_window_rows))
        shares = ", ".join(literal(i / steps) for i in range(1, steps))
        cuts = (
            ranged.groupBy(*group)
            .agg(F.count(F.lit(1)).alias("n"), F.expr(f"percentile_approx(threshold, array({shares}), {10 * steps})").alias("cuts"))
            .where(F.col("n") > max_window_rows)
            .select(*group, F.expr(blocks("cuts")).alias("cuts"))
        )
        cut = same_rows(ranged, written(cuts, "curve-cuts"), group, "left")
        part = f"coalesce({count_up_to('threshold', 'cuts')}, 0)"
        finer = F.expr(f"range * {RANGES_PER_LEVEL} + CASE WHEN cuts IS NULL THEN 0 ELSE {part} END")
        ranged = cut.withColumn("range", finer).drop("cuts")
        level += 1
