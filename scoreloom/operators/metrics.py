"""Classification metrics, exact with tied scores.

Ranking metrics are small aggregates of the ROC table; threshold metrics are
projections of the confusion counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.config import COMPARED_METRICS, METRIC_SUMMARY, Limit
from scoreloom.functions.columns import even, literal, name, number, quotient, ratio, same_rows, stack
from scoreloom.storage import written

KS_GRID_POINTS = 300


def curve_metrics(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AUC, Gini, KS, the largest TPR − FPR and the highest threshold reaching it.

    A score that never separates in its own direction has an infinite threshold;
    one class only gives nulls.
    """
    neg, pos = F.col("neg").cast("double"), F.col("pos").cast("double")
    pos_above = F.col("tp").cast("double") - pos
    pairs = F.first("positives").cast("double") * F.first("negatives").cast("double")
    gap = F.col("tpr") - F.col("fpr")
    best = F.max(F.when(gap.isNotNull(), F.struct(gap.alias("gap"), "threshold")))
    return (
        curve.groupBy(*by)
        .agg(
            F.sum(neg * (pos_above + pos / 2)).alias("concordant"),
            pairs.alias("pairs"),
            F.max(F.abs(gap)).alias("ks"),
            best.alias("best"),
        )
        .select(*by, ratio(F.col("concordant"), F.col("pairs")).alias("auc"), "ks", "best")
        .select(
            *by,
            "auc",
            (2 * F.col("auc") - 1).alias("gini"),
            "ks",
            F.col("best.gap").alias("ks_curve"),
            F.when(F.col("best.gap") > 0, F.col("best.threshold"))
            .when(F.col("best.gap").isNotNull(), F.lit(float("inf")))
            .alias("threshold"),
        )
    )


def ks_grid(df: DataFrame, score: str, label: str, points: int = KS_GRID_POINTS) -> DataFrame:
    """Share of each class at or below each of ``points`` equally spaced scores of [0, 1].

    ``(point, threshold, cum_class0, cum_class1, gap, is_largest)``; each score
    is mapped to the first grid point not below it, so the rows meet the grid by
    counting, not by a join. ``is_largest`` marks the first point of largest gap.
    """
    last = points - 1
    # The product may land beside the grid value that is shown, so the index is
    # corrected by comparing with its neighbours.
    near = f"ceil(s * {last})"
    exact = f"CASE WHEN ({near} - 1) / {last}D >= s THEN {near} - 1 WHEN {near} / {last}D < s THEN {near} + 1 ELSE {near} END"
    # Scores above 1 are counted in the totals only, missing ones not at all. The
    # point is never null: a null test would reach the scan with the whole score.
    index = f"CASE WHEN s <= 1 THEN greatest({exact}, 0) WHEN s > 1 THEN {points} ELSE -1 END"
    counted = (
        df.select(number(score).alias("s"), label)
        .select(F.expr(f"coalesce(CAST({index} AS INT), -1)").alias("point"), label)
        .groupBy("point")
        .agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    )
    grid = df.sparkSession.range(points + 1).select(F.col("id").cast("int").alias("point"))
    # points + 1 rows from here on.
    one = W.partitionBy(F.lit(0))
    up_to = one.orderBy("point")
    filled = grid.join(counted, "point", "left").fillna(0, ["n0", "n1"])
    curve = filled.select(
        "point",
        ratio(F.sum("n0").over(up_to), F.sum("n0").over(one)).alias("cum_class0"),
        ratio(F.sum("n1").over(up_to), F.sum("n1").over(one)).alias("cum_class1"),
    ).where(F.col("point") < points)
    gap = F.abs(F.col("cum_class1") - F.col("cum_class0"))
    ranked = curve.withColumn("gap", gap).withColumn(
        "order", F.row_number().over(one.orderBy(F.col("gap").desc_nulls_last(), "point"))
    )
    return ranked.select(
        "point",
        (F.col("point") / F.lit(float(last))).alias("threshold"),
        "cum_class0",
        "cum_class1",
        "gap",
        ((F.col("order") == 1) & F.col("gap").isNotNull()).cast("int").alias("is_largest"),
    )


def confusion(
    df: DataFrame, label: str, decision: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """``(by…, tn, fp, fn, tp)``, one row per group."""
    y, d = F.col(label), F.col(decision)
    rows = F.col(weight) if weight else F.lit(1)

    def cell(actual: int, predicted: int) -> Column:
        return F.coalesce(
            F.sum(F.when((y == actual) & (d == predicted), rows)).cast("long"), F.lit(0).cast("long")
        )

    return df.groupBy(*by).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def confusion_long(cells: DataFrame) -> DataFrame:
    """``(actual, predicted, n, share)``; shares are of the actual class."""
    long = stack(
        cells,
        ["actual", "predicted", "n"],
        [
            ["0", "0", "tn"],
            ["0", "1", "fp"],
            ["1", "0", "fn"],
            ["1", "1", "tp"],
        ],
    )
    whole = F.sum("n").over(W.partitionBy("actual"))
    return long.withColumn("share", ratio(F.col("n"), whole))


def _or_zero(numerator: str, denominator: str) -> str:
    return f"coalesce({quotient(numerator, denominator)}, 0.0D)"


def _measures(hit: str, false: str, missed: str) -> dict[str, str]:
    return {
        "precision": _or_zero(hit, f"({hit} + {false})"),
        "recall": _or_zero(hit, f"({hit} + {missed})"),
        "f1": _or_zero(f"(2 * {hit})", f"(2 * {hit} + {false} + {missed})"),
    }


def threshold_metrics(cells: DataFrame) -> DataFrame:
    """Add precision, recall, F1 (0 where undefined) and specificity (null where undefined)."""
    added = {**_measures("tp", "fp", "fn"), "specificity": quotient("tn", "(tn + fp)")}
    return cells.withColumns({c: F.expr(e) for c, e in added.items()})


def classification_report(cells: DataFrame, names: Mapping[int, str]) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages."""
    shown = ("precision", "recall", "f1")
    class0, class1 = _measures("tn", "fn", "fp"), _measures("tp", "fp", "fn")
    both = cells.selectExpr(
        *[f"{class0[m]} AS {m}0" for m in shown],
        *[f"{class1[m]} AS {m}1" for m in shown],
        "tn + fp AS support0",
        "tp + fn AS support1",
        "tn + fp + fn + tp AS n",
        f"{_or_zero('(tn + tp)', '(tn + fp + fn + tp)')} AS accuracy",
    )
    weighted = [_or_zero(f"({m}0 * support0 + {m}1 * support1)", "n") for m in shown]
    return stack(
        both,
        ["row", *shown, "support"],
        [
            [literal(names[0]), *[f"{m}0" for m in shown], "support0"],
            [literal(names[1]), *[f"{m}1" for m in shown], "support1"],
            ["'accuracy'", *["accuracy"] * 3, "n"],
            ["'macro avg'", *[f"({m}0 + {m}1) / 2" for m in shown], "n"],
            ["'weighted avg'", *weighted, "n"],
        ],
    )


def score_summary(df: DataFrame, score: str, label: str) -> DataFrame:
    """Smallest and largest score, and the mean score of each class, one row."""
    s = number(score)
    return df.agg(
        F.min(s).alias("min_score"),
        F.max(s).alias("max_score"),
        F.avg(F.when(F.col(label) == 1, s)).alias("mean_class1"),
        F.avg(F.when(F.col(label) == 0, s)).alias("mean_class0"),
    )


def at_optimal_threshold(
    df: DataFrame, score: str, label: str, ranking: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Add ``decision`` at the optimal threshold of each group's curve.

    ``ranking`` is the output of ``curve_metrics``. The threshold of a single curve is
    a literal; those of several are joined, so that there may be any number.
    """
    if not by:
        row = ranking.select("threshold").first()
        chosen = F.lit(row["threshold"] if row else None).cast("double")
        return df.withColumn("decision", (number(score) >= chosen).cast("int"))
    thresholds = written(ranking.select(*by, F.col("threshold").alias("chosen_threshold")), "thresholds")
    decided = same_rows(df, thresholds, by, "left")
    return decided.withColumn("decision", (number(score) >= F.col("chosen_threshold")).cast("int")).drop("chosen_threshold")


def benchmark_gate(metrics: DataFrame, limits: Sequence[Limit]) -> DataFrame:
    """Compare ``(metric, value)`` rows with their limits.

    ``(metric, value, relation, bound, passed)``; metrics without a limit have
    nulls. There is one row per metric.
    """

    def choose(result) -> str:
        cases = " ".join(f"WHEN {literal(x.metric)} THEN {result(x)}" for x in limits)
        return f"CASE metric {cases} END"

    return metrics.selectExpr(
        "metric",
        "value",
        f"{choose(lambda x: literal(x.relation))} AS relation",
        f"{choose(lambda x: literal(float(x.bound)))} AS bound",
        f"CAST({choose(lambda x: f'value {x.relation} {literal(float(x.bound))}')} AS INT) AS passed",
    )


def metric_summary(metrics: DataFrame, limits: Sequence[Limit]) -> DataFrame:
    """``(position, label, value, relation, bound, interpretation)`` of ``(metric, value)`` rows.

    The rows of ``METRIC_SUMMARY``, values to 4 decimals. The interpretation
    follows from the limit; a train AUC is read like the test AUC, and metrics
    without limit or value have none.
    """
    shared = {"auc_train": "auc"}
    shown = {m: (i, label) for i, (label, m) in enumerate(METRIC_SUMMARY, start=1)}
    of = {x.metric: x for x in limits}

    def choose(result) -> str:
        cases = " ".join(
            f"WHEN {literal(m)} THEN {result(of[shared.get(m, m)])}" for m in shown if shared.get(m, m) in of
        )
        return f"CASE metric {cases} END"

    place = " ".join(f"WHEN {literal(m)} THEN {i}" for m, (i, _) in shown.items())
    label = " ".join(f"WHEN {literal(m)} THEN {literal(text)}" for m, (_, text) in shown.items())
    reading = choose(
        lambda x: f"CASE WHEN value {x.relation} {literal(float(x.bound))} THEN {literal(x.reading)} "
        f"WHEN value IS NOT NULL THEN {literal(x.warning)} END"
    )
    return metrics.where(F.col("metric").isin(list(shown))).selectExpr(
        f"CASE metric {place} END AS position",
        f"CASE metric {label} END AS label",
        f"{even('value', 4)} AS value",
        f"{choose(lambda x: literal(x.relation))} AS relation",
        f"{choose(lambda x: literal(float(x.bound)))} AS bound",
        f"coalesce({reading}, '—') AS interpretation",
    )


def compare_models(ranking: DataFrame, cells: DataFrame, models: Mapping[str, str]) -> DataFrame:
    """Metrics side by side: ``(metric, one column per model)``, rounded to 4 decimals.

    ``ranking`` and ``cells`` have a ``model`` column and one row per model;
    ``models`` maps its values to output columns.
    """
    joined = threshold_metrics(cells).join(ranking, "model")
    entries = [
        f"named_struct('position', {i}, 'metric', {literal(shown)}, 'value', {even(f'CAST({name(c)} AS DOUBLE)', 4)})"
        for i, (shown, c) in enumerate(COMPARED_METRICS)
    ]
    long = joined.selectExpr("model", f"inline(array({', '.join(entries)}))")
    wide = long.groupBy("position", "metric").pivot("model", list(models)).agg(F.first("value"))
    return wide.select("position", "metric", *[F.col(f"`{m}`").alias(c) for m, c in models.items()])
