"""Many scorecards at once: their parameters as a table, looked up per row.

One scorecard is best applied as literals (``score``). A bank has hundreds: by
segment, by version, by challenger. Here each is a row with sorted edge arrays, and
every applicant finds its own by a join with that small table; classes and bands
are then found by a search in the arrays, all in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.columns import BLOCK, count_up_to, known, literal, name
from scoreloom.sources.params import Scorecard
from scoreloom.storage import written

CARD_SCHEMA = """
    card string,
    variables map<string, struct<low: double, edges: array<array<double>>, woe: array<double>, coefficient: double, median: double, cap: double>>,
    effects map<string, double>,
    categories map<string, double>,
    intercept double,
    lowers array<array<double>>,
    bands array<struct<label: string, color: string, recommendation: string, level: int>>
"""


def _in_blocks(values: Sequence[float]) -> list[list[float]]:
    return [[float(v) for v in values[i : i + BLOCK]] for i in range(0, len(values), BLOCK)]


def card_table(spark: SparkSession, cards: Mapping[str, Scorecard]) -> DataFrame:
    """One row per named scorecard, written once, so that the planner knows its size.

    ``variables`` holds the binned ones, ``effects`` the coefficients of plain
    columns, ``categories`` those of the values of the category column.
    """
    rows = []
    for key, card in cards.items():
        binned = {
            b.variable: (
                float(b.edges[0]),
                _in_blocks(b.edges),
                [card.woe[b.variable].get(n) for n in b.names],
                float(card.coefficients.get(b.variable, 0.0)),
                card.medians.get(b.variable),
                card.caps.get(b.variable),
            )
            for b in card.bins
        }
        dummies = {f"{card.category_column}_{v}": v for v in card.categories}
        effects = {f: float(b) for f, b in card.coefficients.items() if f not in binned and f not in dummies}
        categories = {v: float(card.coefficients[f]) for f, v in dummies.items() if f in card.coefficients}
        bands = [(b.label, b.color, b.recommendation, b.level) for b in card.bands]
        rows.append((key, binned, effects, categories, float(card.intercept), _in_blocks([b.lower for b in card.bands]), bands))
    return written(spark.createDataFrame(rows, CARD_SCHEMA), "scorecards")


def _woe(x: str, variable: str) -> str:
    """WOE of the right-closed class that holds ``x``, as SQL text; the lowest edge is in the first class."""
    place = count_up_to(x, f"{variable}.edges", strictly=True)
    return f"CASE WHEN {x} = {variable}.low THEN {variable}.woe[0] WHEN {x} IS NOT NULL THEN get({variable}.woe, {place} - 1) END"


def _with_card(df: DataFrame, cards: DataFrame, by: str) -> DataFrame:
    """Each row with the parameters of its card; rows of unknown cards have none."""
    return df.join(cards.select(F.struct("*").alias("c")), F.col(by) == F.col("c.card"), "left")


def woe_lookup(df: DataFrame, cards: DataFrame, variables: Sequence[str], by: str) -> DataFrame:
    """Replace each variable by its WOE under the scorecard that column ``by`` names.

    Missing values, values outside the edges and classes unseen in fitting give
    null, and so does a variable that the scorecard does not bin.
    """
    values = {v: f"x_{i}" for i, v in enumerate(variables)}
    held = _with_card(df, cards, by).withColumns(
        {x: F.expr(known(v)) for v, x in values.items()}
        | {f"v_{x}": F.expr(f"c.variables[{literal(v)}]") for v, x in values.items()}
    )
    replaced = held.withColumns({v: F.expr(_woe(x, f"v_{x}")) for v, x in values.items()})
    return replaced.drop("c", *values.values(), *[f"v_{x}" for x in values.values()])


def score_many(
    df: DataFrame,
    cards: DataFrame,
    by: str,
    variables: Sequence[str],
    flags: Sequence[str] = (),
    category: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(keep…, <by>, pd, pd_score, pd_pct, risk_band, recommendation)`` under the row's own scorecard.

    The score of ``score``, with the card of column ``by``: values are imputed,
    capped and replaced by their WOE; ``flags`` are plain columns and ``category``
    the category column. A part that the card does not use, or that the table does
    not have, counts as 0; without a card, or with a missing WOE, the score is null.
    """
    present = [v for v in variables if v in df.columns]
    held = _with_card(df, cards, by).withColumns({f"v_{i}": F.expr(f"c.variables[{literal(v)}]") for i, v in enumerate(present)})
    filled = held.withColumns({f"x_{i}": F.expr(f"coalesce({known(v)}, v_{i}.median)") for i, v in enumerate(present)})
    capped = filled.withColumns({f"x_{i}": F.expr(f"CASE WHEN x_{i} > v_{i}.cap THEN v_{i}.cap ELSE x_{i} END") for i in range(len(present))})
    terms = ["c.intercept"]
    terms += [f"CASE WHEN v_{i} IS NULL THEN 0.0D ELSE v_{i}.coefficient * {_woe(f'x_{i}', f'v_{i}')} END" for i in range(len(present))]
    terms += [f"coalesce(c.effects[{literal(f)}], 0.0D) * CAST({name(f)} AS DOUBLE)" for f in flags if f in df.columns]
    if category in df.columns:
        terms.append(f"coalesce(c.categories[{name(category)}], 0.0D)")
    scored = capped.select(*keep, by, "c", F.expr(f"1.0D / (1.0D + exp(-({' + '.join(terms)})))").alias("pd"))
    place = count_up_to("pd", "c.lowers")
    band = f"CASE WHEN pd IS NOT NULL THEN coalesce(get(c.bands, {place} - 1), element_at(c.bands, -1)) END"
    return scored.select(
        *keep,
        by,
        "pd",
        F.bround("pd", 4).alias("pd_score"),
        F.bround(F.col("pd") * 100, 2).alias("pd_pct"),
        F.expr(band).alias("risk_band"),
    ).withColumn("recommendation", F.col("risk_band.recommendation"))
