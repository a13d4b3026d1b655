"""Scorecard columns: probability, band, contributions. All narrow, no join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloom.config import Band
from scoreloom.functions.columns import literal, name, text_map


def aligned(feature: str, available: Sequence[str]) -> str:
    """Feature as SQL text, or 0.0 where the table does not have it."""
    return f"CAST({name(feature)} AS DOUBLE)" if feature in available else "0.0D"


def contribution(feature: str, coefficient: float, available: Sequence[str]) -> str:
    return f"({literal(float(coefficient))} * {aligned(feature, available)})"


def probability(coefficients: Mapping[str, float], intercept: float, available: Sequence[str]) -> Column:
    """Default probability of a fitted linear model, as a plain expression."""
    terms = [literal(float(intercept)), *(contribution(f, b, available) for f, b in coefficients.items())]
    return F.expr(f"1.0D / (1.0D + exp(-({' + '.join(terms)})))")


def risk_band(probability_column: str, bands: Sequence[Band]) -> Column:
    """Band struct of an unrounded probability; out of range falls in the last band."""

    def as_struct(band: Band) -> str:
        fields = {
            "label": band.label,
            "color": band.color,
            "recommendation": band.recommendation,
            "level": band.level,
        }
        return "named_struct(" + ", ".join(f"'{k}', {literal(v)}" for k, v in fields.items()) + ")"

    p, last = name(probability_column), as_struct(bands[-1])
    ladder = [f"WHEN {p} IS NULL THEN NULL", f"WHEN {p} < {literal(float(bands[0].lower))} THEN {last}"]
    ladder += [
        f"WHEN {p} < {literal(float(upper.lower))} THEN {as_struct(band)}"
        for band, upper in zip(bands, bands[1:])
    ]
    return F.expr(f"CASE {' '.join(ladder)} ELSE {last} END")


def contributions(coefficients: Mapping[str, float], available: Sequence[str]) -> Column:
    """``ARRAY<STRUCT<feature, value>>``, largest absolute value first, then feature order."""
    entries = [
        f"named_struct('key', -abs({value}), 'position', {i}, 'feature', {literal(f)}, 'value', {value})"
        for i, (f, value) in enumerate(
            (f, contribution(f, b, available)) for f, b in coefficients.items()
        )
    ]
    ranked = f"sort_array(array({', '.join(entries)}))"
    return F.expr(f"transform({ranked}, e -> named_struct('feature', e.feature, 'value', e.value))")


def display_name(column: str, names: Mapping[object, str]) -> Column:
    """Readable name of a code; an unknown code is shown as it is."""
    code = name(column)
    return F.expr(f"coalesce({text_map(names)}[{code}], CAST({code} AS STRING))")
