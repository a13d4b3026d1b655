"""Small helpers shared by the operators.

Long ladders and wide lists are written as SQL expressions: one parsed text is
far cheaper to build than hundreds of nested column calls.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import isinf, isnan

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def name(column: str) -> str:
    """Quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def literal(value: object) -> str:
    """SQL literal of a Python value; numbers with a fraction are DOUBLE."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        if isinf(value) or isnan(value):
            return f"double('{value}')"
        return f"{value!r}D"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def known(column: str) -> str:
    """Column as DOUBLE with NaN turned to null, as SQL text."""
    x = f"CAST({name(column)} AS DOUBLE)"
    return f"CASE WHEN NOT isnan({x}) THEN {x} END"


def number(column: str) -> Column:
    """Column as DOUBLE with NaN turned to null, so that NaN never counts as a value."""
    return F.expr(known(column))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating-point column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.expr(f"CASE WHEN NOT isnan({name(c)}) THEN {name(c)} END") for c in floats})


def even(expression: str, digits: int) -> str:
    """Half-even rounding of a table value by scaling to an integer, as SQL text."""
    scale = literal(float(10**digits))
    return f"rint(({expression}) * {scale}) / {scale}"


def round_even(column: str, digits: int) -> Column:
    return F.expr(even(name(column), digits))


def quotient(numerator: str, denominator: str) -> str:
    """Quotient as DOUBLE, null where the denominator is 0, as SQL text."""
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def when_class(column: str, values: Mapping[object, object]) -> str:
    """Literal chosen by the value of ``column``, null for a value not listed, as SQL text."""
    if not values:
        return "NULL"
    pairs = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in values.items())
    return f"CASE {name(column)} {pairs} END"


def cut(
    column: str, edges: Sequence[float], results: Sequence[object], include_lowest: bool = False
) -> Column:
    """Result of the right-closed class ``(edges[i], edges[i+1]]`` that holds the value.

    Null, NaN and values outside the edges give null. The lowest edge itself
    belongs to the first class only with ``include_lowest``.
    """
    # NaN sorts above infinity, so like null it satisfies none of the comparisons.
    x, low = name(column), float(edges[0])
    below = [] if isinf(low) and include_lowest else [
        f"WHEN {x} {'<' if include_lowest else '<='} {literal(low)} THEN NULL"
    ]
    ladder = [f"WHEN {x} <= {literal(float(e))} THEN {literal(r)}" for e, r in zip(edges[1:], results)]
    return F.expr(f"CASE {' '.join(below + ladder)} END")


def stack(df: DataFrame, names: Sequence[str], rows: Sequence[Sequence[str]]) -> DataFrame:
    """Turn each input row into one output row per entry of ``rows`` (SQL expressions)."""
    entries = [
        "named_struct(" + ", ".join(f"{literal(n)}, {e}" for n, e in zip(names, row)) + ")" for row in rows
    ]
    return df.selectExpr(f"inline(array({', '.join(entries)}))")


def text_map(values: Mapping[object, object]) -> str:
    """Map literal as SQL text; a sequence becomes an array."""

    def item(v: object) -> str:
        if isinstance(v, (list, tuple)):
            return "array(" + ", ".join(map(literal, v)) + ")"
        return literal(v)

    return "map(" + ", ".join(f"{literal(k)}, {item(v)}" for k, v in values.items()) + ")"


BLOCK = 32


def blocks(sorted_array: str) -> str:
    """A sorted array in parts of ``BLOCK`` values, for ``count_up_to``, as SQL text."""
    last = f"(size({sorted_array}) - 1) div {BLOCK}"
    parts = f"transform(sequence(0, CAST({last} AS INT)), i -> slice({sorted_array}, i * {BLOCK} + 1, {BLOCK}))"
    return f"CASE WHEN size({sorted_array}) > 0 THEN {parts} ELSE array(array(CAST('Infinity' AS DOUBLE))) END"


def count_up_to(x: str, in_blocks: str, strictly: bool = False) -> str:
    """How many values of a sorted array in blocks are ``<= x`` (or ``< x``), as SQL text.

    The block is found first, then the place in it, so that a thousand values take
    some sixty comparisons.
    """
    test = "<" if strictly else "<="
    block = f"size(filter({in_blocks}, part -> part[0] {test} {x}))"
    inside = f"size(filter(element_at({in_blocks}, greatest({block}, 1)), edge -> edge {test} {x}))"
    return f"(CASE WHEN {block} = 0 THEN 0 ELSE ({block} - 1) * {BLOCK} + {inside} END)"


def same_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names where null equals null; the keys of ``left`` stay."""
    renamed = right.select(*[F.col(k).alias(f"right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"right_{k}"))
    return left.join(renamed, condition, how).drop(*[f"right_{k}" for k in keys])
