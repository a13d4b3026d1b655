"""Column roles, missing flags, domain validation and the decision predicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.config import CreditConfig, DomainRule
from scoreloom.functions.columns import literal, name, number


def drop_identifier(df: DataFrame, config: CreditConfig) -> DataFrame:
    """Table without the identifier, which never is a feature."""
    return df.drop(config.id_column)


def features_and_label(df: DataFrame, config: CreditConfig) -> DataFrame:
    """Features plus the target as ``label``, kept in one row under the key."""
    features = [c for c in df.columns if c not in (config.id_column, config.target)]
    return df.select(config.id_column, *features, F.col(config.target).alias("label"))


def column_roles(columns: Sequence[str], config: CreditConfig) -> tuple[list[str], list[str]]:
    """``(numeric, binary)`` feature columns of an encoded table."""
    features = [c for c in columns if c not in (config.id_column, config.target)]
    binary = [
        c
        for c in features
        if c in config.binary_columns or c.startswith(f"{config.category_column}_")
    ]
    return [c for c in features if c not in binary and c != "split"], binary


def class_values(df: DataFrame, column: str, target: str, value: int) -> DataFrame:
    """Known values of a column inside one target class."""
    of_class = df.where(F.col(target) == value).select(number(column).alias(column))
    return of_class.where(F.col(column).isNotNull())


def missing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add a 0/1 ``<column>_missing`` flag per column."""
    return df.withColumns({f"{c}_missing": number_missing(df, c).cast("int") for c in columns})


def number_missing(df: DataFrame, column: str) -> Column:
    """Whether a value is missing; NaN counts as missing in floating-point columns."""
    dtype = df.schema[column].dataType
    return F.expr(_missing(column, dtype))


def _missing(column: str, dtype: T.DataType) -> str:
    is_null = f"{name(column)} IS NULL"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"({is_null} OR isnan({name(column)}))"
    return f"({is_null})"


def _violations(rule: DomainRule, dtype: T.DataType, allow_null: bool) -> list[str]:
    column, missing = name(rule.column), _missing(rule.column, dtype)

    def reason(condition: str, kind: str) -> str:
        return f"CASE WHEN {condition} THEN {literal(f'{rule.column}:{kind}')} END"

    found = [] if allow_null else [reason(missing, "missing")]
    if rule.allowed:
        return [*found, reason(f"{column} NOT IN ({', '.join(map(literal, rule.allowed))})", "category")]
    number_text = column
    if isinstance(dtype, T.StringType):
        number_text = f"try_cast({column} AS DOUBLE)"
    wrong = [f"{column} IS NOT NULL AND {number_text} IS NULL"] if number_text != column else []
    if rule.integer and not isinstance(dtype, T.IntegralType):
        wrong.append(f"NOT {missing} AND {number_text} <> floor({number_text})")
    if wrong:
        found.append(reason(" OR ".join(f"({w})" for w in wrong), "type"))
    outside = f"{number_text} < {literal(rule.low)} OR {number_text} > {literal(rule.high)}"
    return [*found, reason(f"NOT {missing} AND ({outside})", "range")]


def validate(df: DataFrame, config: CreditConfig, allow_null: bool = False) -> DataFrame:
    """Add ``errors ARRAY<STRING>``: every reason for which a row is refused, in rule order.

    A required column that the table does not have is missing in every row; rules
    of other absent columns are skipped. ``allow_null`` admits missing values, as
    batch tables may have them imputed later, but not missing columns.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    reasons = [
        v
        for rule in config.rules
        for v in (
            _violations(rule, types[rule.column], allow_null)
            if rule.column in types
            else [literal(f"{rule.column}:missing")] * rule.required
        )
    ]
    listed = f"array_compact(array({', '.join(reasons)}))" if reasons else "CAST(array() AS ARRAY<STRING>)"
    return df.withColumn("errors", F.expr(listed))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)`` rows of a validated table; quarantine keeps its reasons."""
    refused = F.size("errors") > 0
    return validated.where(~refused).drop("errors"), validated.where(refused)


def decide(probability: Column, threshold: float, strict: bool = False) -> Column:
    """0/1 decision: ``p >= t`` at a chosen threshold, ``p > t`` with ``strict``."""
    hit = probability > F.lit(threshold) if strict else probability >= F.lit(threshold)
    return hit.cast("int")
