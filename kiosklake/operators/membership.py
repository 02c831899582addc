"""Joins on array membership and on text, and NULL-aware exclusion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def members(df: DataFrame, array: str, name: str) -> DataFrame:
    """One row per distinct element (``x = ANY(array)`` matches an element once)."""
    return df.withColumn(name, F.explode(F.array_distinct(array))).drop(array)


def rows_in(df: DataFrame, column: str, values) -> DataFrame:
    """``column IN (...)``: a literal list becomes a pushed-down filter, a frame a semi-join."""
    if isinstance(values, DataFrame):
        wanted = values.select(F.col(values.columns[0]).alias(column)).distinct()
        return df.join(wanted, column, "left_semi")
    return df.filter(F.col(column).isin(list(values)))


def only(df: DataFrame, column: str, wanted) -> DataFrame:
    """Restrict a report to one key, a list or a frame of keys; ``None`` keeps every key."""
    if wanted is None:
        return df
    if isinstance(wanted, (DataFrame, list, tuple, set)):
        return rows_in(df, column, wanted)
    return df.filter(F.col(column) == wanted)


def not_in(df: DataFrame, column: str, other: DataFrame) -> DataFrame:
    """``column NOT IN (SELECT ...)`` with SQL's NULL rules, as a shuffled anti-join.

    Any NULL on the other side empties the result, and a NULL key only survives
    when the other side is empty.
    """
    key = F.col(other.columns[0])
    rows = other.agg(F.count(F.lit(1)).alias("n")).scalar()
    filled = other.agg(F.count(key).alias("n")).scalar()
    kept = df.join(other.select(key.alias(column)).distinct(), column, "left_anti")
    return kept.filter((rows == 0) | (F.col(column).isNotNull() & (rows == filled)))
