"""Key, reference and domain checks over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Film ratings in their declared order.
RATINGS = ("G", "PG", "PG-13", "R", "NC-17", "NR")
# Bounds of the year domain.
YEAR_MIN, YEAR_MAX = 1901, 2155


def rating_rank(rating: Column) -> Column:
    """Position of a rating in the declared order; NULL for anything else."""
    place = F.array_position(F.array(*[F.lit(r) for r in RATINGS]), rating)
    return F.nullif(place, F.lit(0))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row."""
    known = parent.select(F.col(parent_key).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def outside(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Rows whose non-NULL value is not one of a fixed set."""
    return df.filter(~F.col(column).isin(*allowed))


def outside_years(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~F.col(column).between(YEAR_MIN, YEAR_MAX))


def report(checks: dict[str, DataFrame]) -> DataFrame:
    """``(check_name, violations)``, one row per check."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        for name, df in checks.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
