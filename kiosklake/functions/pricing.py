"""Rental fees and replacement costs from the pricing table.

The pricing table has one row per price key, so each lookup is an uncorrelated
scalar subquery rather than a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kiosklake.functions import periods

# Price keys.
DAILY_RATE = "daily_rental_rate"
COST_NEW = "replacement_cost_new"
COST_RECENT = "replacement_cost_recent"
COST_CATALOG = "replacement_cost_catalog"
COST_CLASSIC = "replacement_cost_classic"
# Fixed value: charged when a replacement cost is unknown.
FALLBACK_COST = "19.99"


def price(pricing: DataFrame, key: str) -> Column:
    """Value of one price key; NULL for an unknown key."""
    rows = pricing.filter(F.col("pricing_key") == key)
    return rows.agg(F.max("pricing_value").alias("pricing_value")).scalar()


def daily_rate(pricing: DataFrame) -> Column:
    """The one daily rate; it does not depend on the film."""
    return price(pricing, DAILY_RATE)


def rental_fee(start: Column, end: Column, rate: Column) -> Column:
    return (periods.rental_days(start, end).cast("decimal(10,0)") * rate).cast("decimal(12,2)")


# Film ages in years below which a price key applies.
COST_BY_AGE = [(1, COST_NEW), (3, COST_RECENT), (10, COST_CATALOG)]


def replacement_cost(pricing: DataFrame, release_date: Column, as_of) -> Column:
    """Cost by film age; older and undated films cost the classic price."""
    cost = None
    for years, key in COST_BY_AGE:
        younger = release_date > periods.shift(as_of, years=-years).cast("date")
        value = price(pricing, key)
        cost = F.when(younger, value) if cost is None else cost.when(younger, value)
    return cost.otherwise(price(pricing, COST_CLASSIC)).cast("decimal(12,2)")
