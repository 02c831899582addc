"""Reference rows every installation starts with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiosklake.sources.schemas import SCHEMAS

# Disc statuses.
STATUSES = [
    (1, "in_circulation", "Available for rental", 1),
    (2, "lost", "Never returned, customer charged replacement cost", 2),
    (3, "damaged", "Returned damaged, removed from circulation", 3),
    (4, "retired", "Intentionally removed from inventory", 4),
]

# Price list.
PRICES = [
    ("daily_rental_rate", "1.99", "Standard per-day rental charge", "2026-02-03"),
    ("replacement_cost_catalog", "14.99", "Replacement cost for films 3-10 years old", "2026-02-03"),
    ("replacement_cost_classic", "9.99", "Replacement cost for films 10+ years old", "2026-02-03"),
    ("replacement_cost_new", "24.99", "Replacement cost for films < 1 year old", "2026-02-03"),
    ("replacement_cost_recent", "19.99", "Replacement cost for films 1-3 years old", "2026-02-03"),
]


def _values(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    fields = SCHEMAS[name].fields
    quoted = ", ".join(
        "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in row) + ")" for row in rows
    )
    columns = ", ".join(f.name for f in fields)
    casts = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {quoted} AS v({columns})")


def inventory_status(spark: SparkSession) -> DataFrame:
    return _values(spark, "inventory_status", STATUSES)


def pricing(spark: SparkSession) -> DataFrame:
    return _values(spark, "pricing", PRICES)
