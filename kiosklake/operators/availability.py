"""Which discs are out, and which can be rented."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kiosklake.sources.tables import Tables

# Fixed value: status id of a disc in circulation.
IN_CIRCULATION = 1


def discs_out(t: Tables) -> DataFrame:
    """Distinct discs with an open rental."""
    return t.still_open("rental").select("inventory_id").distinct()


def with_availability(inventory: DataFrame, t: Tables) -> DataFrame:
    """Inventory plus boolean ``is_out`` and ``is_available``.

    Open rentals are reduced to one row per disc first, so the join has unique
    keys on both sides however often a disc was rented.
    """
    out = discs_out(t).withColumn("_out", F.lit(True))
    is_out = F.coalesce(F.col("_out"), F.lit(False))
    return (
        inventory.join(out, "inventory_id", "left")
        .withColumn("is_out", is_out)
        .withColumn("is_available", (F.col("status_id") == IN_CIRCULATION) & ~F.col("is_out"))
        .drop("_out")
    )


def available_discs(t: Tables) -> DataFrame:
    """In-circulation discs without an open rental."""
    on_hand = t.inventory.filter(F.col("status_id") == IN_CIRCULATION)
    return on_hand.join(discs_out(t), "inventory_id", "left_anti")
