"""Alert on rentals that stay open: an outer stream-stream join with watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lost_alerts(
    rented: DataFrame, returned: DataFrame, lost_after_days: int = 30, lateness: str = "1 day"
) -> DataFrame:
    """Rentals without a return within ``lost_after_days``.

    ``rented`` has rental_id, customer_id, inventory_id, rented_at; ``returned`` has
    rental_id, returned_at (both event times are TIMESTAMP). State for a rental is
    dropped when it is returned or when the watermark passes its limit, at which
    point the alert comes out; a later return changes nothing.
    """
    left = rented.withWatermark("rented_at", lateness)
    right = returned.select(
        F.col("rental_id").alias("returned_id"), "returned_at"
    ).withWatermark("returned_at", lateness)
    matched = (
        (F.col("rental_id") == F.col("returned_id"))
        & (F.col("returned_at") >= F.col("rented_at"))
        & (F.col("returned_at") <= F.expr(f"rented_at + INTERVAL {int(lost_after_days)} DAYS"))
    )
    return (
        left.join(right, matched, "left_outer")
        .filter(F.col("returned_id").isNull())
        .select("rental_id", "customer_id", "inventory_id", "rented_at")
    )


def write_alerts(alerts: DataFrame, sink: str, checkpoint: str):
    """Append alerts to parquet, handling everything available and then stopping."""
    return (
        alerts.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
