"""Bill rentals as they are closed: a file stream with an idempotent batch sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from kiosklake.functions.periods import month_text
from kiosklake.plans.jobs import due_payments
from kiosklake.sources.schemas import SCHEMAS
from kiosklake.sources.tables import Tables

_TOP = T.StructType([T.StructField("batch", T.LongType()), T.StructField("top", T.LongType())])
_SINK = T.StructType([*SCHEMAS["payment"].fields, T.StructField("batch", T.LongType()), T.StructField("month", T.StringType())])


def billed(spark, sink: str) -> DataFrame:
    """Payments written so far, with the batch that wrote them and the month they are dated in."""
    return spark.read.schema(_SINK).parquet(f"{sink}/paid")


def bill_closed_rentals(closed: DataFrame, t: Tables, sink: str, checkpoint: str, lateness: str = "2 days"):
    """Start billing a stream of rentals into ``sink`` (parquet, one folder per batch and month).

    A rental that comes again within ``lateness`` of its end is dropped by the stream's own
    state, which the watermark bounds. One that comes again later is found in the ledger: a bill
    is dated by the end of its rental, so a batch looks only into the months its rentals end in,
    and into given payments no older than its oldest rental. Ids go on from the largest one,
    which every batch notes, so no batch reads the ids of all payments. A batch that is replayed
    sees what earlier batches wrote and overwrites its own folders: a restart neither bills
    twice nor loses a bill.
    """
    spark = closed.sparkSession
    # empty first folders, so that the ledger can be read before any batch
    spark.createDataFrame([], _SINK).write.mode("ignore").partitionBy("batch", "month").parquet(f"{sink}/paid")
    spark.createDataFrame([], _TOP).write.mode("ignore").parquet(f"{sink}/tops/batch=-1")
    ended = F.col("period_end").cast("timestamp")
    once = closed.withColumn("_ended", ended).withWatermark("_ended", lateness).dropDuplicatesWithinWatermark(["rental_id"])

    def bill(batch: DataFrame, number: int) -> None:
        rentals = batch.drop("_ended").dropDuplicates(["rental_id"]).persist()  # looked at twice, then billed
        months = [r["month"] for r in rentals.select(month_text(F.col("period_end")).alias("month")).distinct().collect()]
        oldest = rentals.agg(F.min("period_start")).first()[0]
        if oldest is not None:
            earlier = billed(spark, sink).filter((F.col("batch") < number) & F.col("month").isin(months))
            given = t.within("payment", oldest).filter(F.col("payment_date") >= F.lit(oldest).cast("timestamp_ntz"))
            known = earlier.select("rental_id").unionByName(given.select("rental_id"))
            noted = spark.read.schema(_TOP).parquet(f"{sink}/tops").filter(F.col("batch") < number)
            top = noted.agg(F.max("top")).first()[0]
            if top is None:
                top = t.payment.agg(F.coalesce(F.max("payment_id"), F.lit(0))).first()[0]
            bills = due_payments(t, rentals, known=known, top=top)
            at = f"{sink}/paid/batch={number}"
            bills.withColumn("month", month_text(F.col("payment_date"))).write.mode("overwrite").partitionBy("month").parquet(at)
            made = spark.read.schema(SCHEMAS["payment"]).parquet(at).agg(F.coalesce(F.max("payment_id"), F.lit(top)).alias("top"))
            made.select(F.col("top").cast("bigint").alias("top")).write.mode("overwrite").parquet(f"{sink}/tops/batch={number}")
        rentals.unpersist()

    return (
        once.writeStream.foreachBatch(bill)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
