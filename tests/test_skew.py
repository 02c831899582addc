"""One key holds a third of all rows: results stay exact and no plan compares all with all."""

import pytest
from pyspark.sql import functions as F

from kiosklake.plans import jobs, showcase, stock, stores, trends, views
from kiosklake.sources.tables import Tables
from tests.conftest import AS_OF


@pytest.fixture(scope="module")
def skewed(spark, tables):
    """6000 rentals, a third of them of one disc, one customer and one store."""
    n = 6000
    hot = F.col("id") % 3 == 0
    key = lambda base, spread: F.when(hot, F.lit(base)).otherwise(F.lit(base) + F.col("id") % spread + 1).cast("bigint")
    start = F.lit("2025-05-20").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") % 600).cast("int"))
    rental = spark.range(n).select(
        F.col("id").alias("rental_id"), start.alias("period_start"),
        (start + F.make_dt_interval(hours=F.lit(5))).alias("period_end"),
        key(1000, 200).alias("inventory_id"), key(0, 90).alias("customer_id"), key(0, 7).alias("store_id"),
        start.alias("last_update"),
    )
    inventory = spark.range(201).select(
        (F.col("id") + 1000).alias("inventory_id"), (F.col("id") % 4 + 1).alias("film_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).cast("bigint").alias("store_id"),
        F.lit(1).alias("status_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("circulation_start"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("last_update"),
    )
    customer = spark.range(91).select(
        F.col("id").alias("customer_id"), (F.col("id") % 7).alias("store_id"),
        F.concat(F.lit("C"), F.col("id")).alias("full_name"), F.lit("e").alias("email"), F.lit("p").alias("phone"),
        F.lit(10).alias("zip_code"), F.lit(True).alias("activebool"),
        F.lit("2024-01-01").cast("date").alias("create_date"),
        (40.7 + F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id") / 1000)).alias("lat"),
        F.lit(-74.0).alias("lng"), F.lit("2024-01-01").cast("timestamp_ntz").alias("last_update"),
    )
    store = spark.range(8).select(
        F.col("id").alias("store_id"), F.lit("s").alias("street_name"), F.lit("r").alias("road_ref"),
        F.lit("p").alias("phone"), F.lit(10).alias("zip_code"),
        (40.7 + F.col("id") / 50).alias("lat"), F.lit(-74.0).alias("lng"),
    )
    return tables.replaced(
        rental=rental, inventory=inventory, customer=customer, store=store, payment=tables.payment.limit(0)
    )


def test_reports_keep_every_row(skewed):
    assert sum(r.rentals for r in showcase.day_of_week(skewed).collect()) == 6000
    assert sum(r.rentals for r in showcase.travel_distances(skewed).collect()) == 6000
    worn = stores.worn_discs(skewed, min_rentals=15, batch=10).collect()
    assert max(r.rental_count for r in worn) == 2000
    fast = [tuple(r) for r in trends.actor_report(skewed, AS_OF).collect()]
    slow = [tuple(r) for r in trends.actor_report_unreduced(skewed, AS_OF).collect()]
    assert fast == slow and fast


def test_billing_everything_once(skewed):
    added = jobs.insert_payments(skewed).rows["payments"]
    got = added.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("rental_id").alias("r"), F.max("payment_id").alias("top"),
        F.countDistinct("payment_id").alias("p"),
    ).first()
    assert (got.n, got.r, got.p, got.top) == (6000, 6000, 6000, 6000)


def test_pairing_and_moves_stay_exact(skewed):
    got = stock.pair_rentals(skewed, "2025-07-01", 60).collect()
    assert len({r.customer_id for r in got}) == len(got) == len({r.inventory_id for r in got}) > 0
    moves = stock.rebalance_moves(skewed).collect()
    assert len({r.inventory_id for r in moves}) == len(moves)


def test_no_plan_compares_all_with_all(skewed):
    frames = [
        views.customer_rentals(skewed), views.revenue_summary(skewed), trends.genre_popularity(skewed, AS_OF, 30),
        stock.store_pool(skewed), stock.allocation(skewed, AS_OF), stores.performance(skewed, AS_OF, 30),
        jobs.insert_payments(skewed).rows["payments"],
    ]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
