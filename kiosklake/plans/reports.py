"""Report functions: balances, status bands, availability, stock balance, overdue, prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kiosklake.functions import periods
from kiosklake.functions.numbers import MONEY_SUM, half_even_int, ratio
from kiosklake.functions.pricing import daily_rate, price, replacement_cost
from kiosklake.operators.availability import IN_CIRCULATION, with_availability
from kiosklake.operators.geotree import count_within
from kiosklake.operators.membership import only
from kiosklake.plans.showcase import banded, with_share
from kiosklake.plans.views import disc_films
from kiosklake.session import materialize
from kiosklake.sources.tables import Tables

# Fixed value: metres within which a customer counts as near a store.
NEARBY_M = 25_000.0


def customer_balance(t: Tables, as_of, customer_id=None) -> DataFrame:
    """Per customer, or for one: payments on rentals begun by ``as_of``, less payments made by then."""
    at = periods.moment(as_of)
    customers = only(t.customer, "customer_id", customer_id).select("customer_id")
    rental = only(t.rental, "customer_id", customer_id)
    payment = only(t.payment, "customer_id", customer_id)
    bills = t.payment
    if customer_id is not None:
        # others may have paid for the customer's rentals
        bills = bills.join(rental.select("rental_id"), "rental_id", "left_semi")
    fees_by_rental = bills.groupBy("rental_id").agg(F.sum("amount").cast(MONEY_SUM).alias("fee"))
    fees = (
        rental.filter(F.col("period_start") <= at)
        .select("rental_id", "customer_id")
        .join(fees_by_rental, "rental_id")
        .groupBy("customer_id")
        .agg(F.sum("fee").cast(MONEY_SUM).alias("fees"))
    )
    paid = (
        payment.filter(F.col("payment_date") <= at)
        .groupBy("customer_id")
        .agg(F.sum("amount").cast(MONEY_SUM).alias("paid"))
    )
    zero = F.lit(0).cast(MONEY_SUM)
    return (
        customers.join(fees, "customer_id", "left")
        .join(paid, "customer_id", "left")
        .select(
            "customer_id",
            (F.coalesce("fees", zero) - F.coalesce("paid", zero)).cast(MONEY_SUM).alias("balance"),
        )
    )


# Activity bands as (days since the last rental, label), and the other two labels.
STATUS_BANDS = [(30, "Active (30d)"), (90, "Recent (30-90d)"), (180, "Dormant (90-180d)")]
INACTIVE = "Inactive"
AT_RISK = "At Risk (>180d)"


def status_band(active: Column, last_rental: Column, as_of) -> Column:
    recent = [(last_rental > periods.shift(as_of, days=-days), name) for days, name in STATUS_BANDS]
    return banded([(~active, INACTIVE), *recent], AT_RISK)


def customer_status_summary(
    t: Tables, as_of, count_each_rental_once: bool = False
) -> DataFrame:
    """Customers per activity band with average rentals and value.

    As in the joined original, a rental with two payments counts as two rentals
    unless ``count_each_rental_once`` is set.
    """
    paid = t.payment.groupBy("rental_id").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").cast(MONEY_SUM).alias("amount")
    )
    weight = F.lit(1) if count_each_rental_once else F.coalesce(F.col("payments"), F.lit(1))
    per_customer = (
        t.rental.select("rental_id", "customer_id", "period_start")
        .join(paid, "rental_id", "left")
        .groupBy("customer_id")
        .agg(
            F.sum(weight).alias("rentals"),
            F.sum("amount").cast(MONEY_SUM).alias("spent"),
            F.max("period_start").alias("last_rental"),
        )
    )
    bands = (
        t.customer.select("customer_id", "activebool")
        .join(per_customer, "customer_id", "left")
        .groupBy(status_band(F.col("activebool"), F.col("last_rental"), as_of).alias("status"))
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.coalesce(F.sum("rentals"), F.lit(0)).alias("rentals"),
            F.coalesce(F.sum("spent").cast(MONEY_SUM), F.lit(0).cast(MONEY_SUM)).alias("spent"),
        )
    )
    shares = with_share(bands, "customer_count", 2, "pct_of_total")
    return shares.select(
        "status",
        "customer_count",
        "pct_of_total",
        ratio(F.col("rentals"), F.col("customer_count"), 1).alias("avg_lifetime_rentals"),
        ratio(F.col("spent"), F.col("customer_count"), 2).alias("avg_lifetime_value"),
    ).orderBy(F.col("customer_count").desc(), "status")


def film_availability(t: Tables, min_stores: int = 0) -> DataFrame:
    """Per film: stores holding it, copies, and copies free to rent."""
    discs = with_availability(
        t.inventory.select("inventory_id", "film_id", "store_id", "status_id"), t
    )
    per_store = discs.groupBy("film_id", "store_id").agg(
        F.count(F.lit(1)).alias("copies"), F.count_if("is_available").alias("free")
    )
    stats = per_store.groupBy("film_id").agg(
        F.count(F.lit(1)).alias("stores_with_film"),
        F.sum("copies").alias("total_copies"),
        F.sum("free").alias("copies_available"),
    )
    zero = F.lit(0)
    return (
        t.film.select("film_id", "title", "release_date", "popularity")
        .join(stats, "film_id", "left")
        .select(
            "film_id", "title", "release_date", "popularity",
            *[F.coalesce(c, zero).alias(c) for c in ("stores_with_film", "total_copies", "copies_available")],
        )
        .filter(F.col("stores_with_film") >= min_stores)
        .orderBy(F.col("popularity").desc_nulls_first(), "film_id")
    )


def nearby_customer_counts(t: Tables, radius_m: float = NEARBY_M, customers: DataFrame | None = None) -> DataFrame:
    """``(store_id, nearby_customers)`` for every store."""
    return count_within(
        t.store.select("store_id", "lat", "lng"),
        t.customer if customers is None else customers,
        radius_m,
        site_key="store_id",
        site_at=("lat", "lng"),
        point_at=("lat", "lng"),
        name="nearby_customers",
    )


def proportional_share(total: Column, part: Column, whole: Column) -> Column:
    """``round(total * part / whole)``, half away from zero; NULL when ``whole`` is 0."""
    return ratio(total * part, whole, 0).cast("bigint")


def store_targets(t: Tables, radius_m: float = NEARBY_M) -> DataFrame:
    """Stock target per store: 40 % of the mean for all, the rest by nearby customers."""
    near = materialize(nearby_customer_counts(t, radius_m), "nearby")  # summed and joined
    stocked = t.inventory.filter(F.col("status_id") == IN_CIRCULATION)
    total = stocked.agg(F.count(F.lit(1)).alias("n")).scalar()
    stores = t.store.agg(F.count(F.lit(1)).alias("n")).scalar()
    customers = near.agg(F.sum("nearby_customers").alias("n")).scalar()
    mean = F.expr("_total div _stores")
    floor_part = F.round(F.col("_mean").cast("decimal(20,0)") * F.lit("0.4").cast("decimal(2,1)"), 0)
    share = (
        F.col("nearby_customers").cast("double")
        / F.nullif(F.col("_customers").cast("double"), F.lit(0.0))
        * F.col("_rest").cast("double")
    )
    held = stocked.groupBy("store_id").agg(F.count(F.lit(1)).alias("held"))
    return (
        near.join(held, "store_id", "left")
        .withColumns({"_total": total, "_stores": stores, "_customers": customers})
        .withColumn("_mean", mean)
        .withColumn("_floor", floor_part.cast("bigint"))
        .withColumn("_rest", F.col("_total") - F.col("_floor") * F.col("_stores"))
        .select(
            "store_id",
            "nearby_customers",
            F.coalesce("held", F.lit(0)).alias("current_inventory"),
            (F.col("_floor") + half_even_int(share)).alias("target_inventory"),
        )
    )


def inventory_balance(t: Tables, radius_m: float = NEARBY_M) -> DataFrame:
    """Stock against target per store; the percentage is NULL for a target of 0."""
    gap = F.col("current_inventory") - F.col("target_inventory")
    return (
        store_targets(t, radius_m)
        .withColumn("variance", gap)
        .withColumn("variance_pct", ratio(F.col("variance") * 100, F.col("target_inventory"), 1))
        .orderBy(F.col("variance").desc_nulls_first(), "store_id")
    )


def inventory_status_summary(t: Tables) -> DataFrame:
    """Discs per status with their share, in display order."""
    held = t.inventory.groupBy("status_id").agg(F.count(F.lit(1)).alias("n"))
    counted = t.inventory_status.join(held, "status_id", "left").select(
        "status_code", "description", "display_order",
        F.coalesce("n", F.lit(0)).alias("inventory_count"),
    )
    shares = with_share(counted, "inventory_count", 2, "pct_of_total")
    return shares.orderBy("display_order").drop("display_order")


def overdue_in_circulation(t: Tables, as_of, overdue_days: int = 7) -> DataFrame:
    """Open rentals past a number of days whose disc is in circulation, with its replacement cost."""
    now = periods.moment(as_of)
    late = t.still_open("rental").filter(
        F.col("period_start") < periods.shift(as_of, days=-overdue_days)
    ).select("rental_id", "period_start", "customer_id", "inventory_id")
    discs = t.inventory.filter(F.col("status_id") == IN_CIRCULATION).select("inventory_id", "film_id")
    return (
        late.join(discs, "inventory_id")
        .join(t.film.select("film_id", "title", "release_date"), "film_id")
        .join(t.customer.select("customer_id", "full_name"), "customer_id")
        .select(
            "rental_id",
            "customer_id",
            F.col("full_name").alias("customer_name"),
            F.col("title").alias("film_title"),
            F.col("period_start").alias("rental_start"),
            periods.whole_days(F.col("period_start"), now).alias("days_overdue"),
            replacement_cost(t.pricing, F.col("release_date"), as_of).alias("replacement_cost"),
        )
        .orderBy("rental_start", "rental_id")
    )


def film_prices(t: Tables, as_of, film_id=None) -> DataFrame:
    """Daily rate and replacement cost of every film, or of one."""
    return only(t.film, "film_id", film_id).select(
        "film_id",
        daily_rate(t.pricing).alias("daily_rate"),
        replacement_cost(t.pricing, F.col("release_date"), as_of).alias("replacement_cost"),
    )


def disc_prices(t: Tables, as_of, inventory_id=None) -> DataFrame:
    """Replacement cost by disc, of all or of one."""
    return only(disc_films(t), "inventory_id", inventory_id).join(film_prices(t, as_of), "film_id").select("inventory_id", "replacement_cost")


def price_of(t: Tables, key: str) -> DataFrame:
    """One price as a one-row frame (NULL for an unknown key)."""
    return t.pricing.agg(F.first(price(t.pricing, key)).alias("pricing_value"))
