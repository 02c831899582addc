"""Customer-facing queries. Without an id they answer for every customer at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kiosklake.functions import periods
from kiosklake.functions.numbers import MONEY_SUM, draw, money, ratio
from kiosklake.operators.availability import available_discs
from kiosklake.operators.geotree import pick_within
from kiosklake.operators.membership import only
from kiosklake.operators.ranking import top_per
from kiosklake.plans.reports import NEARBY_M
from kiosklake.plans.views import customer_rentals, disc_films, with_partners
from kiosklake.sources.tables import Tables


def rented_since(t: Tables, since) -> DataFrame:
    return t.within("rental", since).filter(F.col("period_start") >= since)


def payments_per_rental(payment: DataFrame) -> DataFrame:
    return payment.groupBy("rental_id").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").cast(MONEY_SUM).alias("paid")
    )


def above_average_renters(t: Tables, as_of, days: int, store_id=None) -> DataFrame:
    """Customers who rented more in the window than the mean renter of their home store."""
    counts = (
        rented_since(t, periods.shift(as_of, days=-days))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("rental_count"))
    )
    renters = only(t.customer, "store_id", store_id).select(
        "customer_id", "full_name", "store_id"
    ).join(counts, "customer_id")
    # compare count * renters > total instead of dividing
    per_store = renters.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("_renters"), F.sum("rental_count").alias("_total")
    )
    return (
        renters.join(per_store, "store_id")
        .filter(F.col("rental_count") * F.col("_renters") > F.col("_total"))
        .select("store_id", "customer_id", "full_name", "rental_count")
        .orderBy("store_id", F.col("rental_count").desc(), "customer_id")
    )


def customers_at_a_glance(t: Tables, as_of, days: int, customer_ids=None) -> DataFrame:
    """Rentals, open rentals and spending in the window; customers without any stay in."""
    since = periods.shift(as_of, days=-days)
    paid = payments_per_rental(t.within("payment", since).filter(F.col("payment_date") >= since))
    weight = F.coalesce(F.col("payments"), F.lit(1))
    recent = (
        only(rented_since(t, since), "customer_id", customer_ids)
        .select("rental_id", "customer_id", "period_end")
        .join(paid, "rental_id", "left")
        .groupBy("customer_id")
        .agg(
            F.sum(weight).alias("total_rentals"),
            F.sum(F.when(periods.is_open(F.col("period_end")), weight).otherwise(0)).alias("open_rentals"),
            money(F.sum("paid")).alias("total_spent"),
        )
    )
    zero = F.lit(0)
    return (
        only(t.customer, "customer_id", customer_ids)
        .select("customer_id", "full_name")
        .join(recent, "customer_id", "left")
        .select(
            "customer_id", "full_name",
            F.coalesce("total_rentals", zero).alias("total_rentals"),
            F.coalesce("open_rentals", zero).alias("open_rentals"),
            "total_spent",
        )
        .orderBy(F.col("total_rentals").desc(), "customer_id")
    )


def _newest_first(*tail: str) -> list:
    return [F.col("rental_date").desc(), F.col("rental_id").desc(), *[F.col(c).desc_nulls_first() for c in tail]]


def _newest_rentals(t: Tables, rental: DataFrame, by: list[str], k: int) -> Tables:
    """The tables with each group's newest ``k`` rentals alone: the newest ``k`` rows come from these."""
    shown = with_partners(t, rental).select(*t.rental.columns)
    order = [F.col("period_start").desc(), F.col("rental_id").desc()]
    return t.replaced(rental=top_per(shown, by, order, k))


def account_history(t: Tables, as_of, days: int, customer_id=None, k: int = 20) -> DataFrame:
    """Newest ``k`` rentals of a customer within the window."""
    recent = rented_since(t, periods.shift(as_of, days=-days))
    recent = only(recent, "customer_id", customer_id)
    rows = customer_rentals(_newest_rentals(t, recent, ["customer_id"], k))
    newest = top_per(rows, ["customer_id"], _newest_first("payment_date", "amount"), k)
    return newest.select(
        "customer_id", "film_title", "rental_date", "return_date", "amount", "rental_store_id", "rating"
    )


def account_spending(t: Tables, customer_id=None) -> DataFrame:
    """Lifetime totals of a customer; zeros for one who never rented."""
    per_rental = payments_per_rental(t.payment)
    spent = (
        only(t.rental, "customer_id", customer_id)
        .select("rental_id", "customer_id", "period_start")
        .join(per_rental, "rental_id", "left")
        .groupBy("customer_id")
        .agg(
            F.sum(F.coalesce("payments", F.lit(1))).alias("total_rentals"),
            F.sum("payments").alias("_payments"),
            F.sum("paid").cast(MONEY_SUM).alias("_paid"),
            F.min("period_start").alias("first_rental"),
            F.max("period_start").alias("last_rental"),
        )
    )
    zero = F.lit(0).cast(MONEY_SUM)
    return (
        only(t.customer, "customer_id", customer_id)
        .select("customer_id")
        .join(spent, "customer_id", "left")
        .select(
            "customer_id",
            F.coalesce("total_rentals", F.lit(0)).alias("total_rentals"),
            F.coalesce("_paid", zero).alias("total_spent"),
            F.coalesce(ratio(F.col("_paid"), F.col("_payments"), 6), zero).alias("avg_payment"),
            "first_rental",
            "last_rental",
        )
    )


def account_store_history(t: Tables, customer_id=None, store_id=None, k: int = 20) -> DataFrame:
    """Newest ``k`` rentals of a customer at one renting store.

    Few customers have more than ``k`` at one store, so rentals are not cut down before they are joined.
    """
    rental = only(only(t.rental, "customer_id", customer_id), "store_id", store_id)
    rows = customer_rentals(t.replaced(rental=rental))
    keys = ["customer_id", "rental_store_id"]
    newest = top_per(rows, keys, _newest_first("payment_date", "amount"), k)
    return newest.select(*keys, "film_title", "rental_date", "return_date", "amount")


def recent_rentals(t: Tables, as_of, days: int, customer_id=None, k: int = 20) -> DataFrame:
    """Newest ``k`` rentals of a customer within the window, with what was paid.

    Rentals are cut to those that can be among the ``k`` rows before any join.
    """
    rows = only(rented_since(t, periods.shift(as_of, days=-days)), "customer_id", customer_id).select(
        "rental_id", "customer_id", "inventory_id",
        F.col("period_start").alias("rented_at"), F.col("period_end").alias("returned_at"),
    )
    order = [F.col("rented_at").desc(), F.col("rental_id").desc()]
    newest = top_per(rows, ["customer_id"], order, k)
    paid = t.payment.select("rental_id", "payment_id", "amount")
    listed = (
        newest.join(disc_films(t), "inventory_id")
        .join(t.film.select("film_id", "title"), "film_id")
        .join(paid, "rental_id", "left")
    )
    last = top_per(listed, ["customer_id"], [*order, F.col("payment_id").desc_nulls_first()], k)
    return last.select("customer_id", "rental_id", "title", "rented_at", "returned_at", "amount")


def disc_offers(t: Tables, customer_id=None, seed: str = "offer", radius_m: float = NEARBY_M) -> DataFrame:
    """For each customer with nothing out, one seeded random available disc near them.

    Discs stand at their stores and are drawn down a tree of counted cells, so customers are
    listed neither with the discs nor with the stores in their reach.
    """
    open_now = t.still_open("rental").select("customer_id").distinct()
    free = only(t.customer, "customer_id", customer_id).select(
        "customer_id", F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng")
    ).join(open_now, "customer_id", "left_anti")
    discs = available_discs(t).select("inventory_id", "store_id").join(
        t.store.select("store_id", F.col("lat").alias("s_lat"), F.col("lng").alias("s_lng")), "store_id"
    )
    return pick_within(
        free, discs, radius_m, row_at=("c_lat", "c_lng"), item_at=("s_lat", "s_lng"),
        item_keys=["store_id", "inventory_id"], draw=draw(seed, F.col("customer_id")),
    ).select("customer_id", "inventory_id", "store_id")
