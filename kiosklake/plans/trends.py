"""Windowed and monthly business reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kiosklake.functions import periods
from kiosklake.functions.numbers import MONEY_SUM
from kiosklake.operators.membership import only
from kiosklake.operators.ranking import top_per
from kiosklake.plans import showcase
from kiosklake.plans.customers import rented_since
from kiosklake.plans.views import disc_films, revenue_summary
from kiosklake.sources.tables import Tables


def busy_lately(t: Tables, as_of, days: int) -> DataFrame:
    """Rentals whose period touches the last ``days`` days."""
    return t.touching("rental", periods.shift(as_of, days=-days), as_of)


def genre_popularity(t: Tables, as_of, days: int, k: int = 10) -> DataFrame:
    return showcase.genre_rentals(t, busy_lately(t, as_of, days), k)


def weekday_trend(t: Tables, as_of, days: int) -> DataFrame:
    return showcase.day_of_week(t, busy_lately(t, as_of, days))


def monthly_revenue(t: Tables, as_of, months: int = 12) -> DataFrame:
    return showcase.monthly_trend(t, months, since=periods.shift(as_of, months=-months))


def _begun_after(t: Tables, as_of, days: int) -> DataFrame:
    since = periods.shift(as_of, days=-days)
    return t.within("rental", since).filter(F.col("period_start") > since)


def actor_report(t: Tables, as_of, days: int = 30) -> DataFrame:
    return showcase.top_actors(t, _begun_after(t, as_of, days))


def actor_report_unreduced(t: Tables, as_of, days: int = 30) -> DataFrame:
    return showcase.top_actors_unreduced(t, _begun_after(t, as_of, days))


def payment_detail(t: Tables, as_of, days: int) -> DataFrame:
    """Export of payments on rentals begun in the window, fully sorted.

    The sort is range-partitioned on all its keys, which end in unique ids, so one
    customer with very many payments still spreads over tasks.
    """
    rentals = rented_since(t, periods.shift(as_of, days=-days)).select(
        "rental_id", "customer_id", "inventory_id", "store_id"
    )
    return (
        rentals.join(t.payment.select("rental_id", "payment_id", "amount", "payment_date"), "rental_id")
        .join(t.customer.select("customer_id", "full_name", "email"), "customer_id")
        .join(disc_films(t), "inventory_id")
        .join(t.film.select("film_id", "title", "overview"), "film_id")
        .orderBy("full_name", F.col("amount").desc(), "payment_date", "payment_id")
        .select("full_name", "email", "title", "overview", "amount", "payment_date", "store_id")
    )


def store_revenue_trend(t: Tables, store_id=None, k: int = 12) -> DataFrame:
    """A store's newest months."""
    rows = revenue_summary(t.replaced(rental=only(t.rental, "store_id", store_id)))
    newest = top_per(rows, ["store_id"], [F.col("revenue_month").desc()], k)
    return newest.select(
        "store_id", "revenue_month", "total_revenue", "payment_count", "avg_payment", "unique_customers"
    )


def top_stores(t: Tables, as_of, months_ago: int, k: int = 20) -> DataFrame:
    """Best stores of one past month. The month filters the payment scan itself."""
    month = periods.month_start(periods.shift(as_of, months=-months_ago))
    after = periods.month_start(periods.shift(as_of, months=1 - months_ago))
    paid = t.within("payment", month, after).filter(
        (F.col("payment_date") >= month) & (F.col("payment_date") < after)
    )
    rows = revenue_summary(t.replaced(payment=paid))
    return top_per(rows, [], [F.col("total_revenue").desc(), F.col("store_id")], k).select(
        "store_id", "street_name", "total_revenue", "payment_count", "unique_customers"
    )


def month_comparison(t: Tables, as_of, months_ago: int) -> DataFrame:
    """Chain totals per month since a past month; the mean is over store means."""
    since = periods.month_start(periods.shift(as_of, months=-months_ago))
    paid = t.within("payment", since).filter(F.col("payment_date") >= since)
    rows = revenue_summary(t.replaced(payment=paid))
    return (
        rows.groupBy("revenue_month")
        .agg(
            F.count(F.lit(1)).alias("store_count"),
            F.sum("total_revenue").cast(MONEY_SUM).alias("chain_revenue"),
            F.sum("payment_count").alias("chain_rentals"),
            F.round(F.avg(F.col("avg_payment").cast("decimal(18,6)")), 2).alias("chain_avg_payment"),
        )
        .orderBy("revenue_month")
    )
