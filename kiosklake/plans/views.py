"""The five standing views other reports build on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kiosklake.functions import periods
from kiosklake.functions.numbers import MONEY_SUM, ratio
from kiosklake.functions.text import join_sorted
from kiosklake.operators.membership import members
from kiosklake.sources.tables import Tables, current_version, outdated_months, read_snapshot, replace_months


def disc_films(t: Tables) -> DataFrame:
    return t.inventory.select("inventory_id", "film_id")


def customer_rentals(t: Tables) -> DataFrame:
    """Every rental with its customer, film and payments; one row per payment, or one without.

    Films are joined to discs, of which there are fewer, and rentals pass three shuffles: by rental,
    disc and customer, so that what follows by customer needs none.
    """
    c = t.customer.select(
        "customer_id", "full_name", "email", F.col("store_id").alias("home_store_id"), "activebool"
    )
    r = t.rental.select(
        "rental_id",
        "customer_id",
        "inventory_id",
        F.col("period_start").alias("rental_date"),
        F.col("period_end").alias("return_date"),
        F.col("store_id").alias("rental_store_id"),
    )
    f = t.film.select("film_id", F.col("title").alias("film_title"), "rating")
    p = t.payment.select("rental_id", "amount", "payment_date")
    return (
        r.join(p, "rental_id", "left")
        .join(disc_films(t).join(f, "film_id").drop("film_id"), "inventory_id")
        .join(c, "customer_id")
        .select(
            "customer_id", "full_name", "email", "home_store_id", "activebool", "rental_id",
            "rental_date", "return_date", "rental_store_id", "film_title", "rating", "amount",
            "payment_date",
        )
    )


def film_catalog(t: Tables) -> DataFrame:
    """Films with their genre names and the sizes of their cast and crew."""
    genres = (
        members(t.film.select("film_id", "genre_ids"), "genre_ids", "genre_id")
        .join(t.film_genre, "genre_id")
        .groupBy("film_id")
        .agg(join_sorted(F.col("name")).alias("genres"))
    )

    def sized(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("film_id").agg(F.count(F.lit(1)).alias(name))

    return (
        t.film.join(genres, "film_id", "left")
        .join(sized(t.film_cast, "cast_count"), "film_id", "left")
        .join(sized(t.film_crew, "crew_count"), "film_id", "left")
        .select(
            "film_id", "title", "overview", "release_date", "rating", "popularity", "vote_average",
            "vote_count", "runtime", "budget", "revenue", "original_language", "genres",
            F.coalesce("cast_count", F.lit(0)).alias("cast_count"),
            F.coalesce("crew_count", F.lit(0)).alias("crew_count"),
        )
    )


def with_partners(t: Tables, rental: DataFrame) -> DataFrame:
    """Rentals whose customer, disc and film are known: those that the joined views show."""
    discs = disc_films(t).join(t.film.select("film_id"), "film_id", "left_semi")
    return rental.join(t.customer.select("customer_id"), "customer_id", "left_semi").join(
        discs, "inventory_id", "left_semi"
    )


def overdue_rentals(t: Tables, as_of, days: int = 5) -> DataFrame:
    """Open rentals that started more than ``days`` days ago."""
    now = periods.moment(as_of)
    late = t.still_open("rental").filter(
        F.col("period_start") < periods.shift(as_of, days=-days)
    ).select("rental_id", "period_start", "customer_id", "inventory_id", "store_id")
    return (
        late.join(t.customer.select("customer_id", "full_name", "email", "phone"), "customer_id")
        .join(disc_films(t), "inventory_id")
        .join(t.film.select("film_id", F.col("title").alias("film_title")), "film_id")
        .join(
            t.store.select(
                "store_id",
                F.col("street_name").alias("store_address"),
                F.col("zip_code").alias("store_zip"),
            ),
            "store_id",
        )
        .select(
            "rental_id",
            F.col("period_start").alias("rental_date"),
            (now - F.col("period_start")).alias("days_outstanding"),
            "customer_id", "full_name", "email", "phone", "film_title", "film_id", "inventory_id",
            "store_id", "store_address", "store_zip",
        )
    )


def revenue_parts(t: Tables, payment: DataFrame | None = None) -> DataFrame:
    """Payments per renting store, month and customer: parts that add up to any revenue report."""
    payment = t.payment if payment is None else payment
    return (
        payment.select(
            "rental_id", "customer_id", "amount",
            periods.month_start(F.col("payment_date")).alias("revenue_month"),
        )
        .join(t.rental.select("rental_id", "store_id"), "rental_id")
        .groupBy("store_id", "revenue_month", "customer_id")
        .agg(F.count(F.lit(1)).alias("payments"), F.sum("amount").cast(MONEY_SUM).alias("amount"))
    )


def refresh_revenue_parts(spark: SparkSession, root: str) -> list[str]:
    """Bring a snapshot's ``revenue_part`` table up to date; returns the months it worked out anew.

    Only months whose payments were written since are read and replaced. Months stay right
    when rentals are closed, as a rental keeps its store.
    """
    stale = outdated_months(spark, root, "payment", "revenue_part")
    if stale:
        t = read_snapshot(spark, root)
        parts = revenue_parts(t, t.of_months("payment", stale))
        replace_months(parts, root, current_version(spark, root) + 1, "revenue_part", stale)
    return stale


def revenue_summary(t: Tables, parts: DataFrame | None = None) -> DataFrame:
    """Payments per renting store and month, from ``parts`` kept with a snapshot if they are given.

    Money is summed per store, month and customer before the distinct customers
    are counted, so one aggregation feeds both and a busy store is pre-reduced.
    """
    paid = revenue_parts(t) if parts is None else parts
    monthly = paid.groupBy("store_id", "revenue_month").agg(
        F.sum("payments").alias("payment_count"),
        F.sum("amount").cast(MONEY_SUM).alias("total_revenue"),
        F.count("customer_id").alias("unique_customers"),
    )
    return monthly.join(t.store.select("store_id", "street_name", "zip_code"), "store_id").select(
        "store_id", "street_name", "zip_code", "revenue_month", "payment_count", "total_revenue",
        ratio(F.col("total_revenue"), F.col("payment_count"), 6).alias("avg_payment"),
        "unique_customers",
    )


def store_inventory_summary(t: Tables) -> DataFrame:
    """Discs and distinct films per store and status."""
    per_film = t.inventory.groupBy("store_id", "status_id", "film_id").agg(F.count(F.lit(1)).alias("n"))
    counted = per_film.groupBy("store_id", "status_id").agg(
        F.sum("n").alias("disc_count"), F.count(F.lit(1)).alias("unique_films")
    )
    status = t.inventory_status.select(
        "status_id", "status_code", F.col("description").alias("status_description")
    )
    return (
        counted.join(t.store.select("store_id", "street_name", "zip_code"), "store_id")
        .join(status, "status_id")
        .select(
            "store_id", "street_name", "zip_code", "status_code", "status_description",
            "disc_count", "unique_films",
        )
    )
