"""Store-facing queries. Without a store id they answer for every store at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kiosklake.functions import periods
from kiosklake.functions.numbers import MONEY_SUM, money, ratio
from kiosklake.operators.availability import IN_CIRCULATION, discs_out, with_availability
from kiosklake.operators.maintain import update_from
from kiosklake.operators.membership import only
from kiosklake.operators.ranking import top_per
from kiosklake.plans.customers import payments_per_rental, rented_since
from kiosklake.plans.showcase import rentals_per_disc
from kiosklake.plans.views import disc_films, overdue_rentals, store_inventory_summary, with_partners
from kiosklake.sources.tables import Tables

# Fixed value: status id of a disc taken out of use.
RETIRED = 4


def _circulating(t: Tables, store_id) -> DataFrame:
    return only(t.inventory.filter(F.col("status_id") == IN_CIRCULATION), "store_id", store_id)


def worn_discs(t: Tables, store_id=None, min_rentals: int = 15, batch: int = 10) -> DataFrame:
    """A store's most rented circulating discs that reached the rental threshold."""
    often = rentals_per_disc(t.rental).filter(F.col("rentals") >= min_rentals)
    worn = (
        _circulating(t, store_id)
        .select("inventory_id", "film_id", "store_id")
        .join(often, "inventory_id")
        .join(t.film.select("film_id", "title"), "film_id")
        .select("store_id", "inventory_id", "title", F.col("rentals").alias("rental_count"))
    )
    return top_per(worn, ["store_id"], [F.col("rental_count").desc(), F.col("inventory_id")], batch)


def recycle_discs(
    t: Tables, as_of, store_id=None, min_rentals: int = 15, batch: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Retire worn discs that are not out. Returns the new inventory and the retired discs."""
    retired = (
        worn_discs(t, store_id, min_rentals, batch)
        .select("inventory_id")
        .join(discs_out(t), "inventory_id", "left_anti")
        .withColumn("status", F.lit(RETIRED))
    )
    inventory = update_from(
        t.inventory, retired, ["inventory_id"], {"status_id": "status"},
        only_if=F.col("status_id") == IN_CIRCULATION, stamp=as_of,
    )
    return inventory, retired.select("inventory_id")


def utilization(t: Tables, as_of, days: int, store_id=None, k: int = 50) -> DataFrame:
    """Rentals in the window per circulating copy of each film at a store."""
    recent = rentals_per_disc(rented_since(t, periods.shift(as_of, days=-days)))
    per_film = (
        _circulating(t, store_id)
        .select("inventory_id", "film_id", "store_id")
        .join(recent, "inventory_id", "left")
        .groupBy("store_id", "film_id")
        .agg(
            F.count(F.lit(1)).alias("total_copies"),
            F.coalesce(F.sum("rentals"), F.lit(0)).alias("rentals_in_period"),
        )
        .withColumn("rentals_per_copy", ratio(F.col("rentals_in_period"), F.col("total_copies"), 1))
    )
    best = top_per(
        per_film, ["store_id"], [F.col("rentals_per_copy").desc_nulls_last(), F.col("film_id")], k
    )
    return best.join(t.film.select("film_id", "title", "popularity"), "film_id").select(
        "store_id", "film_id", "title", "popularity", "total_copies", "rentals_in_period", "rentals_per_copy"
    )


def _discs(t: Tables, store_id, circulating: bool = False) -> DataFrame:
    inventory = _circulating(t, store_id) if circulating else only(t.inventory, "store_id", store_id)
    return with_availability(
        inventory.select("inventory_id", "film_id", "store_id", "status_id"), t
    )


def stock_of_stores(t: Tables, store_ids=None) -> DataFrame:
    """Items, distinct films and free discs of stores that hold any."""
    per_film = _discs(t, store_ids).groupBy("store_id", "film_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_available").alias("free")
    )
    counted = per_film.groupBy("store_id").agg(
        F.sum("n").alias("total_items"),
        F.count(F.lit(1)).alias("unique_films"),
        F.sum("free").alias("available"),
    )
    return counted.join(t.store.select("store_id"), "store_id", "left_semi").orderBy(
        F.col("total_items").desc(), "store_id"
    )


def new_arrivals(t: Tables, as_of, store_id=None, days: int = 90, k: int = 20) -> DataFrame:
    """Films released lately that a store has in circulation, with free copies."""
    since = periods.shift(as_of, days=-days)
    films = t.film.filter(F.col("release_date").cast("timestamp_ntz") >= since).select(
        "film_id", "title", "release_date", "rating", "popularity", "vote_average"
    )
    stocked = (
        _discs(t, store_id, circulating=True)
        .join(films.select("film_id"), "film_id", "left_semi")
        .groupBy("store_id", "film_id")
        .agg(F.count(F.lit(1)).alias("copies_in_stock"), F.count_if(~F.col("is_out")).alias("copies_available"))
        .join(films, "film_id")
    )
    order = [
        F.col("release_date").desc_nulls_first(), F.col("popularity").desc_nulls_first(), F.col("film_id")
    ]
    return top_per(stocked, ["store_id"], order, k).select(
        "store_id", "film_id", "title", "release_date", "rating", "popularity", "vote_average",
        "copies_in_stock", "copies_available",
    )


def store_shelf(t: Tables, store_id=None, k: int = 50) -> DataFrame:
    """A store's films by popularity with copies and free copies."""
    per_film = _discs(t, store_id).groupBy("store_id", "film_id").agg(
        F.count(F.lit(1)).alias("total_copies"), F.count_if("is_available").alias("available")
    )
    shelf = per_film.join(t.film.select("film_id", "title", "rating", "popularity"), "film_id")
    order = [F.col("popularity").desc_nulls_first(), F.col("film_id")]
    return top_per(shelf, ["store_id"], order, k).select(
        "store_id", "film_id", "title", "rating", "popularity", "total_copies", "available"
    )


def longest_overdue(t: Tables, as_of, k: int = 50) -> DataFrame:
    """The ``k`` oldest open rentals; only these meet the names."""
    late = with_partners(t, t.still_open("rental"))
    late = late.join(t.store.select("store_id"), "store_id", "left_semi").select(*t.rental.columns)
    oldest = top_per(late, [], [F.col("period_start"), F.col("rental_id")], k)
    return overdue_rentals(t.replaced(rental=oldest), as_of).orderBy(F.col("days_outstanding").desc(), "rental_id").select(
        "rental_id", "full_name", "email", "film_title", "days_outstanding", "store_address", "store_zip"
    )


def overdue_by_store(t: Tables, as_of, store_id=None) -> DataFrame:
    rows = only(overdue_rentals(t.replaced(rental=only(t.rental, "store_id", store_id)), as_of), "store_id", store_id)
    return rows.select(
        "store_id", "rental_id", "full_name", "phone", "film_title", "days_outstanding"
    ).orderBy("store_id", F.col("days_outstanding").desc(), "rental_id")


def overdue_at_store(t: Tables, as_of, store_id=None, days: int = 5, k: int = 50) -> DataFrame:
    """A store's oldest open rentals past the limit with whole days out."""
    now = periods.moment(as_of)
    late = only(t.still_open("rental"), "store_id", store_id).filter(
        F.col("period_start") < periods.shift(as_of, days=-days)
    ).select("rental_id", "store_id", "period_start", "customer_id", "inventory_id")
    oldest = top_per(late, ["store_id"], [F.col("period_start"), F.col("rental_id")], k)
    return (
        oldest.join(t.customer.select("customer_id", "full_name"), "customer_id")
        .join(disc_films(t), "inventory_id")
        .join(t.film.select("film_id", "title"), "film_id")
        .select(
            "store_id", "rental_id", "full_name", "title", F.col("period_start").alias("rented_at"),
            periods.whole_days(F.col("period_start"), now).alias("days_out"),
        )
    )


def _recent(t: Tables, since, store_id, order: list, k: int) -> DataFrame:
    recent = t.within("rental", since).filter(F.col("period_start") > periods.moment(since))
    rows = only(recent, "store_id", store_id)
    newest = top_per(
        rows.select("rental_id", "store_id", "period_start", "period_end", "customer_id", "last_update"),
        ["store_id"], order, k,
    )
    return newest.join(t.customer.select("customer_id", "full_name"), "customer_id").select(
        "store_id", "rental_id", "period_start", "period_end", "customer_id", "full_name"
    )


def recent_activity(t: Tables, since, store_id=None, k: int = 100) -> DataFrame:
    """A store's rentals begun after ``since``, last touched first."""
    return _recent(t, since, store_id, [F.col("last_update").desc_nulls_first(), F.col("rental_id").desc()], k)


def recent_store_rentals(t: Tables, since, store_id=None, k: int = 100) -> DataFrame:
    """A store's rentals begun after ``since``, highest id first."""
    return _recent(t, since, store_id, [F.col("rental_id").desc()], k)


def stale_discs(t: Tables, as_of, store_id=None, days: int = 90, k: int = 50) -> DataFrame:
    """Circulating discs idle for more than ``days`` since their last return (or their start)."""
    returned = t.rental.groupBy("inventory_id").agg(F.max("period_end").alias("last_returned"))
    idle_since = F.coalesce(F.col("last_returned"), F.col("circulation_start"))
    idle = (
        _circulating(t, store_id)
        .select("inventory_id", "film_id", "store_id", "circulation_start")
        .join(returned, "inventory_id", "left")
        .filter(idle_since < periods.shift(as_of, days=-days))
        .withColumn("days_idle", periods.whole_days(idle_since, periods.moment(as_of)))
    )
    worst = top_per(idle, ["store_id"], [F.col("days_idle").desc(), F.col("inventory_id")], k)
    return worst.join(t.film.select("film_id", "title", "popularity"), "film_id").select(
        "store_id", "inventory_id", "title", "popularity", "last_returned", "days_idle"
    )


def dashboard(t: Tables, store_id=None) -> DataFrame:
    rows = store_inventory_summary(t.replaced(inventory=only(t.inventory, "store_id", store_id)))
    return rows.select(
        "store_id", "status_code", "status_description", "disc_count", "unique_films"
    ).orderBy("store_id", F.col("disc_count").desc(), "status_code")


def compare_stores(t: Tables, store_ids=None) -> DataFrame:
    rows = store_inventory_summary(t.replaced(inventory=only(t.inventory, "store_id", store_ids)))
    return rows.select(
        "store_id", "street_name", "status_code", "disc_count", "unique_films"
    ).orderBy("store_id", "status_code")


def low_stock(t: Tables, max_films: int, k: int = 20) -> DataFrame:
    """Stores with the fewest distinct films in circulation, below a bound."""
    rows = store_inventory_summary(t).filter(
        (F.col("status_code") == "in_circulation") & (F.col("unique_films") < max_films)
    )
    return top_per(rows, [], [F.col("unique_films"), F.col("store_id")], k).select(
        "store_id", "street_name", "zip_code", "disc_count", "unique_films"
    )


def performance(t: Tables, as_of, days: int, k: int = 25) -> DataFrame:
    """Stores by revenue of rentals begun in the window; stores without any stay in."""
    since = periods.shift(as_of, days=-days)
    weight = F.coalesce(F.col("payments"), F.lit(1))
    out = periods.seconds_between(
        F.col("period_start"), F.coalesce(F.col("period_end"), periods.moment(as_of))
    )
    per_disc = (
        rented_since(t, since)
        .select("rental_id", "store_id", "inventory_id", "period_start", "period_end")
        .join(payments_per_rental(t.payment), "rental_id", "left")
        .groupBy("store_id", "inventory_id")
        .agg(
            F.sum(weight).alias("n"),
            F.sum("paid").cast(MONEY_SUM).alias("paid"),
            F.sum((out * weight).cast("decimal(24,6)")).alias("seconds"),
        )
    )
    per_store = per_disc.groupBy("store_id").agg(
        F.sum("n").alias("n"),
        F.sum("paid").cast(MONEY_SUM).alias("paid"),
        F.sum("seconds").cast("decimal(24,6)").alias("seconds"),
        F.count(F.lit(1)).alias("discs"),
    )
    held = _circulating(t, None).groupBy("store_id").agg(F.count(F.lit(1)).alias("held"))
    hours = ratio(F.col("seconds"), F.col("n") * 3600, 1, "decimal(24,6)")
    zero = F.lit(0)
    stores = (
        t.store.select("store_id", "street_name")
        .join(per_store, "store_id", "left")
        .join(held, "store_id", "left")
        .select(
            "store_id", "street_name",
            F.coalesce("n", zero).alias("total_rentals"),
            F.coalesce(money(F.col("paid")), zero.cast(MONEY_SUM)).alias("total_revenue"),
            hours.alias("avg_hours_rented"),
            F.coalesce("discs", zero).alias("unique_items_rented"),
            F.coalesce("held", zero).alias("total_inventory"),
        )
    )
    return top_per(stores, [], [F.col("total_revenue").desc(), F.col("store_id")], k)


def latest_touched_disc(t: Tables, store_id=None) -> DataFrame:
    """The circulating disc of a store that changed last."""
    order = [F.col("last_update").desc_nulls_first(), F.col("inventory_id")]
    rows = _circulating(t, store_id).select("store_id", "inventory_id", "last_update")
    return top_per(rows, ["store_id"], order, 1).select("store_id", "inventory_id")


def disc_history(t: Tables, inventory_id=None) -> DataFrame:
    """Every rental of a disc (one id, a list or a frame) with where it was rented."""
    rentals = only(t.rental, "inventory_id", inventory_id).select(
        "inventory_id", "rental_id", "customer_id", "store_id", "period_start", "period_end"
    )
    stores = t.store.select(
        "store_id", F.col("street_name").alias("store_address"),
        F.col("lat").alias("store_lat"), F.col("lng").alias("store_lng"),
    )
    return (
        rentals.join(stores, "store_id")
        .join(t.customer.select("customer_id", F.col("full_name").alias("customer")), "customer_id")
        .join(t.payment.select("rental_id", "amount"), "rental_id", "left")
        .select(
            "inventory_id", "rental_id",
            F.col("period_start").alias("rented_at"), F.col("period_end").alias("returned_at"),
            F.col("store_id").alias("rented_from_store"), "store_address", "store_lat", "store_lng",
            "customer", "amount",
        )
        .orderBy("inventory_id", "rented_at", "rental_id")
    )


def disc_location(t: Tables, inventory_id=None) -> DataFrame:
    """Where a disc is now."""
    return (
        only(t.inventory, "inventory_id", inventory_id)
        .join(t.film.select("film_id", "title"), "film_id")
        .join(t.store.select("store_id", "street_name"), "store_id")
        .select(
            "inventory_id", "title", "store_id", "street_name", "status_id", "last_update",
            "circulation_start",
        )
    )
