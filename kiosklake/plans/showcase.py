"""Showcase reports: geography, seasons, genres and people.

Counts per disc are taken before any join, so a disc, film or customer with a
large share of all rentals is one row by the time it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kiosklake.functions import periods
from kiosklake.functions.geo import distance_between, with_vector
from kiosklake.functions.numbers import MONEY_SUM, money, percent, ratio
from kiosklake.operators.membership import members
from kiosklake.operators.pairs import shared_group_pairs
from kiosklake.operators.ranking import top_per
from kiosklake.plans.views import disc_films
from kiosklake.sources.tables import Tables


def with_share(counts: DataFrame, value: str, digits: int, name: str = "pct") -> DataFrame:
    """Percent of the total over already grouped rows.

    Only used where the groups are a fixed handful (weekdays, statuses, bands).
    """
    total = F.sum(value).over(Window.partitionBy())
    return counts.withColumn(name, percent(F.col(value), total, digits))


def rentals_per_disc(rental: DataFrame) -> DataFrame:
    return rental.groupBy("inventory_id").agg(F.count(F.lit(1)).alias("rentals"))


def rentals_per_film(t: Tables, rental: DataFrame) -> DataFrame:
    """Rental count per film, aggregated on the disc before the disc is looked up."""
    return (
        rentals_per_disc(rental)
        .join(disc_films(t), "inventory_id")
        .groupBy("film_id")
        .agg(F.sum("rentals").alias("rentals"))
    )


def rental_hotspots(t: Tables, k: int = 10) -> DataFrame:
    """Cities by rentals, with customers and rentals per customer."""
    per_customer = t.rental.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    cities = (
        t.customer.select("customer_id", "zip_code")
        .join(per_customer, "customer_id")
        .groupBy("zip_code")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("c"))
        .join(t.zip_code_info.select("zip_code", "city", "state_id"), "zip_code")
        .groupBy("city", "state_id")
        .agg(F.sum("n").alias("total_rentals"), F.sum("c").alias("customers"))
        .withColumn("rentals_per_customer", ratio(F.col("total_rentals"), F.col("customers"), 1))
    )
    return top_per(cities, [], [F.col("total_rentals").desc(), F.col("city"), F.col("state_id")], k)


# Distance bands as (below km, label), and the label beyond them.
DISTANCE_BANDS = [(5, "< 5 km"), (10, "5-10 km"), (15, "10-15 km"), (20, "15-20 km")]
FAR = "20+ km"


def banded(tests: list[tuple[Column, str]], beyond: str) -> Column:
    """Label of the first test that holds."""
    label = None
    for test, name in tests:
        label = F.when(test, name) if label is None else label.when(test, name)
    return label.otherwise(beyond)


def distance_band(km: Column) -> Column:
    return banded([(km < top, name) for top, name in DISTANCE_BANDS], FAR)


def travel_distances(t: Tables) -> DataFrame:
    """How far customers travel: rentals per distance band, nearest band first.

    Rentals are counted per (customer, store) first; each pair is measured once.
    """
    trips = t.rental.groupBy("customer_id", "store_id").agg(F.count(F.lit(1)).alias("n"))
    home = with_vector(t.customer.select("customer_id", "lat", "lng"), ("lat", "lng"), "c_").drop("lat", "lng")
    shop = with_vector(t.store.select("store_id", "lat", "lng"), ("lat", "lng"), "s_").drop("lat", "lng")
    km = distance_between("c_", "s_") / 1000.0
    bands = (
        trips.join(home, "customer_id")
        .join(shop, "store_id")
        .withColumn("km", km)
        .groupBy(distance_band(F.col("km")).alias("distance_bucket"))
        .agg(F.sum("n").alias("rentals"), F.min("km").alias("nearest"))
    )
    shares = with_share(bands, "rentals", 1)
    return shares.orderBy(F.col("nearest").asc_nulls_last()).drop("nearest")


def day_of_week(t: Tables, rental: DataFrame | None = None) -> DataFrame:
    """Rentals per weekday of their start, Sunday first."""
    rows = t.rental if rental is None else rental
    start = F.col("period_start")
    days = rows.groupBy(
        periods.dow_name(start).alias("day_of_week"), periods.dow_number(start).alias("dow_num")
    ).agg(F.count(F.lit(1)).alias("rentals"))
    return with_share(days, "rentals", 1).orderBy("dow_num")


def monthly_trend(
    t: Tables, k: int = 12, since=None, count_each_rental_once: bool = False
) -> DataFrame:
    """Rentals, revenue and change per month, newest first.

    A rental with two payments counts twice, as a plain outer join counts it;
    ``count_each_rental_once`` counts rentals instead.
    """
    rental = t.rental
    if since is not None:
        rental = t.within("rental", since).filter(F.col("period_start") >= since)
    paid = t.payment.groupBy("rental_id").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").alias("amount")
    )
    weight = F.lit(1) if count_each_rental_once else F.coalesce(F.col("payments"), F.lit(1))
    months = (
        rental.select("rental_id", periods.month_text(F.col("period_start")).alias("month"))
        .join(paid, "rental_id", "left")
        .groupBy("month")
        .agg(F.sum(weight).alias("rentals"), money(F.sum("amount")).alias("revenue"))
    )
    # one row per month: the unpartitioned window sees a few hundred rows at most
    before = F.lag("rentals").over(Window.orderBy("month"))
    change = percent(F.col("rentals") - before, before, 1)
    return months.withColumn("mom_change_pct", change).orderBy(F.col("month").desc()).limit(k)


def busiest_holidays(t: Tables, first: str, last: str, k: int = 10) -> DataFrame:
    """Holidays in a date range by rentals started that day (none counts 0)."""
    days = t.holiday.filter(F.col("holiday_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    started = (
        t.within("rental", first, last).filter(
            (F.col("period_start") >= periods.moment(first))
            & (F.col("period_start") < periods.shift(last, days=1))
        )
        .groupBy(F.col("period_start").cast("date").alias("holiday_date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = (
        days.join(started, "holiday_date", "left")
        .groupBy("holiday_name", "holiday_date")
        .agg(F.sum(F.coalesce("n", F.lit(0))).alias("rentals_on_holiday"))
    )
    order = [F.col("rentals_on_holiday").desc(), F.col("holiday_date"), F.col("holiday_name")]
    return top_per(counted, [], order, k)


def genre_rentals(t: Tables, rental: DataFrame, k: int | None = 10) -> DataFrame:
    """Genre names by rentals of their films.

    Several genre ids may bear one name: a film counts once per name, its rentals once
    per id it lists.
    """
    per_film = rentals_per_film(t, rental)
    tagged = members(t.film.select("film_id", "genre_ids"), "genre_ids", "genre_id")
    per_name = (
        per_film.join(tagged, "film_id")
        .join(t.film_genre, "genre_id")
        .groupBy(F.col("name").alias("genre"), "film_id")
        .agg(F.sum("rentals").alias("rentals"))
    )
    named = (
        per_name.groupBy("genre")
        .agg(F.sum("rentals").alias("total_rentals"), F.count(F.lit(1)).alias("films_in_genre"))
        .withColumn("rentals_per_film", ratio(F.col("total_rentals"), F.col("films_in_genre"), 0))
    )
    order = [F.col("total_rentals").desc(), F.col("genre")]
    return named.orderBy(*order) if k is None else top_per(named, [], order, k)


def top_actors(t: Tables, rental: DataFrame, min_films: int = 3, k: int = 15) -> DataFrame:
    """Actors by rentals of their films, films counted once per actor.

    Rentals are reduced to one row per film before they meet the cast.
    """
    per_film = rentals_per_film(t, rental)
    actors = (
        t.film_cast.select("film_id", "person_id")
        .join(per_film, "film_id")
        .groupBy("person_id")
        .agg(F.count(F.lit(1)).alias("films"), F.sum("rentals").alias("total_rentals"))
        .filter(F.col("films") >= min_films)
        .join(t.person.select("person_id", F.col("name").alias("actor")), "person_id")
        .withColumn("rentals_per_film", ratio(F.col("total_rentals"), F.col("films"), 0))
    )
    order = [F.col("total_rentals").desc(), F.col("person_id")]
    return top_per(actors, [], order, k).select("actor", "films", "total_rentals", "rentals_per_film")


def top_actors_unreduced(t: Tables, rental: DataFrame, min_films: int = 3, k: int = 15) -> DataFrame:
    """The same report joined row by row; kept as the slow half of a comparison."""
    actors = (
        t.film_cast.select("film_id", "person_id")
        .join(disc_films(t), "film_id")
        .join(rental.select("rental_id", "inventory_id"), "inventory_id")
        .groupBy("person_id")
        .agg(F.countDistinct("film_id").alias("films"), F.count("rental_id").alias("total_rentals"))
        .filter(F.col("films") >= min_films)
        .join(t.person.select("person_id", F.col("name").alias("actor")), "person_id")
        .withColumn("rentals_per_film", ratio(F.col("total_rentals"), F.col("films"), 0))
    )
    order = [F.col("total_rentals").desc(), F.col("person_id")]
    return top_per(actors, [], order, k).select("actor", "films", "total_rentals", "rentals_per_film")


def top_directors(t: Tables, min_films: int = 2, k: int = 10) -> DataFrame:
    """Directors by rentals, with revenue; rentals count once per payment or once unpaid."""
    paid = t.payment.groupBy("rental_id").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").alias("amount")
    )
    per_film = (
        t.rental.select("rental_id", "inventory_id")
        .join(paid, "rental_id", "left")
        .groupBy("inventory_id")
        .agg(
            F.sum(F.coalesce("payments", F.lit(1))).alias("rentals"),
            F.sum("amount").cast(MONEY_SUM).alias("amount"),
        )
        .join(disc_films(t), "inventory_id")
        .groupBy("film_id")
        .agg(F.sum("rentals").alias("rentals"), F.sum("amount").cast(MONEY_SUM).alias("amount"))
    )
    directors = (
        t.film_crew.filter(F.col("job") == "Director")
        .select("film_id", "person_id")
        .join(per_film, "film_id")
        .groupBy("person_id")
        .agg(
            F.count(F.lit(1)).alias("films_directed"),
            F.sum("rentals").alias("total_rentals"),
            money(F.sum("amount")).alias("total_revenue"),
        )
        .filter(F.col("films_directed") >= min_films)
        .join(t.person.select("person_id", F.col("name").alias("director")), "person_id")
    )
    order = [F.col("total_rentals").desc(), F.col("person_id")]
    return top_per(directors, [], order, k).select(
        "director", "films_directed", "total_rentals", "total_revenue"
    )


def actor_pairs(t: Tables, min_films: int = 5, k: int = 15) -> DataFrame:
    """Pairs of actor names by films together; people with equal names merge."""
    # a name is known by its smallest person id while pairs are counted
    names = t.person.groupBy("name").agg(F.min("person_id").alias("name_id"))
    ids = t.person.select("person_id", "name").join(names, "name").select("person_id", "name_id")
    pairs = shared_group_pairs(
        t.film_cast.select("film_id", "person_id").join(ids, "person_id"),
        group="film_id", label="name_id", member="person_id", min_groups=min_films, best=k,
    )

    def named(column: str, alias: str) -> DataFrame:
        return names.select(F.col("name_id").alias(column), F.col("name").alias(alias))

    pairs = (
        pairs.join(named("label_1", "actor_1"), "label_1")
        .join(named("label_2", "actor_2"), "label_2")
        .select("actor_1", "actor_2", F.col("shared").alias("films_together"))
    )
    order = [F.col("films_together").desc(), F.col("actor_1"), F.col("actor_2")]
    return top_per(pairs, [], order, k)


def films_of_actor(t: Tables, name_part: str) -> DataFrame:
    """Films of every actor whose name contains a text (any case), newest first, undated ahead."""
    people = t.person.filter(F.col("name").ilike(f"%{name_part}%")).select("person_id")
    return (
        t.film_cast.join(people, "person_id", "left_semi")
        .join(t.film.select("film_id", "title", "release_date", "vote_average"), "film_id")
        .select("title", "release_date", "film_character", "vote_average")
        .orderBy(F.col("release_date").desc_nulls_first(), "title", "film_character")
    )
