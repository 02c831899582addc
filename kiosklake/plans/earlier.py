"""Operators of earlier versions that are still useful."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kiosklake.functions import periods
from kiosklake.functions.numbers import digest_steps, key_text, next_key, steps_reached
from kiosklake.operators.ranking import first_per
from kiosklake.session import dealt
from kiosklake.sources.tables import Tables


def _held(t: Tables, as_of) -> DataFrame:
    """Rentals that hold their disc: open, or covering the instant."""
    covering = t.holding("rental", as_of).filter(~periods.is_open(F.col("period_end")))
    return t.still_open("rental").unionByName(covering)


def discs_with_stock_flag(t: Tables, as_of) -> DataFrame:
    """Every disc with ``in_stock``: no rental is open or covers the instant."""
    held = _held(t, as_of).select("inventory_id").distinct().withColumn("_held", F.lit(True))
    return t.inventory.join(held, "inventory_id", "left").select(
        "inventory_id", "film_id", "store_id", F.col("_held").isNull().alias("in_stock")
    )


def film_in_stock(t: Tables, as_of, film_id=None, store_id=None, in_stock: bool = True) -> DataFrame:
    """Discs of a film at a store that are (or are not) in stock."""
    rows = discs_with_stock_flag(t, as_of).filter(F.col("in_stock") == in_stock)
    if film_id is not None:
        rows = rows.filter(F.col("film_id") == film_id)
    if store_id is not None:
        rows = rows.filter(F.col("store_id") == store_id)
    return rows.select("film_id", "store_id", "inventory_id")


def disc_holders(t: Tables, as_of) -> DataFrame:
    """Who holds each disc; of overlapping rentals the lowest id answers."""
    held = _held(t, as_of).select("inventory_id", "customer_id", "rental_id")
    return first_per(held, ["inventory_id"], [F.col("rental_id")]).drop("rental_id")


# Fixed values: (popularity up to, fewest copies, most copies).
BANDS = [(20, 0, 3), (35, 0, 5), (75, 2, 6), (100, 5, 8), (500, 8, 12)]
TOP_BAND = (12, 20)


def copy_bounds(popularity: Column, release_date: Column, as_of) -> tuple[Column, Column]:
    """Fewest and most copies by popularity, less 1, 2 or 3 for films over 1, 3 or 4 years old."""
    low = high = None
    for top, fewest, most in BANDS:
        low = F.when(popularity <= top, fewest) if low is None else low.when(popularity <= top, fewest)
        high = F.when(popularity <= top, most) if high is None else high.when(popularity <= top, most)
    low, high = low.when(popularity > 500, TOP_BAND[0]), high.when(popularity > 500, TOP_BAND[1])

    def since(years: int) -> Column:
        return periods.shift(as_of, years=-years)

    released = release_date.cast("timestamp_ntz")
    less = (
        F.when(released > since(1), 0).when(released >= since(3), 1).when(released >= since(4), 2).otherwise(3)
    )
    return F.greatest(low - less, F.lit(0)), F.greatest(high - less, F.lit(0))


# Every pair of bounds that copy_bounds gives.
BOUNDS = sorted({
    (max(low - less, 0), max(high - less, 0)) for low, high in [*[band[1:] for band in BANDS], TOP_BAND] for less in range(4)
})


def new_film_stock(t: Tables, as_of, seed: str = "new-stock") -> DataFrame:
    """Copies per store of films released after the newest film the store holds.

    Such a film cannot be in the store yet, so no further exclusion is needed. The
    date inequality becomes an equi-join: each store is listed under every later
    release day up to the newest film.
    """
    film = t.film.select("film_id", "popularity", "release_date")
    newest = film.agg(F.max("release_date").alias("d")).scalar()
    stores = (
        t.inventory.select("film_id", "store_id")
        .distinct()
        .join(film.select("film_id", "release_date"), "film_id")
        .groupBy("store_id")
        .agg(F.max("release_date").alias("held_until"))
        .filter(F.col("held_until") < newest)
        .withColumn("release_date", F.explode(F.sequence(F.date_add("held_until", 1), newest)))
        .drop("held_until")
    )
    low, high = copy_bounds(F.col("popularity"), F.col("release_date"), as_of)
    # what a film or a store adds to a pair's digest, and the steps of a film's draws, are found once, not per pair
    films = film.filter(F.col("popularity").isNotNull()).select(
        "film_id", "release_date", low.alias("fewest"), high.alias("most"), key_text(seed, F.col("film_id")).alias("film_text")
    )
    kinds: dict[tuple[str, ...], Column] = {}
    for fewest, most in BOUNDS:
        steps, given = tuple(digest_steps(fewest, most)), (F.col("fewest") == fewest) & (F.col("most") == most)
        kinds[steps] = kinds[steps] | given if steps in kinds else given
    kind = F.coalesce(*[F.when(given, n) for n, given in enumerate(kinds.values())])
    films = films.withColumn("kind", kind)
    stores = stores.withColumn("store_text", next_key(F.col("store_id")))
    # a day makes a row per store and film, so days are dealt by number and not by their few bytes
    stores, films = dealt(stores, "release_date"), dealt(films, "release_date")
    pairs = stores.join(films, "release_date").withColumn("digest", F.md5(F.concat("film_text", "store_text")))
    more = F.coalesce(*[
        F.when(F.col("kind") == n, steps_reached(F.col("digest"), [F.lit(x) for x in steps])) for n, steps in enumerate(kinds)
    ])
    copies = F.col("fewest") + more
    return pairs.select("store_id", "film_id", "fewest", "most", copies.alias("copies"))
