"""Film browsing: lookups, catalog pages, search, cast and crew."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kiosklake.functions import periods, text
from kiosklake.operators.availability import available_discs
from kiosklake.operators.geojoin import radius_join
from kiosklake.operators.membership import only
from kiosklake.operators.ranking import top_per
from kiosklake.plans.views import film_catalog
from kiosklake.sources.tables import Tables

# Fixed value: metres searched round a zip code.
ZIP_RADIUS_M = 50_000.0
_CARD = ["film_id", "title", "release_date", "rating", "popularity", "vote_average"]


def film_lookup(t: Tables, fragment: str, k: int = 200) -> DataFrame:
    """First ``k`` films by id whose title holds a text (any case), most popular first."""
    hits = t.film.filter(F.col("title").ilike(f"%{fragment}%"))
    found = top_per(hits, [], [F.col("film_id")], k)
    return found.select(*_CARD, "runtime").orderBy(F.col("popularity").desc_nulls_first(), "film_id")


def films_by_id(t: Tables, film_ids) -> DataFrame:
    """Details of listed films (a list or a frame of ids), most popular first."""
    return (
        only(t.film, "film_id", film_ids)
        .select(*_CARD, "runtime")
        .orderBy(F.col("popularity").desc_nulls_first(), "film_id")
    )


def _catalog_of(t: Tables, films: DataFrame) -> DataFrame:
    """Catalog rows for an already chosen page of films.

    The page is chosen on the film table alone; only its few films then meet
    genres, cast and crew.
    """
    page = films.select("film_id")
    return film_catalog(
        t.replaced(
            film=films,
            film_cast=t.film_cast.join(page, "film_id", "left_semi"),
            film_crew=t.film_crew.join(page, "film_id", "left_semi"),
        )
    )


def catalog_recent(t: Tables, as_of, years: int, k: int = 25) -> DataFrame:
    since = periods.shift(as_of, years=-years).cast("date")
    films = t.film.filter(F.col("release_date") >= since)
    page = top_per(films, [], [F.col("popularity").desc_nulls_first(), F.col("film_id")], k)
    return _catalog_of(t, page).select(
        "film_id", "title", "genres", "vote_average", "popularity", "cast_count", "crew_count"
    ).orderBy(F.col("popularity").desc_nulls_first(), "film_id")


def catalog_top_rated(t: Tables, min_rating: float, min_votes: int = 100, k: int = 25) -> DataFrame:
    rating = F.lit(min_rating).cast("float")
    films = t.film.filter((F.col("vote_average") >= rating) & (F.col("vote_count") >= min_votes))
    page = top_per(films, [], [F.col("vote_average").desc_nulls_first(), F.col("film_id")], k)
    return _catalog_of(t, page).select(
        "film_id", "title", "genres", "release_date", "vote_average", "popularity", "cast_count"
    ).orderBy(F.col("vote_average").desc_nulls_first(), "film_id")


def catalog_big_budget(t: Tables, as_of, min_budget: int, years: int, k: int = 25) -> DataFrame:
    since = periods.shift(as_of, years=-years).cast("date")
    films = t.film.filter((F.col("budget") >= min_budget) & (F.col("release_date") >= since))
    page = top_per(films, [], [F.col("revenue").desc_nulls_last(), F.col("film_id")], k)
    return _catalog_of(t, page).select(
        "film_id", "title", "genres", "release_date", "budget", "revenue", "vote_average", "runtime"
    ).orderBy(F.col("revenue").desc_nulls_last(), "film_id")


def films_in_genre(t: Tables, genre_id: int, k: int = 20) -> DataFrame:
    films = t.film.filter(F.array_contains("genre_ids", F.lit(genre_id).cast("int")))
    return top_per(films.select(*_CARD), [], [F.col("popularity").desc_nulls_first(), F.col("film_id")], k)


def films_with_rating(t: Tables, rating: str, k: int = 20) -> DataFrame:
    films = t.film.filter(F.col("rating") == rating)
    return top_per(films.select(*_CARD), [], [F.col("vote_average").desc_nulls_first(), F.col("film_id")], k)


def popular_films(t: Tables, k: int = 20) -> DataFrame:
    return top_per(t.film.select(*_CARD), [], [F.col("popularity").desc_nulls_first(), F.col("film_id")], k)


def search_films(film: DataFrame, terms: list[str], k: int = 20) -> DataFrame:
    """Films whose title or overview holds every term, by share of matching words.

    Terms are cut into words as the texts are; stopwords among them are dropped, and without
    any other word nothing is found. Words are matched whole and in any case; there is no
    stemming. A plain substring test drops most texts before they are split into words; texts
    are not shuffled.
    """
    terms = text.search_words(terms)
    whole = F.concat_ws(" ", "title", "overview")
    words = text.tokens(whole)
    hits = (
        film.filter(text.may_have_all(whole, terms) if terms else F.lit(False))
        .withColumn("_words", words)
        .filter(text.has_all(F.col("_words"), terms))
        .withColumn("rank", text.term_frequency(F.col("_words"), terms))
        .select("film_id", "title", "release_date", "rating", "popularity", "rank")
    )
    return top_per(hits, [], [F.col("rank").desc(), F.col("film_id")], k)


def film_detail(t: Tables, film_id=None) -> DataFrame:
    return only(t.film, "film_id", film_id).select(
        "film_id", "title", "overview", "release_date", "rating", "popularity", "vote_average",
        "budget", "revenue", "runtime",
    )


def cast_of(t: Tables, film_id=None) -> DataFrame:
    """Cast by popularity of the person, unknown popularity first."""
    return (
        only(t.film_cast, "film_id", film_id)
        .join(t.person.select("person_id", "name", "popularity"), "person_id")
        .select("film_id", "person_id", "name", "popularity", "film_character")
        .orderBy("film_id", F.col("popularity").desc_nulls_first(), "person_id")
    )


def crew_of(t: Tables, film_id=None) -> DataFrame:
    return (
        only(t.film_crew, "film_id", film_id)
        .join(t.person.select("person_id", "name"), "person_id")
        .select("film_id", "person_id", "name", "department", "job")
    )


def stores_near_zips(t: Tables, zip_code=None, radius_m: float = ZIP_RADIUS_M) -> DataFrame:
    """Every store within the radius of a zip code, with the distance in metres."""
    places = only(t.zip_code_info, "zip_code", zip_code).select(
        "zip_code", F.col("lat").alias("z_lat"), F.col("lng").alias("z_lng")
    )
    stores = t.store.select(
        "store_id", "street_name", "road_ref", "phone", F.col("lat").alias("s_lat"), F.col("lng").alias("s_lng")
    )
    return radius_join(
        places, stores, radius_m, site_key="zip_code", site_at=("z_lat", "z_lng"),
        point_key="store_id", point_at=("s_lat", "s_lng"),
    )


def _km():
    return F.round(F.col("distance_m") / 1000.0, 1)


def nearest_stores(t: Tables, zip_code=None, k: int = 10, radius_m: float = ZIP_RADIUS_M) -> DataFrame:
    """The ``k`` stores nearest to a zip code."""
    near = stores_near_zips(t, zip_code, radius_m)
    best = top_per(near, ["zip_code"], [F.col("distance_m"), F.col("store_id")], k)
    return best.select("zip_code", "store_id", "street_name", "road_ref", "phone", _km().alias("distance_km"))


def film_near_zip(
    t: Tables, film_id=None, zip_code=None, k: int = 10, radius_m: float = ZIP_RADIUS_M
) -> DataFrame:
    """Stores near a zip code with free copies of a film, nearest first."""
    free = (
        only(available_discs(t), "film_id", film_id)
        .groupBy("film_id", "store_id")
        .agg(F.count(F.lit(1)).alias("copies_available"))
    )
    near = stores_near_zips(t, zip_code, radius_m).select(
        "zip_code", "store_id", "street_name", "road_ref", _km().alias("distance_km")
    )
    order = [F.col("distance_km"), F.col("store_id")]
    return top_per(free.join(near, "store_id"), ["zip_code", "film_id"], order, k).select(
        "zip_code", "film_id", "store_id", "street_name", "road_ref", "copies_available", "distance_km"
    )
