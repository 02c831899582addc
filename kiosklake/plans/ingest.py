"""Catalog ingestion: from landed documents to film, people, company and credit tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from kiosklake.operators.checks import RATINGS, rating_rank
from kiosklake.operators.maintain import (
    append, count_delta, delete_keys, emptied, insert_if_absent, insert_new, missing_keys, newer_than,
    row_counts, update_from,
)
from kiosklake.operators.membership import not_in
from kiosklake.operators.ranking import first_per
from kiosklake.plans.stock import populate_inventory
from kiosklake.session import materialize
from kiosklake.sources.landing import elements, quarantined
from kiosklake.sources.schemas import CAST_DOC, COMPANY_DOC, CREW_DOC, RELEASE_DOC
from kiosklake.sources.tables import Tables

_PAIR = ["film_id", "person_id"]


@dataclass(frozen=True)
class Eligibility:
    """What the catalog takes in. Defaults are fixed values of the domain."""

    min_vote_average: float = 5.5
    min_vote_count: int = 20
    max_certification: str = "PG-13"
    language: str = "en"


def eligible_films(
    films: DataFrame, rules: Eligibility = Eligibility(), *, year: int | None = None, since=None
) -> DataFrame:
    """Films that pass the rules, of one release year or from a date on, most popular first."""
    kept = films.filter(
        (F.col("vote_average") >= F.lit(rules.min_vote_average).cast("float"))
        & (F.col("vote_count") >= rules.min_vote_count)
        & (F.col("original_language") == rules.language)
        & (rating_rank(F.col("rating")) <= RATINGS.index(rules.max_certification) + 1)
    )
    if year is not None:
        first, last = f"{year}-01-01", f"{year}-12-31"
        kept = kept.filter(F.col("release_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    if since is not None:
        kept = kept.filter(F.col("release_date") >= F.lit(since).cast("date"))
    return kept.orderBy(F.col("popularity").desc_nulls_last(), "film_id")


def flatten_credits(credits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cast and crew rows of the credit documents; the first entry per film and person wins."""
    item = F.col("item")

    def flat(column: str, shape: str, *names: tuple[str, str]) -> DataFrame:
        rows = elements(credits.select("film_id", column), column, shape)
        rows = rows.select(
            "film_id", item["id"].alias("person_id"), "pos", *[item[a].alias(b) for a, b in names]
        ).filter(F.col("person_id").isNotNull())
        return first_per(rows, _PAIR, [F.col("pos"), *[F.col(b) for _, b in names]]).drop("pos")

    cast = flat("cast", CAST_DOC, ("character", "film_character"))
    crew = flat("crew", CREW_DOC, ("department", "department"), ("job", "job"))
    return cast, crew


def companies_of(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Film details of known films, and the companies and film links they would add.

    Only unprocessed details of films without any company yet are unpacked.
    """
    detail = t.landed_detail.join(t.film.select("film_id"), "film_id", "left_semi")
    fresh = not_in(
        detail.filter(F.col("processed").eqNullSafe(False)).select("film_id", "production_companies"),
        "film_id",
        t.film_production_company.select("film_id"),
    )
    rows = elements(fresh, "production_companies", COMPANY_DOC).select(
        "film_id", F.col("item.id").alias("production_company_id"), F.col("item.name").alias("name")
    ).filter(F.col("production_company_id").isNotNull())
    companies = insert_new(
        t.production_company, rows.select("production_company_id", "name").distinct(),
        ["production_company_id"], [F.col("name").asc_nulls_last()],
    )
    links = insert_new(
        t.film_production_company, rows.select("film_id", "production_company_id").distinct(),
        ["film_id", "production_company_id"], [F.col("film_id")],
    )
    return detail, companies, links


def transform_details(t: Tables) -> Tables:
    detail, companies, links = companies_of(t)
    return t.replaced(
        landed_detail=detail,
        production_company=append(t.production_company, companies),
        film_production_company=append(t.film_production_company, links),
    )


def fill_film_details(t: Tables) -> DataFrame:
    """Films with budget, revenue and runtime from their details where any of the three is NULL."""
    figures = ["budget", "revenue", "runtime"]
    details = first_per(
        t.landed_detail.select("film_id", *figures), ["film_id"],
        [F.col(c).asc_nulls_last() for c in figures],
    )
    lacking = F.col("budget").isNull() | F.col("revenue").isNull() | F.col("runtime").isNull()
    return update_from(t.film, details, ["film_id"], {c: c for c in figures}, only_if=lacking)


def rate_films(t: Tables) -> DataFrame:
    """Films with a rating from their first known US certification, where they had none."""
    item = F.col("item")
    unrated = t.film.filter(F.col("rating").isNull()).select("film_id")
    docs = t.landed_releases.join(unrated, "film_id", "left_semi")
    rows = (
        elements(docs, "releases", RELEASE_DOC)
        .filter((item["iso_3166_1"] == "US") & (item["certification"] != ""))
        .select("film_id", "pos", F.trim(item["certification"]).alias("certification"))
        .filter(F.col("certification").isin(*RATINGS))
    )
    first = first_per(rows, ["film_id"], [F.col("pos"), F.col("certification")])
    return update_from(
        t.film, first, ["film_id"], {"rating": "certification"}, only_if=F.col("rating").isNull()
    )


def move_credits(t: Tables) -> Tables:
    """Staged credits of known films into the final tables; existing pairs stay as they are."""
    def known(staged: DataFrame) -> DataFrame:
        return staged.join(t.film.select("film_id"), "film_id", "left_semi")

    cast, crew = known(t.staged_cast), known(t.staged_crew)
    return t.replaced(
        staged_cast=cast,
        staged_crew=crew,
        film_cast=insert_if_absent(t.film_cast, cast, _PAIR, [F.col("film_character")]),
        film_crew=insert_if_absent(t.film_crew, crew, _PAIR, [F.col("department"), F.col("job")]),
    )


def films_without_detail(t: Tables) -> DataFrame:
    return missing_keys([t.film], "film_id", t.film_production_company)


def people_to_fetch(t: Tables) -> DataFrame:
    return missing_keys([t.staged_cast, t.staged_crew], "person_id", t.person)


# Labels of the load report, with the tables they count.
REPORT = {
    "Films": "film",
    "People": "person",
    "Cast entries": "film_cast",
    "Crew entries": "film_crew",
    "Production companies": "production_company",
    "Inventory items": "inventory",
    "Genres": "film_genre",
    "Staging: credits": "landed_credits",
    "Staging: cast": "staged_cast",
    "Staging: crew": "staged_crew",
    "Staging: details": "landed_detail",
    "Staging: releases": "landed_releases",
}


def table_counts(t: Tables) -> DataFrame:
    return row_counts({label: t[name] for label, name in REPORT.items()})


_STAGING = ("landed_credits", "landed_detail", "landed_releases", "staged_cast", "staged_crew")


def reset_staging(t: Tables) -> Tables:
    return t.replaced(**{name: emptied(t[name]) for name in _STAGING})


def load_catalog(
    t: Tables, landed: Tables, as_of, *, recent: bool = True, seed: str = "stock", rules: Eligibility | None = None
):
    """The whole load: returns the next tables and the before/after report.

    ``landed`` holds film, film_genre and person rows and the landing documents. In
    recent mode only films from the newest release date on are taken; with ``rules`` only
    those that pass them, by the rating they have or get from their release documents.
    The next tables have ``quarantine``: the documents of found films that could not be read.
    """
    before = table_counts(t)
    t = reset_staging(t)
    t = t.replaced(
        film_genre=insert_if_absent(t.film_genre, landed.film_genre, ["genre_id"], [F.col("name")])
    )
    found = newer_than(landed.film, "release_date", t.film) if recent else landed.film
    if rules is not None:
        rated = rate_films(Tables({"film": found, "landed_releases": landed.landed_releases}))
        passed = eligible_films(rated, rules).select("film_id")
        found = found.join(passed, "film_id", "left_semi")
    found = materialize(found, "found-films")  # read by four steps
    new_films = insert_new(t.film, found, ["film_id"], [F.col("title")])

    def of_found(name: str) -> DataFrame:
        return landed[name].join(found.select("film_id"), "film_id", "left_semi")

    t = t.replaced(
        film=append(t.film, new_films),
        landed_credits=of_found("landed_credits"),
        landed_releases=of_found("landed_releases"),
    )
    # details are fetched for every film that has no company yet
    t = t.replaced(
        landed_detail=landed.landed_detail.join(films_without_detail(t), "film_id", "left_semi")
    )
    broken = quarantined(t.landed_credits, "landed_credits")
    for name in ("landed_detail", "landed_releases"):
        broken = broken.unionByName(quarantined(t[name], name))
    t = t.replaced(quarantine=materialize(broken, "quarantine"))
    t = transform_details(t)
    t = t.replaced(film=fill_film_details(t))
    t = t.replaced(film=materialize(rate_films(t), "loaded-films"))
    cast, crew = flatten_credits(t.landed_credits)
    t = t.replaced(
        staged_cast=materialize(cast, "staged-cast"), staged_crew=materialize(crew, "staged-crew")
    )
    wanted = materialize(people_to_fetch(t), "people-wanted")
    people = landed.person.join(wanted, "person_id", "left_semi")
    unknown = delete_keys(wanted, landed.person, ["person_id"])
    t = t.replaced(
        person=insert_if_absent(t.person, people, ["person_id"], [F.col("name")]),
        staged_cast=delete_keys(t.staged_cast, unknown, ["person_id"]),
        staged_crew=delete_keys(t.staged_crew, unknown, ["person_id"]),
    )
    t = move_credits(t)
    t, _ = populate_inventory(t, as_of, seed)
    # every changed table is counted for the report and then read again by the caller
    t = t.replaced(**{
        name: materialize(t[name], f"loaded-{name}")
        for name in ("inventory", "film_cast", "film_crew", "person", "production_company",
                     "film_production_company", "landed_detail")
    })
    return t, count_delta(before, table_counts(t))
