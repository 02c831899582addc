"""Catalog ingestion P14 to P19, and eligibility and work lists."""

from pyspark.sql import functions as F

from crosscheck.binding import AS_OF as NOW
from crosscheck.binding_sql import BASE, sql
from crosscheck.registry import register
from kiosklake.plans import ingest

FILM_ID = f"CASE WHEN p_partkey % 40 = 0 THEN p_partkey + {BASE} ELSE p_partkey END"
# the documents hold their first entry for a person before the repeated one
CAST = f"""SELECT {FILM_ID} AS film_id, (p_partkey * 3 + i) % 1000 AS person_id,
    CASE i WHEN 1 THEN 'Role ' || (p_partkey % 9) ELSE 'Guest' END AS film_character
    FROM part, (SELECT unnest([1, 2]) AS i)"""
CREW = f"""SELECT {FILM_ID} AS film_id, (p_partkey * 5 + i) % 1000 AS person_id,
    CASE i WHEN 1 THEN 'Directing' ELSE 'Sound' END AS department, CASE i WHEN 1 THEN 'Director' ELSE 'Mixer' END AS job
    FROM part, (SELECT unnest([1, 7]) AS i)"""
register("p14_flatten_cast", lambda t: ingest.flatten_credits(t.landed_credits)[0], sql(CAST))
register("p14_flatten_crew", lambda t: ingest.flatten_credits(t.landed_credits)[1], sql(CREW))

FRESH = """SELECT DISTINCT d.film_id, (d.k * i) % 300 AS id FROM d_detail d, (SELECT unnest([3, 7]) AS i)
    WHERE NOT d.processed AND d.film_id IN (SELECT film_id FROM d_film) AND d.film_id NOT IN (SELECT film_id FROM d_film_company)"""
register("p15_companies", lambda t: ingest.transform_details(t).production_company, sql("""
    SELECT production_company_id, name FROM d_company UNION ALL
    SELECT DISTINCT id, 'Company ' || id FROM fresh WHERE id NOT IN (SELECT production_company_id FROM d_company)""", fresh=FRESH))
register("p15_film_companies", lambda t: ingest.transform_details(t).film_production_company,
         sql("SELECT film_id, production_company_id FROM d_film_company UNION ALL SELECT film_id, id FROM fresh", fresh=FRESH))
register("p15_known_details", lambda t: ingest.transform_details(t).landed_detail.select("film_id", "budget", "processed"),
         sql("SELECT film_id, budget, processed FROM d_detail WHERE film_id IN (SELECT film_id FROM d_film)"))

register("p16_fill_film_details", lambda t: ingest.fill_film_details(t).select("film_id", "budget", "revenue", "runtime"), sql("""
    SELECT f.film_id, CASE WHEN h THEN d.budget ELSE f.budget END AS budget, CASE WHEN h THEN d.revenue ELSE f.revenue END AS revenue,
    CASE WHEN h THEN d.runtime ELSE f.runtime END::int AS runtime
    FROM (SELECT *, (budget IS NULL OR revenue IS NULL OR runtime IS NULL) AND film_id IN (SELECT film_id FROM d_detail) AS h FROM d_film) f
    LEFT JOIN d_detail d ON d.film_id = f.film_id"""))
SEEN = "['PG', 'R', '', 'Unknown', 'G']"
register("p17_rate_films", lambda t: ingest.rate_films(t).select("film_id", "rating"), sql(f"""
    SELECT film_id, coalesce(rating, CASE WHEN a IN ('G', 'PG', 'PG-13', 'R', 'NC-17', 'NR') THEN a
        WHEN b IN ('G', 'PG', 'PG-13', 'R', 'NC-17', 'NR') THEN b END) AS rating
    FROM (SELECT *, {SEEN}[(film_id + 1) % 5 + 1] AS a, {SEEN}[(film_id + 2) % 5 + 1] AS b FROM d_film)"""))
MOVED_CAST = """SELECT film_id, person_id, film_character FROM d_cast UNION ALL SELECT film_id, person_id, film_character FROM staged s
    WHERE film_id IN (SELECT film_id FROM d_film) AND NOT EXISTS (SELECT 1 FROM d_cast c WHERE c.film_id = s.film_id AND c.person_id = s.person_id)"""
register("p18_move_cast", lambda t: ingest.move_credits(t).film_cast, sql(MOVED_CAST, staged=CAST))
register("p18_move_crew", lambda t: ingest.move_credits(t).film_crew,
         sql(MOVED_CAST.replace("d_cast", "d_crew").replace("film_character", "department, job"), staged=CREW))


def _load(t):
    older = t.film.filter(F.col("release_date") <= F.lit("1996-01-01").cast("date"))
    return ingest.load_catalog(t.replaced(film=older), t, NOW)


def _loaded_films(t):
    """Films after the load with their figures, ratings, companies, cast and crew."""
    after, _ = _load(t)
    out = after.film.select("film_id", "budget", "revenue", "runtime", "rating")
    for table in ("film_cast", "film_crew", "film_production_company"):
        n = after[table].groupBy("film_id").agg(F.count(F.lit(1)).alias(f"n_{table}"))
        out = out.join(n, "film_id", "left")
    return out.na.fill(0, [c for c in out.columns if c.startswith("n_")])


ROW = lambda label, before, after: f"SELECT '{label}' AS label, {before} AS before_n, {after} AS after_n"
N = lambda table: f"(SELECT count(*) FROM {table})"
REPORT = " UNION ALL ".join([
    ROW("Films", N("older"), N("films")),
    ROW("People", N("d_person"), N("d_person")),
    ROW("Cast entries", N("d_cast"), f"{N('d_cast')} + {N('new_cast')}"),
    ROW("Crew entries", N("d_crew"), f"{N('d_crew')} + {N('new_crew')}"),
    ROW("Production companies", N("d_company"), f"{N('d_company')} + (SELECT count(DISTINCT id) FROM fresh "
        "WHERE id NOT IN (SELECT production_company_id FROM d_company))"),
    # every film of the given tables already has discs
    ROW("Inventory items", N("d_inventory"), N("d_inventory")),
    ROW("Genres", N("d_genre"), N("d_genre")),
    ROW("Staging: credits", N("part"), "(SELECT count(*) FROM found WHERE film_id % 40 <> 0)"),
    ROW("Staging: cast", N("raw_cast"), N("staged_cast_")),
    ROW("Staging: crew", N("raw_crew"), N("staged_crew_")),
    ROW("Staging: details", N("part"), N("details")),
    ROW("Staging: releases", N("part"), N("found")),
])
KNOWN = "film_id IN (SELECT film_id FROM found) AND person_id IN (SELECT person_id FROM d_person)"
LOAD_CTES = dict(
    older="SELECT * FROM d_film WHERE release_date <= DATE '1996-01-01'",
    found="SELECT * FROM d_film WHERE release_date >= (SELECT max(release_date) FROM older)",
    films="SELECT * FROM older UNION SELECT * FROM found",
    details="""SELECT * FROM d_detail WHERE film_id IN (SELECT film_id FROM films)
        AND film_id NOT IN (SELECT film_id FROM d_film_company)""",
    fresh="SELECT DISTINCT film_id, (k * i) % 300 AS id FROM details, (SELECT unnest([3, 7]) AS i) WHERE NOT processed",
    raw_cast=CAST, raw_crew=CREW,
    staged_cast_=f"SELECT * FROM raw_cast WHERE {KNOWN}", staged_crew_=f"SELECT * FROM raw_crew WHERE {KNOWN}",
    new_cast="SELECT film_id, person_id FROM staged_cast_ EXCEPT SELECT film_id, person_id FROM d_cast",
    new_crew="SELECT film_id, person_id FROM staged_crew_ EXCEPT SELECT film_id, person_id FROM d_crew",
)
register("p19_load_catalog", lambda t: _load(t)[1], sql(f"SELECT *, after_n - before_n AS delta FROM ({REPORT})", **LOAD_CTES))
MEMBERS = lambda old, new: f"(SELECT count(*) FROM {old} x WHERE x.film_id = f.film_id) + (SELECT count(*) FROM {new} x WHERE x.film_id = f.film_id)"
register("p19_loaded_films", _loaded_films, sql(f"""
    SELECT film_id, CASE WHEN h THEN d.budget ELSE f.budget END AS budget, CASE WHEN h THEN d.revenue ELSE f.revenue END AS revenue,
    CASE WHEN h THEN d.runtime ELSE f.runtime END::int AS runtime,
    coalesce(f.rating, CASE WHEN film_id NOT IN (SELECT film_id FROM found) THEN NULL
        WHEN a IN ('G', 'PG', 'PG-13', 'R', 'NC-17', 'NR') THEN a WHEN b IN ('G', 'PG', 'PG-13', 'R', 'NC-17', 'NR') THEN b END) AS rating,
    {MEMBERS('d_cast', 'new_cast')} AS n_film_cast, {MEMBERS('d_crew', 'new_crew')} AS n_film_crew,
    {MEMBERS('d_film_company', 'fresh')} AS n_film_production_company
    FROM (SELECT *, (budget IS NULL OR revenue IS NULL OR runtime IS NULL) AND film_id IN (SELECT film_id FROM details) AS h,
        {SEEN}[(film_id + 1) % 5 + 1] AS a, {SEEN}[(film_id + 2) % 5 + 1] AS b FROM films) f
    LEFT JOIN (SELECT film_id, budget, revenue, runtime FROM details) d USING (film_id)""", **LOAD_CTES))
ELIGIBLE = "vote_average >= 5.5::float AND vote_count >= 20 AND original_language = 'en' AND rating IN ('G', 'PG', 'PG-13')"
register("a11_eligible_films", lambda t: ingest.eligible_films(t.film).select("film_id", "title", "rating"),
         sql(f"SELECT film_id, title, rating FROM d_film WHERE {ELIGIBLE}"))
register("a11_eligible_films_of_year", lambda t: ingest.eligible_films(t.film, year=1995).select("film_id", "title"),
         sql(f"SELECT film_id, title FROM d_film WHERE {ELIGIBLE} AND year(release_date) = 1995"))
register("a12_films_without_detail", ingest.films_without_detail,
         sql("SELECT film_id FROM d_film WHERE film_id NOT IN (SELECT film_id FROM d_film_company)"))
register("a12_people_to_fetch", ingest.people_to_fetch, sql("""
    SELECT person_id FROM (SELECT person_id FROM c UNION SELECT person_id FROM w)
    WHERE person_id NOT IN (SELECT person_id FROM d_person)""", c=CAST, w=CREW))
