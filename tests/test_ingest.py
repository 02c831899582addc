import json

from pyspark.sql import functions as F

from kiosklake.operators import maintain
from kiosklake.plans import ingest
from kiosklake.sources import landing
from kiosklake.sources.tables import Tables
from tests.conftest import AS_OF, d, frame


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def us(certification, country="US"):
    return dict(iso_3166_1=country, certification=certification, note="", release_date="2000-01-01", release_type=3)


CREDITS = [
    dict(film_id=1, cast=json.dumps([dict(id=1, gender=1, character="first"), dict(id=1, gender=1, character="second"),
                                     dict(id=9, gender=0, character="new")]),
         crew=json.dumps([dict(id=4, gender=0, department="Directing", job="Director"),
                          dict(id=4, gender=0, department="Writing", job="Writer")])),
    dict(film_id=77, cast=json.dumps([dict(id=2, gender=1, character="unknown film")]), crew="[]"),
    dict(film_id=2, cast="{not json", crew=None),
]


def landed(spark, tables):
    company = lambda i, n: dict(id=i, name=n, origin_country="US")
    detail = [
        dict(film_id=2, budget=7, revenue=8, runtime=9, processed=False,
             production_companies=json.dumps([company(1, "A"), company(2, "B"), company(1, "A")])),
        dict(film_id=2, budget=5, revenue=8, runtime=9, processed=False, production_companies="[]"),
        dict(film_id=1, budget=70, revenue=80, runtime=90, processed=True, production_companies=json.dumps([company(3, "C")])),
        dict(film_id=77, budget=1, revenue=1, runtime=1, processed=False, production_companies=json.dumps([company(4, "D")])),
    ]
    releases = [
        dict(film_id=3, releases=json.dumps([us("R", "FR"), us(""), us("18+"), us(" PG-13 "), us("G")])),
        dict(film_id=1, releases=json.dumps([us("NC-17")])),
    ]
    return tables.replaced(
        landed_credits=frame(spark, "landed_credits", CREDITS),
        landed_detail=frame(spark, "landed_detail", detail),
        landed_releases=frame(spark, "landed_releases", releases),
        staged_cast=frame(spark, "staged_cast", []), staged_crew=frame(spark, "staged_crew", []),
    )


def test_landing_keeps_bad_lines_apart(spark, tmp_path):
    path = tmp_path / "credits.json"
    path.write_text('{"film_id": 1, "cast": "[]", "crew": "[]"}\n{broken\n{"cast": "[]"}\n')
    got = landing.read_landing(spark, str(path), "landed_credits").cache()
    assert rows(landing.accepted(got), "film_id") == [(1,)]
    assert landing.rejected(got).count() == 2


def test_credits_first_entry_wins(spark, tables):
    cast, crew = ingest.flatten_credits(landed(spark, tables).landed_credits)
    assert rows(cast, "film_id", "person_id", "film_character") == [
        (1, 1, "first"), (1, 9, "new"), (77, 2, "unknown film")]
    assert rows(crew, "film_id", "person_id", "job") == [(1, 4, "Director")]


def test_details_skip_unknown_and_processed(spark, tables):
    after = ingest.transform_details(landed(spark, tables))
    assert rows(after.landed_detail, "film_id") == [(1,), (2,), (2,)]
    assert rows(after.production_company, "production_company_id", "name") == [(1, "A"), (2, "B")]
    assert rows(after.film_production_company, "film_id", "production_company_id") == [(2, 1), (2, 2)]
    assert ingest.transform_details(after).production_company.count() == 2


def test_details_fill_only_films_lacking_one(spark, tables):
    films = {r.film_id: (r.budget, r.revenue, r.runtime) for r in ingest.fill_film_details(landed(spark, tables)).collect()}
    assert films[1] == (10, 20, 100) and films[2] == (5, 8, 9) and films[3] == (None, None, None)


def test_rating_takes_first_known_us_certification(spark, tables):
    films = {r.film_id: r.rating for r in ingest.rate_films(landed(spark, tables)).collect()}
    assert films == {1: "PG", 2: "R", 3: "PG-13", 4: "G"}


def test_move_drops_unknown_films_and_keeps_existing(spark, tables):
    t = landed(spark, tables)
    cast, crew = ingest.flatten_credits(t.landed_credits)
    after = ingest.move_credits(t.replaced(staged_cast=cast, staged_crew=crew))
    got = {(r.film_id, r.person_id): r.film_character for r in after.film_cast.collect()}
    assert got[(1, 1)] == "c11" and got[(1, 9)] == "new" and (77, 2) not in got
    assert rows(after.staged_cast, "film_id") == [(1,), (1,)]


def test_eligibility(tables):
    got = ingest.eligible_films(tables.film)
    assert [r.film_id for r in got.collect()] == [1, 4]
    assert [r.film_id for r in ingest.eligible_films(tables.film, year=2023).collect()] == [4]
    assert [r.film_id for r in ingest.eligible_films(tables.film, since="2025-01-01").collect()] == [1]


def test_whole_load_reports_changes(spark, tables):
    source = landed(spark, tables)
    new = frame(spark, "film", [dict(film_id=50, title="Brand New", release_date=d("2025-06-01"), genre_ids=[1],
                                     popularity=500.0, vote_average=8.0, vote_count=50, original_language="en")])
    credits = frame(spark, "landed_credits", [dict(
        film_id=50, cast=json.dumps([dict(id=9, gender=1, character="hero"), dict(id=123, gender=1, character="nobody")]),
        crew=json.dumps([dict(id=1, gender=1, department="Directing", job="Director")]))])
    releases = frame(spark, "landed_releases", [dict(film_id=50, releases=json.dumps([us("PG")]))])
    offered = Tables({
        "film": tables.film.unionByName(new), "film_genre": tables.film_genre,
        "person": tables.person.unionByName(frame(spark, "person", [dict(person_id=9, name="Nia")])),
        "landed_credits": credits, "landed_releases": releases, "landed_detail": source.landed_detail,
    })
    after, report = ingest.load_catalog(source, offered, AS_OF)
    change = {r.label: r.delta for r in report.collect()}
    assert change["Films"] == 1 and change["People"] == 1 and change["Genres"] == 0
    assert change["Cast entries"] == 1 and change["Crew entries"] == 1  # person 123 is unknown
    assert change["Production companies"] == 2
    assert {r.film_id: r.rating for r in after.film.collect()}[50] == "PG"
    assert after.inventory.filter("film_id = 50").groupBy("store_id").count().count() == 3
    again, second = ingest.load_catalog(after, offered, AS_OF)
    assert all(r.delta == 0 for r in second.collect() if not r.label.startswith("Staging"))


def test_broken_documents_are_listed(spark):
    from kiosklake.sources.landing import unparsed
    from kiosklake.sources.schemas import CAST_DOC, CREW_DOC

    rows = [(1, "[]", "[{"), (2, None, None), (3, "no json", "[]")]
    landed = spark.createDataFrame(rows, "film_id long, film_cast string, film_crew string")
    got = unparsed(landed, "film_id", {"film_cast": CAST_DOC, "film_crew": CREW_DOC}).collect()
    assert sorted((r.film_id, r.column_name, r.document) for r in got) == [(1, "film_crew", "[{"), (3, "film_cast", "no json")]


def test_count_delta_names_labels_of_either_side(spark):
    from kiosklake.operators.maintain import count_delta

    before, after = ([("a", 2), ("b", 1)], [("b", 4), ("c", 3)])
    frames = [spark.createDataFrame(x, "label string, n long") for x in (before, after)]
    got = sorted(tuple(r) for r in count_delta(*frames).collect())
    assert got == [("a", 2, 0, -2), ("b", 1, 4, 3), ("c", 0, 3, 3)]


def test_quarantine_keeps_files_and_replays(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"film_id": 1, "cast": "[]", "crew": "[{"}\n{"film_id": 2, "cast": "[\n')
    (tmp_path / "b.json").write_text('{"cast": "[]"}\n{"film_id": 3, "cast": "[{\\"id\\": 5}]"}\n')
    got = landing.read_landing(spark, str(tmp_path), "landed_credits").cache()
    held = landing.quarantined(got, "landed_credits").cache()
    assert sorted((r.file_name, r.column_name or "", r.film_id or 0, r.document) for r in held.collect()) == [
        ("a.json", "", 0, '{"film_id": 2, "cast": "['), ("a.json", "crew", 1, "[{"), ("b.json", "", 0, '{"cast":"[]"}')]
    fine, still = landing.replayed(spark, held, "landed_credits")
    assert fine.count() == 0 and still.count() == 3
    mended = held.withColumn("document", F.when(F.col("column_name") == "crew", "[]").when(
        F.col("document").startswith('{"film_id": 2'), '{"film_id": 2, "cast": "[]"}').otherwise(F.col("document")))
    fine, still = landing.replayed(spark, mended, "landed_credits")
    assert rows(fine, "film_id", "cast", "crew") == [(1, None, "[]"), (2, "[]", None)] and still.count() == 1


def test_load_takes_eligible_films_and_keeps_broken_documents(spark, tables):
    source = landed(spark, tables)
    film = lambda i, **more: dict(dict(film_id=i, title=f"New {i}", release_date=d("2025-06-01"), genre_ids=[1],
                                       popularity=500.0, vote_average=8.0, vote_count=50, original_language="en"), **more)
    new = frame(spark, "film", [film(50), film(51), film(52, vote_count=3), film(53, original_language="fr"), film(54, rating="G")])
    releases = frame(spark, "landed_releases", [
        dict(film_id=50, releases=json.dumps([us("PG")])), dict(film_id=51, releases=json.dumps([us("R")])),
        dict(film_id=52, releases=json.dumps([us("PG")])), dict(film_id=54, releases="[{")])
    offered = Tables({
        "film": tables.film.unionByName(new), "film_genre": tables.film_genre, "person": tables.person,
        "landed_credits": frame(spark, "landed_credits", [dict(film_id=50, cast="{no", crew="[]")]),
        "landed_releases": releases, "landed_detail": source.landed_detail,
    })
    after, report = ingest.load_catalog(source, offered, AS_OF, rules=ingest.Eligibility())
    assert {r.film_id for r in after.film.collect()} - {r.film_id for r in tables.film.collect()} == {50, 54}
    assert rows(after.quarantine, "table_name", "column_name", "film_id") == [
        ("landed_credits", "cast", 50), ("landed_releases", "releases", 54)]
