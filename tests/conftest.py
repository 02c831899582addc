import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from kiosklake.session import prepare  # noqa: E402
from kiosklake.sources import seeds  # noqa: E402
from kiosklake.sources.schemas import SCHEMAS  # noqa: E402
from kiosklake.sources.tables import Tables  # noqa: E402

AS_OF = "2025-06-15 12:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("kiosklake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


def dt(text):
    return datetime.fromisoformat(text)


def d(text):
    return date.fromisoformat(text)


def money(text):
    return Decimal(text)


def frame(spark, name, rows):
    """Rows as dicts for a declared table; absent columns are NULL."""
    schema = SCHEMAS[name]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


# Store 1 and 2 are neighbours in one city; store 3 is far away and has no customers.
STORES = [
    dict(store_id=1, street_name="Main", road_ref="R1", phone="1", zip_code=10, lat=40.70, lng=-74.00),
    dict(store_id=2, street_name="Oak", road_ref="R2", phone="2", zip_code=10, lat=40.75, lng=-73.95),
    dict(store_id=3, street_name="Far", road_ref="R3", phone="3", zip_code=20, lat=34.00, lng=-118.20),
]
CUSTOMERS = [
    # rented lately, dormant, never rented, inactive, no position, two lost at once
    dict(customer_id=1, store_id=1, full_name="Ann", email="a@x", zip_code=10, activebool=True, lat=40.70, lng=-74.00),
    dict(customer_id=2, store_id=1, full_name="Bob", email="b@x", zip_code=10, activebool=True, lat=40.72, lng=-73.99),
    dict(customer_id=3, store_id=2, full_name="Cyd", email="c@x", zip_code=10, activebool=True, lat=40.76, lng=-73.96),
    dict(customer_id=4, store_id=2, full_name="Dan", email="d@x", zip_code=20, activebool=False, lat=40.70, lng=-74.01),
    dict(customer_id=5, store_id=1, full_name="Eve", email="e@x", zip_code=10, activebool=True),
    dict(customer_id=6, store_id=2, full_name="Fay", email="f@x", zip_code=10, activebool=True, lat=40.71, lng=-74.00),
]
FILMS = [
    dict(film_id=1, title="Star Night", overview="A star falls over the island", release_date=d("2025-05-01"),
         genre_ids=[1, 2, 2], rating="PG", popularity=150.0, vote_average=8.0, vote_count=200, runtime=100,
         budget=10, revenue=20, original_language="en"),
    dict(film_id=2, title="Old Island", overview="Nothing", release_date=d("1990-01-01"), genre_ids=[2, 99],
         rating="R", popularity=5.0, vote_average=6.0, vote_count=10, original_language="en"),
    dict(film_id=3, title="No Genre", overview=None, release_date=None, genre_ids=None, rating=None,
         popularity=None, vote_average=7.5, vote_count=30, original_language="fr"),
    dict(film_id=4, title="Empty Genre", overview="The star", release_date=d("2023-01-01"), genre_ids=[],
         rating="G", popularity=50.0, vote_average=5.5, vote_count=20, original_language="en"),
]
PEOPLE = [
    dict(person_id=1, name="Kim", popularity=1.0), dict(person_id=2, name="Kim", popularity=2.0),
    dict(person_id=3, name="Lee", popularity=None), dict(person_id=4, name="Max", popularity=3.0),
]
CAST = [
    dict(film_id=f, person_id=p, film_character=f"c{f}{p}")
    for f, people in {1: (1, 2, 3), 2: (1, 3), 3: (2, 3, 4), 4: (3, 4)}.items() for p in people
]
CREW = [
    dict(film_id=1, person_id=4, department="Directing", job="Director"),
    dict(film_id=2, person_id=4, department="Directing", job="Director"),
    dict(film_id=4, person_id=1, department="Writing", job="Writer"),
]
INVENTORY = [
    dict(inventory_id=11, film_id=1, store_id=1, status_id=1), dict(inventory_id=12, film_id=1, store_id=1, status_id=1),
    dict(inventory_id=13, film_id=2, store_id=2, status_id=1), dict(inventory_id=14, film_id=2, store_id=1, status_id=2),
    dict(inventory_id=15, film_id=4, store_id=2, status_id=3), dict(inventory_id=16, film_id=4, store_id=2, status_id=4),
    dict(inventory_id=17, film_id=2, store_id=3, status_id=1), dict(inventory_id=18, film_id=4, store_id=1, status_id=1),
]
for row in INVENTORY:
    row["circulation_start"] = dt("2024-01-01 00:00:00")
    row["last_update"] = dt(f"2025-01-{row['inventory_id']:02d} 00:00:00")
RENTALS = [
    # closed after 1 s, exactly 24 h, and 24 h + 1 s
    dict(rental_id=1, inventory_id=11, customer_id=1, store_id=1, period_start=dt("2025-06-01 10:00:00"), period_end=dt("2025-06-01 10:00:01")),
    dict(rental_id=2, inventory_id=11, customer_id=1, store_id=1, period_start=dt("2025-06-02 10:00:00"), period_end=dt("2025-06-03 10:00:00")),
    dict(rental_id=3, inventory_id=13, customer_id=1, store_id=2, period_start=dt("2025-06-02 10:00:00"), period_end=dt("2025-06-03 10:00:01")),
    # dormant customer, paid twice
    dict(rental_id=4, inventory_id=12, customer_id=2, store_id=1, period_start=dt("2024-06-01 00:00:00"), period_end=dt("2024-06-02 00:00:00")),
    # open: recent, lost (two of one customer), and on a disc not in circulation
    dict(rental_id=5, inventory_id=18, customer_id=1, store_id=1, period_start=dt("2025-06-14 00:00:00")),
    dict(rental_id=6, inventory_id=13, customer_id=6, store_id=2, period_start=dt("2025-04-01 00:00:00")),
    dict(rental_id=7, inventory_id=17, customer_id=6, store_id=3, period_start=dt("2025-04-02 00:00:00")),
    dict(rental_id=8, inventory_id=14, customer_id=4, store_id=1, period_start=dt("2025-03-01 00:00:00")),
]
PAYMENTS = [
    dict(payment_id=1, customer_id=2, rental_id=4, amount=money("1.99"), payment_date=dt("2024-06-02 00:00:00")),
    dict(payment_id=2, customer_id=2, rental_id=4, amount=money("5.00"), payment_date=dt("2024-06-03 00:00:00")),
    dict(payment_id=3, customer_id=1, rental_id=2, amount=money("1.99"), payment_date=dt("2025-06-03 10:00:00")),
]


@pytest.fixture(scope="session")
def tables(spark):
    rows = dict(
        store=STORES, customer=CUSTOMERS, film=FILMS, person=PEOPLE, film_cast=CAST, film_crew=CREW,
        inventory=INVENTORY, rental=RENTALS, payment=PAYMENTS,
        film_genre=[dict(genre_id=1, name="Drama"), dict(genre_id=2, name="Action"), dict(genre_id=3, name="Unused")],
        zip_code_info=[dict(zip_code=10, city="Town", state_id="NY", lat=40.71, lng=-74.0),
                       dict(zip_code=20, city="West", state_id="CA", lat=34.0, lng=-118.2)],
        customer_status_log=[], holiday=[dict(id=1, holiday_name="June", holiday_date=d("2025-06-02")),
                                         dict(id=2, holiday_name="July", holiday_date=d("2025-07-04"))],
        production_company=[], film_production_company=[],
    )
    made = {name: frame(spark, name, value) for name, value in rows.items()}
    return Tables({**made, "pricing": seeds.pricing(spark), "inventory_status": seeds.inventory_status(spark)})
