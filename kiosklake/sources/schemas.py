"""Declared schemas, keys and references. Times are UTC wall-clock (TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import types as T

_DDL = {
    "customer": (
        "customer_id bigint, store_id bigint, full_name string, email string, phone string, "
        "zip_code int, activebool boolean, create_date date, lat double, lng double, "
        "last_update timestamp_ntz"
    ),
    "customer_status_log": (
        "log_id bigint, customer_id bigint, status_date timestamp_ntz, status string, "
        "reason_code string, notes string, rental_id bigint"
    ),
    "film": (
        "film_id bigint, title string, overview string, release_date date, genre_ids array<int>, "
        "original_language string, rating string, popularity float, vote_count int, "
        "vote_average float, budget bigint, revenue bigint, runtime int"
    ),
    "film_genre": "genre_id int, name string",
    "film_cast": "film_id bigint, person_id bigint, film_character string",
    "film_crew": "film_id bigint, person_id bigint, department string, job string",
    "film_production_company": "film_id bigint, production_company_id bigint",
    "production_company": "production_company_id bigint, name string",
    "person": (
        "person_id bigint, name string, also_known_as array<string>, birth_date date, "
        "death_date date, gender int, popularity float, imdb_id string, biography string, "
        "place_of_birth string"
    ),
    "store": (
        "store_id bigint, street_name string, road_ref string, phone string, zip_code int, "
        "lat double, lng double"
    ),
    "zip_code_info": (
        "zip_code int, city string, state_id string, population int, density float, "
        "lat double, lng double"
    ),
    "inventory": (
        "inventory_id bigint, film_id bigint, store_id bigint, status_id int, "
        "circulation_start timestamp_ntz, last_update timestamp_ntz"
    ),
    "inventory_status": "status_id int, status_code string, description string, display_order int",
    "rental": (
        "rental_id bigint, period_start timestamp_ntz, period_end timestamp_ntz, "
        "inventory_id bigint, customer_id bigint, store_id bigint, last_update timestamp_ntz"
    ),
    # payments per store, month and customer, worked out from payment and rental
    "revenue_part": (
        "store_id bigint, revenue_month timestamp_ntz, customer_id bigint, payments bigint, amount decimal(24,2)"
    ),
    "payment": (
        "payment_id bigint, customer_id bigint, rental_id bigint, amount decimal(12,2), "
        "payment_date timestamp_ntz"
    ),
    "pricing": "pricing_key string, pricing_value decimal(10,2), description string, effective_date date",
    "holiday": "id bigint, holiday_name string, is_paid_time_off boolean, holiday_date date",
    "release_type": "release_type_id int, name string",
    "language": "language_id int, name string, last_update timestamp_ntz",
    "staff": (
        "staff_id bigint, first_name string, last_name string, email string, store_id bigint, "
        "active boolean, username string, picture binary, last_update timestamp_ntz"
    ),
    # landing tables: documents stay JSON text, their shapes are below
    "landed_credits": "film_id bigint, cast string, crew string",
    "landed_detail": (
        "film_id bigint, budget bigint, revenue bigint, runtime int, "
        "production_companies string, processed boolean"
    ),
    "landed_releases": "film_id bigint, releases string",
    # landed lines and columns that could not be read
    "quarantine": "table_name string, file_name string, column_name string, film_id bigint, document string",
    "staged_cast": "film_id bigint, person_id bigint, film_character string",
    "staged_crew": "film_id bigint, person_id bigint, department string, job string",
}

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(12,2)": T.DecimalType(12, 2),
    "decimal(24,2)": T.DecimalType(24, 2),
    "array<int>": T.ArrayType(T.IntegerType()),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(ddl: str) -> T.StructType:
    """Built without a session, so schemas can be imported anywhere."""
    columns = (column.split(" ") for column in ddl.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


SCHEMAS: dict[str, T.StructType] = {name: _schema(ddl) for name, ddl in _DDL.items()}

# Shapes of the landed JSON arrays.
CAST_DOC = "array<struct<id:bigint,gender:int,character:string>>"
CREW_DOC = "array<struct<id:bigint,gender:int,department:string,job:string>>"
COMPANY_DOC = "array<struct<id:bigint,name:string,origin_country:string>>"
RELEASE_DOC = (
    "array<struct<iso_3166_1:string,certification:string,note:string,"
    "release_date:string,release_type:int>>"
)

#: JSON text columns of the landing tables, with the shape of their arrays.
DOCUMENTS: dict[str, dict[str, str]] = {
    "landed_credits": {"cast": CAST_DOC, "crew": CREW_DOC},
    "landed_detail": {"production_companies": COMPANY_DOC},
    "landed_releases": {"releases": RELEASE_DOC},
}

KEYS: dict[str, list[str]] = {
    "customer": ["customer_id"],
    "customer_status_log": ["log_id"],
    "film": ["film_id"],
    "film_genre": ["genre_id"],
    "film_cast": ["film_id", "person_id"],
    "film_crew": ["film_id", "person_id"],
    "film_production_company": ["film_id", "production_company_id"],
    "production_company": ["production_company_id"],
    "person": ["person_id"],
    "store": ["store_id"],
    "zip_code_info": ["zip_code"],
    "inventory": ["inventory_id"],
    "inventory_status": ["status_id"],
    "rental": ["rental_id"],
    "payment": ["payment_date", "payment_id"],
    "revenue_part": ["store_id", "revenue_month", "customer_id"],
    "pricing": ["pricing_key"],
}

# (child table, column, parent table, parent key)
REFERENCES: list[tuple[str, str, str, str]] = [
    ("customer", "store_id", "store", "store_id"),
    ("film_cast", "film_id", "film", "film_id"),
    ("film_cast", "person_id", "person", "person_id"),
    ("film_crew", "film_id", "film", "film_id"),
    ("film_crew", "person_id", "person", "person_id"),
    ("inventory", "film_id", "film", "film_id"),
    ("inventory", "store_id", "store", "store_id"),
    ("inventory", "status_id", "inventory_status", "status_id"),
    ("rental", "inventory_id", "inventory", "inventory_id"),
    ("rental", "customer_id", "customer", "customer_id"),
    ("rental", "store_id", "store", "store_id"),
    ("payment", "customer_id", "customer", "customer_id"),
    ("payment", "rental_id", "rental", "rental_id"),
]
