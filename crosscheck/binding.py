"""The rental domain derived from the given star-schema tables, on Spark.

Each table is a cheap projection of the given tables (one aggregation for discs
and cast), so every registered query works on whole inputs and grows with them.
``crosscheck/binding_sql.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from kiosklake.operators.maintain import signup_backfill
from kiosklake.plans.ingest import flatten_credits
from kiosklake.sources import seeds
from kiosklake.sources.tables import Tables

# Disc id = film id * DISC_BASE + first store id; a film has DISCS of them.
DISC_BASE, DISCS = 1_000_000_000, 4
AS_OF = "2001-06-01 00:00:00"
GIVEN = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def _open(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if (sf_dir, name) not in _SCHEMAS:
        _SCHEMAS[sf_dir, name] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[sf_dir, name]).parquet(path)


def given(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables({n: (lambda n=n: _open(spark, sf_dir, n)) for n in GIVEN})


def _day(start: str, offset) -> "F.Column":
    return F.date_add(F.lit(start).cast("date"), offset.cast("int"))


def _hours(start: str, offset) -> "F.Column":
    return F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(hours=offset.cast("int"))


def _spot(base: float, key, mul: int, mod: int, span: float):
    return F.lit(base) + ((key * mul) % mod).cast("double") * F.lit(span) / F.lit(float(mod))


def customer(g: Tables) -> DataFrame:
    k = F.col("c_custkey")
    stores = g.supplier.agg(F.count(F.lit(1)).alias("n")).scalar()
    placed = k % 50 != 13
    return g.customer.select(
        k.alias("customer_id"),
        (k % stores).alias("store_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
        F.concat(F.lit("555-"), k.cast("string")).alias("phone"),
        F.col("c_nationkey").alias("zip_code"),
        (k % 7 != 0).alias("activebool"),
        _day("1994-01-01", k % 365).alias("create_date"),
        F.when(placed, _spot(40.0, k, 41, 997, 4.0)).alias("lat"),
        F.when(placed, _spot(-79.0, k, 59, 991, 6.0)).alias("lng"),
        F.lit("2000-01-01").cast("timestamp_ntz").alias("last_update"),
    )


def customer_status_log(g: Tables) -> DataFrame:
    """The signup entries of all customers."""
    return signup_backfill(customer(g)).select(
        (F.col("customer_id") + 1).alias("log_id"), "*"
    )


def store(g: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return g.supplier.select(
        k.alias("store_id"),
        F.col("s_name").alias("street_name"),
        F.concat(F.lit("Route "), (k % 50).cast("string")).alias("road_ref"),
        F.concat(F.lit("556-"), k.cast("string")).alias("phone"),
        F.col("s_nationkey").alias("zip_code"),
        _spot(40.0, k, 37, 97, 4.0).alias("lat"),
        _spot(-79.0, k, 53, 89, 6.0).alias("lng"),
    )


def zip_code_info(g: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    return g.nation.join(g.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        k.alias("zip_code"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state_id"),
        (k * 1000 + 500).alias("population"),
        (k.cast("float") + F.lit(0.5).cast("float")).alias("density"),
        _spot(40.0, k, 7, 25, 4.0).alias("lat"),
        _spot(-79.0, k, 11, 25, 6.0).alias("lng"),
    )


def film(g: Tables) -> DataFrame:
    k = F.col("p_partkey")
    ratings = ["G", "PG", "PG-13", "R", "NC-17", "NR"]
    rating = F.when(k % 7 < 6, F.element_at(F.array(*map(F.lit, ratings)), (k % 7 + 1).cast("int")))
    return g.part.select(
        k.alias("film_id"),
        F.concat("p_name", F.lit(" "), k.cast("string")).alias("title"),
        F.concat_ws(" ", "p_type", "p_brand", "p_name").alias("overview"),
        F.when(k % 61 != 7, _day("1993-01-01", k % 3000)).alias("release_date"),
        F.when(k % 83 == 3, F.lit(None).cast("array<int>"))
        .when(k % 83 == 4, F.array().cast("array<int>"))
        .otherwise(F.array((k % 25).cast("int"), ((k * 7 + 3) % 27).cast("int")))
        .alias("genre_ids"),
        F.when(k % 5 == 0, F.lit("fr")).otherwise(F.lit("en")).alias("original_language"),
        rating.alias("rating"),
        F.when(k % 97 != 5, ((k * 13 % 6000).cast("double") / 10.0).cast("float")).alias("popularity"),
        (k * 11 % 500).cast("int").alias("vote_count"),
        ((k * 17 % 100).cast("double") / 10.0).cast("float").alias("vote_average"),
        F.when(k % 3 != 0, k * 7919 % 200000000).alias("budget"),
        F.when(k % 3 != 1, k * 104729 % 900000000).alias("revenue"),
        F.when(k % 3 != 2, F.col("p_size") + 80).alias("runtime"),
    )


def film_genre(g: Tables) -> DataFrame:
    names = g.nation.select(F.col("n_nationkey").alias("genre_id"), F.col("n_name").alias("name"))
    # one name borne by two ids
    return names.unionByName(names.filter("genre_id = 3").withColumn("genre_id", F.lit(25).cast(names.schema[0].dataType)))


def person(g: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    # keys ending in 9 share the previous person's name
    named = F.when(k % 10 == 9, k - 1).otherwise(k)
    return g.supplier.select(
        k.alias("person_id"),
        F.concat(F.lit("Actor "), named.cast("string")).alias("name"),
        F.array(F.col("s_name")).alias("also_known_as"),
        F.when(k % 13 != 0, F.col("s_acctbal").cast("float")).alias("popularity"),
    )


def _film_person(g: Tables) -> DataFrame:
    # the least flag by its place beside A and N: a number is grouped by hashing, a text only by sorting
    flag = F.col("l_returnflag")
    place = F.when(flag < "A", 0).when(flag == "A", 1).when(flag < "N", 2).when(flag == "N", 3).when(flag > "N", 4)
    return g.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.min(place).alias("place"))


def film_cast(g: Tables) -> DataFrame:
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    return g.lineitem.select("l_partkey", "l_suppkey").distinct().select(
        p.alias("film_id"),
        s.alias("person_id"),
        F.concat(F.lit("Role "), ((p + s) % 50).cast("string")).alias("film_character"),
    )


def film_crew(g: Tables) -> DataFrame:
    place = F.col("place")
    return _film_person(g).select(
        F.col("l_partkey").alias("film_id"),
        F.col("l_suppkey").alias("person_id"),
        F.when(place == 1, "Directing").when(place == 3, "Writing").otherwise("Production")
        .alias("department"),
        F.when(place == 1, "Director").when(place == 3, "Writer").otherwise("Producer").alias("job"),
    )


def _lines(g: Tables) -> DataFrame:
    """Order lines as (order, film, copy): a part has four discs, and a line rents one of them."""
    return g.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("film_id"),
        (F.col("l_suppkey") % DISCS).alias("copy"), "l_extendedprice",
    )


def _at_store(g: Tables, copies: DataFrame) -> DataFrame:
    """Rows with the store of their disc."""
    stores = g.supplier.agg(F.count(F.lit(1)).alias("n")).scalar()
    return copies.withColumn("store_id", (F.col("film_id") * 7 + F.col("copy") * 13) % stores)


def inventory(g: Tables) -> DataFrame:
    p, s = F.col("film_id"), F.col("store_id")
    mix = p * 7 + s
    return _at_store(g, _lines(g)).select("film_id", "store_id").distinct().select(
        (p * DISC_BASE + s).alias("inventory_id"),
        "film_id",
        "store_id",
        F.greatest(mix % 20 - 15, F.lit(1)).cast("int").alias("status_id"),
        _hours("1996-01-01", mix % 1500 * 24).alias("circulation_start"),
        _hours("2001-01-01", (p + s) % 120).alias("last_update"),
    )


def supplied_inventory(g: Tables) -> DataFrame:
    """A wider stock: a disc of a part at every supplier that an order line has it from."""
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    return g.lineitem.select("l_partkey", "l_suppkey").distinct().select(
        (p * DISC_BASE + s).alias("inventory_id"),
        p.alias("film_id"),
        s.alias("store_id"),
        F.greatest((p * 7 + s) % 20 - 15, F.lit(1)).cast("int").alias("status_id"),
    )


def supplied_out(g: Tables) -> DataFrame:
    """The open rentals of that stock, by the rule of ``rental``: one per line still out."""
    out = (F.col("o_orderstatus") == "O") & ((F.col("o_orderkey") + F.col("l_partkey")) % 8 == 0)
    lines = g.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey")
    return lines.join(g.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey").filter(out).select(
        (F.col("l_partkey") * DISC_BASE + F.col("l_suppkey")).alias("inventory_id"),
        F.lit(None).cast("timestamp_ntz").alias("period_end"),
    )


def _rented(g: Tables) -> DataFrame:
    """One row per order, part and disc, with its order; ``rental_id`` is unique."""
    keys = ["o_orderkey", "film_id", "copy"]
    # dealt by order once, for the grouping and the join alike; the store follows from the keys
    lines = _lines(g).repartition("o_orderkey").groupBy(*keys).agg(F.min("l_extendedprice").alias("price"))
    return _at_store(g, lines).join(g.orders, "o_orderkey").withColumn(
        "rental_id", F.col("o_orderkey") * DISC_BASE + F.col("film_id") * DISCS + F.col("copy")
    )


def rental(g: Tables) -> DataFrame:
    """One rental per order line; one in eight of the lines of orders with status O is still out."""
    k, start = F.col("o_orderkey"), F.col("o_orderdate")
    out = (F.col("o_orderstatus") == "O") & ((k + F.col("film_id")) % 8 == 0)
    end = F.when(~out, start + F.make_dt_interval(hours=(k % 62 + 10).cast("int")))
    return _rented(g).select(
        "rental_id",
        start.alias("period_start"),
        end.alias("period_end"),
        (F.col("film_id") * DISC_BASE + F.col("store_id")).alias("inventory_id"),
        F.col("o_custkey").alias("customer_id"),
        "store_id",
        F.coalesce(end, start).alias("last_update"),
    )


def payment(g: Tables) -> DataFrame:
    """One payment per rental of orders with status F, and a small second one for every eleventh order."""
    k = F.col("o_orderkey")
    paid = _rented(g).filter(F.col("o_orderstatus") == "F").withColumn(
        "part", F.explode(F.when(k % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )
    return paid.select(
        (F.col("rental_id") * 2 + F.col("part")).alias("payment_id"),
        F.col("o_custkey").alias("customer_id"),
        "rental_id",
        F.when(F.col("part") == 0, F.col("price")).otherwise(F.lit(1.99)).cast("decimal(12,2)").alias("amount"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(k % 62 + 10).cast("int")))
        .alias("payment_date"),
    )


# Yearly holidays as month * 100 + day.
HOLIDAYS = {101: "New Year", 704: "Independence Day", 1111: "Veterans Day", 1225: "Christmas"}


def holiday(g: Tables) -> DataFrame:
    day = F.col("holiday_date")
    code = F.month(day) * 100 + F.dayofmonth(day)
    days = g.orders.select(F.col("o_orderdate").cast("date").alias("holiday_date")).filter(
        code.isin(list(HOLIDAYS))
    )
    name = F.element_at(F.create_map(*[F.lit(x) for kv in HOLIDAYS.items() for x in kv]), code)
    return days.distinct().select(
        (F.year(day) * 10000 + code).cast("bigint").alias("id"),
        F.concat(name, F.lit(" "), F.year(day).cast("string")).alias("holiday_name"),
        F.lit(True).alias("is_paid_time_off"),
        day,
    )


def _obj(**fields) -> "F.Column":
    """A JSON object text from quoted-or-plain column values."""
    parts = []
    for i, (name, value) in enumerate(fields.items()):
        parts.append(F.lit(("{" if i == 0 else ",") + f'"{name}":'))
        parts.append(value.cast("string"))
    return F.concat(*parts, F.lit("}"))


def _text(value) -> "F.Column":
    return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))


def _array(*objects) -> "F.Column":
    return F.concat(F.lit("["), F.concat_ws(",", *objects), F.lit("]"))


def landed_credits(g: Tables) -> DataFrame:
    """One credits document per part: a repeated cast member and one unknown film in 40."""
    k = F.col("p_partkey")
    film_id = F.when(k % 40 == 0, k + DISC_BASE).otherwise(k)
    member = lambda i, role: _obj(id=(k * 3 + i) % 1000, gender=F.lit(i % 3), character=_text(role))
    worker = lambda i, dep, job: _obj(
        id=(k * 5 + i) % 1000, gender=F.lit(0), department=_text(F.lit(dep)), job=_text(F.lit(job))
    )
    role = F.concat(F.lit("Role "), (k % 9).cast("string"))
    return g.part.select(
        film_id.alias("film_id"),
        _array(member(1, role), member(2, F.lit("Guest")), member(1, F.lit("Again"))).alias("cast"),
        _array(worker(1, "Directing", "Director"), worker(1, "Writing", "Writer"),
               worker(7, "Sound", "Mixer")).alias("crew"),
    )


def staged_cast(g: Tables) -> DataFrame:
    return flatten_credits(landed_credits(g))[0]


def staged_crew(g: Tables) -> DataFrame:
    return flatten_credits(landed_credits(g))[1]


def landed_detail(g: Tables) -> DataFrame:
    k = F.col("p_partkey")
    company = lambda i: _obj(
        id=(k * i) % 300, name=_text(F.concat(F.lit("Company "), ((k * i) % 300).cast("string"))),
        origin_country=_text(F.lit("US")),
    )
    return g.part.select(
        F.when(k % 40 == 0, k + DISC_BASE).otherwise(k).alias("film_id"),
        (k * 31 % 100000).alias("budget"),
        (k * 37 % 100000).alias("revenue"),
        (k % 60 + 60).cast("int").alias("runtime"),
        _array(company(3), company(7), company(3)).alias("production_companies"),
        (k % 10 == 0).alias("processed"),
    )


def landed_releases(g: Tables) -> DataFrame:
    k = F.col("p_partkey")
    # Certifications seen in the documents; two of them are not ratings.
    seen = F.array(*map(F.lit, ["PG", " R ", "", "Unknown", "G"]))
    cert = lambda i: F.element_at(seen, ((k + i) % 5 + 1).cast("int"))
    release = lambda country, i: _obj(
        iso_3166_1=_text(F.lit(country)), certification=_text(cert(i)), note=_text(F.lit("")),
        release_date=_text(F.lit("2000-01-01")), release_type=F.lit(3),
    )
    return g.part.select(
        k.alias("film_id"),
        _array(release("FR", 0), release("US", 1), release("US", 2)).alias("releases"),
    )


def film_production_company(g: Tables) -> DataFrame:
    """Every sixth part already has its company linked."""
    k = F.col("p_partkey")
    return g.part.filter(k % 6 == 0).select(
        k.alias("film_id"), ((k * 3) % 300).alias("production_company_id")
    )


def production_company(g: Tables) -> DataFrame:
    k = F.col("n_nationkey").cast("bigint")
    return g.nation.select(
        k.alias("production_company_id"), F.concat(F.lit("Company "), k.cast("string")).alias("name")
    )


def documents_as_films(g: Tables) -> DataFrame:
    """Whole documents in the role of film texts, for text search."""
    d = F.col("doc_id")
    return g.documents.select(
        d.alias("film_id"),
        F.concat("source", F.lit(" "), d.cast("string")).alias("title"),
        F.col("text").alias("overview"),
        F.lit(None).cast("date").alias("release_date"),
        F.lit(None).cast("string").alias("rating"),
        (d * 13 % 6000).cast("float").alias("popularity"),
    )


_DERIVED = [
    customer, customer_status_log, store, zip_code_info, film, film_genre, person, film_cast, film_crew, inventory,
    rental, payment, holiday, landed_credits, landed_detail, landed_releases, staged_cast, staged_crew,
    film_production_company, production_company,
]


def domain(spark: SparkSession, sf_dir: str) -> Tables:
    """All domain tables over the given tables in ``sf_dir``."""
    g = given(spark, sf_dir)
    entries = {f.__name__: (lambda f=f: f(g)) for f in _DERIVED}
    entries["pricing"] = lambda: seeds.pricing(spark)
    entries["inventory_status"] = lambda: seeds.inventory_status(spark)
    return Tables(entries)
