"""Single operators: table maintenance, checks, joins, aggregates, scalar functions, streams."""

from pyspark.sql import functions as F

from crosscheck import binding
from crosscheck.binding import AS_OF as NOW
from crosscheck.binding_sql import AS_OF, digest, draw, sql
from crosscheck.export import plain
from crosscheck.q_apps import CARD
from crosscheck.q_jobs import DUE, FEE, MAX_PAYMENT, SIGNUP, numbered
from crosscheck.registry import ORACLE, QUERIES, register
from kiosklake import session
from kiosklake.functions import numbers, periods, text
from kiosklake.operators import checks, maintain, membership, ranking
from kiosklake.plans import earlier, ingest, jobs
from kiosklake.sources import landing, tables
from kiosklake.sources.schemas import KEYS, REFERENCES, SCHEMAS
from kiosklake.streaming import billing, lost

# --- A: sources and maintenance ---

RENTAL = "SELECT rental_id, period_start, period_end, inventory_id, customer_id, store_id, last_update FROM d_rental"


def _landing_lines(g):
    """One line a part: some cut off, some without their key, some with a broken text column."""
    k = F.col("p_partkey")
    text_of = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return g.part.select(
        F.when(k % 37 == 0, text_of('{"film_id":', k, ',"cast":"['))
        .when(k % 41 == 0, F.lit('{"cast":"[]","crew":"[]"}'))
        .when(k % 43 == 0, text_of('{"film_id":', k, ',"cast":"[{broken","crew":"[]"}'))
        .otherwise(text_of('{"film_id":', k, ',"cast":"[{\\"id\\":', k * 3 % 1000, '},{\\"id\\":7}]","crew":"[]"}'))
        .alias("value")
    )


def _landed_files(spark, sf_dir):
    session.with_local_dir(session.prepare(spark))
    path = session.scratch_path(spark, "landing")
    _landing_lines(binding.given(spark, sf_dir)).write.text(path)
    return landing.read_landing(spark, path, "landed_credits")


QUERIES["a2_landed_credits"] = lambda spark, sf_dir: plain(
    ingest.flatten_credits(landing.accepted(_landed_files(spark, sf_dir)))[0].select("film_id", "person_id"))
ORACLE["a2_landed_credits"] = """
    SELECT DISTINCT p_partkey AS film_id, unnest([p_partkey * 3 % 1000, 7]) AS person_id FROM part
    WHERE p_partkey % 37 <> 0 AND p_partkey % 41 <> 0 AND p_partkey % 43 <> 0"""
QUERIES["a2_quarantine"] = lambda spark, sf_dir: plain(
    landing.quarantined(_landed_files(spark, sf_dir), "landed_credits").drop("file_name"))
ORACLE["a2_quarantine"] = """
    SELECT 'landed_credits' AS table_name, NULL::varchar AS column_name, NULL::bigint AS film_id,
        '{"film_id":' || p_partkey || ',"cast":"[' AS document FROM part WHERE p_partkey % 37 = 0
    UNION ALL SELECT 'landed_credits', NULL, NULL, '{"cast":"[]","crew":"[]"}' FROM part WHERE p_partkey % 37 <> 0 AND p_partkey % 41 = 0
    UNION ALL SELECT 'landed_credits', 'cast', p_partkey, '[{broken' FROM part
        WHERE p_partkey % 37 <> 0 AND p_partkey % 41 <> 0 AND p_partkey % 43 = 0"""


def _loaded(t):
    """Every table written as a snapshot and opened again by its declared schema."""
    spark = t.payment.sparkSession
    root = session.scratch_path(spark, "snapshot")
    tables.write_snapshot({n: t[n] for n in SCHEMAS if n in t}, root, 1)
    return tables.read_snapshot(spark, root)


register("a1_typed_rentals", lambda t: _loaded(t).rental, sql(RENTAL))


def _events(spark, sf_dir):
    shape = "struct<k:int,_corrupt_record:string>"
    doc = F.from_json("props", shape, {"mode": "PERMISSIVE"})
    return plain(binding.given(session.prepare(spark), sf_dir).events.select("event_id", doc["k"].alias("k")))


QUERIES["a2_event_documents"] = _events
ORACLE["a2_event_documents"] = "SELECT event_id, (props->>'k')::int AS k FROM events"


PAYMENT = "payment_id, customer_id, rental_id, amount::double AS amount, payment_date"


_key = lambda n: KEYS.get(n, ["id"])[-1]


def _roundtrip(t):
    """Row counts of every table after the round trip, and one of its columns added up."""
    back = _loaded(t)
    frames = [back[n].agg(F.lit(n).alias("label"), F.count(F.lit(1)).alias("n"), F.sum(F.col(_key(n)).cast("bigint") % 1_000_003).alias("key_sum"))
              for n in sorted(back) if n in _DERIVED_SQL]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


#: Written tables with a derivation in SQL, and what it is called there.
_DERIVED_SQL = {n: n for n in ("customer", "store", "film", "inventory", "rental", "payment", "holiday")} | {
    "film_genre": "genre", "person": "person", "film_cast": "cast", "film_crew": "crew", "zip_code_info": "zip",
    "production_company": "company", "film_production_company": "film_company", "inventory_status": "status"}
register("a3_snapshot_roundtrip", _roundtrip, sql(" UNION ALL ".join(
    f"SELECT '{n}' AS label, count(*) AS n, sum({_key(n)} % 1000003)::bigint AS key_sum FROM d_{d}" for n, d in sorted(_DERIVED_SQL.items()))))
register("a3_restored_payments", lambda t: _loaded(t).payment, sql(f"SELECT {PAYMENT} FROM d_payment"))
register("a4_append_payments", lambda t: jobs.insert_payments(t).tables.payment, sql(
    f"SELECT {PAYMENT} FROM d_payment UNION ALL SELECT {PAYMENT} FROM "
    f"({numbered('payment_id', MAX_PAYMENT, 'rental_id', DUE)})"))


def _people_from_customers(t):
    return t.customer.select(
        F.col("customer_id").alias("person_id"), F.upper("full_name").alias("name"),
        F.col("zip_code").cast("float").alias("popularity"),
    )


PEOPLE = "SELECT customer_id AS person_id, upper(full_name) AS name, zip_code::float AS popularity FROM d_customer"
register("a5_insert_if_absent", lambda t: maintain.insert_if_absent(
    t.person.select("person_id", "name", "popularity"), _people_from_customers(t), ["person_id"], [F.col("name")]), sql(f"""
    SELECT person_id, name, popularity::double AS popularity FROM d_person UNION ALL
    SELECT person_id, name, popularity::double FROM ({PEOPLE}) WHERE person_id NOT IN (SELECT person_id FROM d_person)"""))
register("a6_upsert", lambda t: maintain.upsert(
    t.person.select("person_id", "name", "popularity"), _people_from_customers(t), ["person_id"], ["name"]), sql(f"""
    SELECT coalesce(p.person_id, n.person_id) AS person_id, CASE WHEN n.person_id IS NOT NULL THEN n.name ELSE p.name END AS name,
    CASE WHEN p.person_id IS NOT NULL THEN p.popularity ELSE n.popularity END::double AS popularity
    FROM d_person p FULL JOIN ({PEOPLE}) n ON n.person_id = p.person_id"""))
register("a8_delete_by_join", lambda t: maintain.delete_keys(t.rental, t.payment.select("rental_id"), ["rental_id"]),
         sql(f"{RENTAL} WHERE rental_id NOT IN (SELECT rental_id FROM d_payment)"))
register("a9_emptied", lambda t: maintain.row_counts({"rental": maintain.emptied(t.rental), "kept": t.rental}),
         sql("SELECT 'rental' AS label, 0::bigint AS n UNION ALL SELECT 'kept', count(*) FROM d_rental"))
register("a10_newer_than", lambda t: maintain.newer_than(
    t.film.select("film_id", "release_date"), "release_date", t.customer.select(F.col("create_date").alias("release_date"))), sql("""
    SELECT film_id, release_date::varchar AS release_date FROM d_film
    WHERE release_date >= (SELECT max(create_date) FROM d_customer)"""))


def _tampered(t):
    return t.inventory.withColumn(
        "circulation_start",
        F.when(F.col("status_id") == 4, periods.moment("2000-01-01")).otherwise(F.col("circulation_start")),
    )


register("a14_protect_column", lambda t: maintain.protect_column(
    _tampered(t), t.inventory, "inventory_id", "circulation_start")[0].select("inventory_id", "circulation_start"),
    sql("SELECT inventory_id, circulation_start FROM d_inventory"))
register("a14_refused_changes", lambda t: maintain.protect_column(
    _tampered(t), t.inventory, "inventory_id", "circulation_start")[1], sql("""
    SELECT inventory_id, circulation_start AS kept, TIMESTAMP '2000-01-01' AS refused FROM d_inventory
    WHERE status_id = 4 AND circulation_start <> TIMESTAMP '2000-01-01'"""))

_CHECKED = ["customer", "film", "film_cast", "inventory", "rental", "payment", "store"]


def _integrity(t):
    found = {f"key {n}": checks.duplicate_keys(t[n], KEYS[n]) for n in _CHECKED}
    found |= {f"ref {c}.{k}": checks.orphans(t[c], k, t[p], pk) for c, k, p, pk in REFERENCES if c in _CHECKED}
    found["domain film.rating"] = checks.outside(t.film, "rating", ("G", "PG", "PG-13"))
    found["domain film.year"] = checks.outside_years(t.film.withColumn("y", F.year("release_date")), "y")
    return checks.report(found)


SQL_NAME = {"film_cast": "d_cast", "inventory_status": "d_status", "person": "d_person"}
name_of = lambda n: SQL_NAME.get(n, f"d_{n}")
INTEGRITY = [f"SELECT 'key {n}' AS check_name, count(*) AS violations FROM (SELECT 1 FROM {name_of(n)} "
             f"GROUP BY {', '.join(KEYS[n])} HAVING count(*) > 1)" for n in _CHECKED]
INTEGRITY += [f"SELECT 'ref {c}.{k}', count(*) FROM {name_of(c)} x WHERE x.{k} IS NOT NULL AND NOT EXISTS "
              f"(SELECT 1 FROM {name_of(p)} y WHERE y.{pk} = x.{k})" for c, k, p, pk in REFERENCES if c in _CHECKED]
INTEGRITY += ["SELECT 'domain film.rating', count(*) FROM d_film WHERE rating NOT IN ('G', 'PG', 'PG-13')",
              "SELECT 'domain film.year', count(*) FROM d_film WHERE year(release_date) NOT BETWEEN 1901 AND 2155"]
register("a15_integrity_report", _integrity, sql(" UNION ALL ".join(INTEGRITY)))
register("a16_signup_backfill", lambda t: maintain.signup_backfill(t.customer),
         sql(SIGNUP.replace("customer_id + 1 AS log_id, ", "")))

# --- B, C, D, G, H: predicates, joins, aggregates, functions ---

register("b9_busy_discs", lambda t: t.rental.filter(
    periods.overlaps(F.col("period_start"), F.col("period_end"), "1999-03-01", "1999-03-08")).select("rental_id"), sql("""
    SELECT rental_id FROM d_rental WHERE period_start < TIMESTAMP '1999-03-08' AND (period_end IS NULL OR period_end > TIMESTAMP '1999-03-01')"""))
register("b10_held_at", lambda t: t.rental.filter(
    periods.contains(F.col("period_start"), F.col("period_end"), "1999-03-01 12:00:00")).select("rental_id"), sql("""
    SELECT rental_id FROM d_rental WHERE period_start <= TIMESTAMP '1999-03-01 12:00:00'
    AND (period_end IS NULL OR TIMESTAMP '1999-03-01 12:00:00' < period_end)"""))
_budgets = lambda t: t.film.select("film_id", "budget")
register("b11_not_in", lambda t: membership.not_in(_budgets(t), "budget", t.landed_detail.select("budget")),
         sql("SELECT film_id, budget FROM d_film WHERE budget NOT IN (SELECT budget FROM d_detail)"))


def _not_in_counts(t):
    """How many budgets are in none of the rows, by what the other side holds."""
    sides = {"with nulls": t.film.select(F.col("revenue").alias("budget")), "no rows": maintain.emptied(t.film).select("budget"),
             "no nulls": t.landed_detail.select("budget")}
    return maintain.row_counts({name: membership.not_in(_budgets(t), "budget", rows) for name, rows in sides.items()})


register("b11_not_in_with_null", _not_in_counts, sql("""
    SELECT 'with nulls' AS label, count(*) AS n FROM d_film WHERE budget NOT IN (SELECT revenue FROM d_film)
    UNION ALL SELECT 'no rows', count(*) FROM d_film WHERE budget NOT IN (SELECT budget FROM d_film WHERE false)
    UNION ALL SELECT 'no nulls', count(*) FROM d_film WHERE budget NOT IN (SELECT budget FROM d_detail)"""))
register("c9_random_rental_per_customer", lambda t: ranking.pick_random(
    t.rental.select("customer_id", "rental_id"), ["customer_id"], "one", ["rental_id"]), sql(f"""
    SELECT customer_id, rental_id FROM d_rental QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY
        {digest('one', 'customer_id', 'rental_id')}, rental_id) = 1"""))
register("c10_two_random_discs_per_store", lambda t: ranking.first_two(
    t.inventory.select("store_id", "inventory_id"), ["store_id"], "two", "inventory_id", "discs"), sql(f"""
    SELECT store_id, string_agg(inventory_id::varchar, ',' ORDER BY rn) AS discs FROM (SELECT store_id, inventory_id,
        row_number() OVER (PARTITION BY store_id ORDER BY {digest('two', 'store_id', 'inventory_id')}, inventory_id) AS rn
        FROM d_inventory) WHERE rn <= 2 GROUP BY store_id"""))
register("d11_group_concat", lambda t: t.film_crew.groupBy("film_id").agg(
    text.group_concat(F.when(F.col("job") != "Writer", F.col("job")), F.col("person_id")).alias("jobs")), sql("""
    SELECT film_id, string_agg(CASE WHEN job <> 'Writer' THEN job END, ', ' ORDER BY person_id) AS jobs FROM d_crew GROUP BY film_id"""))
register("f5_bernoulli_sample", lambda t: t.customer.filter(numbers.sampled(12.5, "sample", F.col("customer_id"))).select(
    "customer_id"), sql(f"SELECT customer_id FROM d_customer WHERE {draw('sample', 'customer_id')} < 0.125::double"))
register("g2_union_distinct", lambda t: t.film_cast.select("person_id").union(t.customer.select("store_id")).distinct(),
         sql("SELECT person_id FROM d_cast UNION SELECT store_id FROM d_customer"))
register("h2_rental_days", lambda t: t.rental.filter(F.col("period_end").isNotNull()).select("rental_id", periods.rental_days(
    F.col("period_start"), F.col("period_end")).alias("days")), sql("""
    SELECT rental_id, greatest((epoch_us(period_end) - epoch_us(period_start) + 86399999999) // 86400000000, 1) AS days
    FROM d_rental WHERE period_end IS NOT NULL"""))
register("h7_last_day", lambda t: t.rental.groupBy(periods.last_day(F.col("period_start")).alias("day")).agg(
    F.count(F.lit(1)).alias("n")), sql("SELECT last_day(period_start)::varchar AS day, count(*) AS n FROM d_rental GROUP BY 1"))
register("h15_random_between", lambda t: t.film.select("film_id", numbers.random_between(
    3, 40, "between", F.col("film_id")).alias("value")), sql(f"""
    SELECT film_id, floor({draw('between', 'film_id')} * 37.0::double + 3.0::double)::bigint AS value FROM d_film"""))

# --- L: earlier versions ---

HELD = f"(period_end IS NULL OR (period_start <= {AS_OF} AND {AS_OF} < period_end))"
STOCK = f"""SELECT inventory_id, film_id, store_id, inventory_id NOT IN (SELECT inventory_id FROM d_rental WHERE {HELD}) AS in_stock
    FROM d_inventory"""
register("l1_discs_in_stock", lambda t: earlier.discs_with_stock_flag(t, NOW), sql(STOCK))
register("l2_film_in_stock", lambda t: earlier.film_in_stock(t, NOW),
         sql(f"SELECT film_id, store_id, inventory_id FROM ({STOCK}) WHERE in_stock"))
register("l2_film_not_in_stock", lambda t: earlier.film_in_stock(t, NOW, in_stock=False),
         sql(f"SELECT film_id, store_id, inventory_id FROM ({STOCK}) WHERE NOT in_stock"))
register("l3_disc_holders", lambda t: earlier.disc_holders(t, NOW), sql(f"""
    SELECT inventory_id, arg_min(customer_id, rental_id) AS customer_id FROM d_rental WHERE {HELD} GROUP BY inventory_id"""))
BAND = lambda i: ("CASE WHEN popularity <= 20 THEN [0, 3] WHEN popularity <= 35 THEN [0, 5] WHEN popularity <= 75 THEN [2, 6] "
                  f"WHEN popularity <= 100 THEN [5, 8] WHEN popularity <= 500 THEN [8, 12] ELSE [12, 20] END[{i}]")
LESS = f"""CASE WHEN release_date > {AS_OF} - INTERVAL 1 YEAR THEN 0 WHEN release_date >= {AS_OF} - INTERVAL 3 YEAR THEN 1
    WHEN release_date >= {AS_OF} - INTERVAL 4 YEAR THEN 2 ELSE 3 END"""
register("l4_new_film_stock", lambda t: earlier.new_film_stock(t, NOW), sql(f"""
    SELECT store_id, film_id, fewest, most, floor({draw('new-stock', 'film_id', 'store_id')} * (most - fewest)::double + fewest::double)::int AS copies
    FROM (SELECT s.store_id, f.film_id, greatest({BAND(1)} - {LESS}, 0) AS fewest, greatest({BAND(2)} - {LESS}, 0) AS most
      FROM d_film f JOIN (SELECT store_id, max(release_date) AS newest FROM d_inventory JOIN d_film USING (film_id) GROUP BY store_id) s
        ON f.release_date > s.newest WHERE f.popularity IS NOT NULL
        AND f.film_id NOT IN (SELECT film_id FROM d_inventory i WHERE i.store_id = s.store_id))"""))


def _oldest_due(t):
    due = t.rental.filter(F.col("period_end").isNotNull()).join(t.payment, "rental_id", "left_anti")
    return jobs.single_payment(t, due.agg(F.min("rental_id")).scalar()).rows["payments"]


register("l5_single_payment", _oldest_due, sql(f"""
    SELECT {MAX_PAYMENT} + 1 AS payment_id, * FROM ({DUE}) ORDER BY rental_id LIMIT 1"""))

# --- J: streams over the given order file ---


def _order_stream(spark, sf_dir):
    static = spark.read.parquet(f"{sf_dir}/orders.parquet")
    stream = spark.readStream.schema(static.schema).option("pathGlobFilter", "orders.parquet")
    return stream.parquet(sf_dir)


def _bill_stream(spark, sf_dir):
    t = binding.domain(session.prepare(spark), sf_dir)
    g = binding.given(spark, sf_dir).replaced(orders=_order_stream(spark, sf_dir))
    root = session.scratch_path(spark, "billing")
    closed = binding.rental(g).filter(F.col("period_end").isNotNull())
    billing.bill_closed_rentals(closed, t, f"{root}/payments", f"{root}/state").awaitTermination()
    return plain(billing.billed(spark, f"{root}/payments").drop("batch", "month"))


QUERIES["j1_bill_closed_rentals"] = _bill_stream
ORACLE["j1_bill_closed_rentals"] = sql(numbered("payment_id", MAX_PAYMENT, "rental_id", DUE))


def _lost_stream(spark, sf_dir):
    session.prepare(spark)
    orders = lambda: _order_stream(spark, sf_dir)
    started = F.col("o_orderdate").cast("timestamp")
    rented = orders().select(
        F.col("o_orderkey").alias("rental_id"), F.col("o_custkey").alias("customer_id"),
        F.lit(None).cast("bigint").alias("inventory_id"), started.alias("rented_at"),
    )
    kept = F.make_dt_interval(hours=(F.col("o_orderkey") % 62 + 10).cast("int"))
    returned = orders().filter(F.col("o_orderstatus") != "O").select(
        F.col("o_orderkey").alias("rental_id"), (started + kept).alias("returned_at")
    )
    root = session.scratch_path(spark, "lost")
    alerts = lost.lost_alerts(rented, returned)
    lost.write_alerts(alerts, f"{root}/alerts", f"{root}/state").awaitTermination()
    out = spark.read.schema(alerts.schema).parquet(f"{root}/alerts")
    return plain(out.select("rental_id", "customer_id", F.col("rented_at").cast("timestamp_ntz").alias("rented_at")))


QUERIES["j2_lost_alerts"] = _lost_stream
ORACLE["j2_lost_alerts"] = """
    SELECT o_orderkey AS rental_id, o_custkey AS customer_id, o_orderdate AS rented_at FROM orders
    WHERE o_orderstatus = 'O' AND o_orderdate + INTERVAL 31 DAY < least((SELECT max(o_orderdate) FROM orders),
        (SELECT max(o_orderdate + (o_orderkey % 62 + 10)::int * INTERVAL 1 HOUR) FROM orders WHERE o_orderstatus <> 'O'))"""
