"""Views and showcase queries."""

from pyspark.sql import functions as F

from crosscheck.binding_sql import AS_OF, cents, rdiv, sql
from crosscheck.binding import AS_OF as NOW
from crosscheck.registry import register
from kiosklake import session
from kiosklake.plans import views
from kiosklake.sources import tables

# what a disc is, looked up by its number
SHELF = "(SELECT inventory_id, film_id, title AS film_title, rating FROM d_inventory JOIN d_film USING (film_id))"

# bills are gathered per rental, so a rental without any keeps one row
V_RENTALS = f"""SELECT * EXCLUDE (bill), bill.amount AS amount, bill.payment_date AS payment_date FROM (
    SELECT rental_id, customer_id, period_start AS rental_date, period_end AS return_date, store_id AS rental_store_id,
           film_title, rating, unnest(coalesce(bills, [NULL])) AS bill
    FROM d_rental JOIN {SHELF} USING (inventory_id) LEFT JOIN (
        SELECT rental_id, list({{'amount': amount::double, 'payment_date': payment_date}}) AS bills FROM d_payment GROUP BY rental_id
    ) USING (rental_id)
) JOIN (SELECT customer_id, full_name, email, activebool, store_id AS home_store_id FROM d_customer) USING (customer_id)"""

V_CATALOG = """SELECT f.film_id, f.title, f.overview, f.release_date, f.rating, f.popularity, f.vote_average, f.vote_count,
    f.runtime, f.budget, f.revenue, f.original_language, g.genres,
    coalesce(cc.n, 0) AS cast_count, coalesce(cw.n, 0) AS crew_count
    FROM d_film f
    LEFT JOIN (SELECT film_id, string_agg(DISTINCT name, ', ' ORDER BY name) AS genres
               FROM (SELECT film_id, unnest(genre_ids) AS genre_id FROM d_film) x JOIN d_genre USING (genre_id)
               GROUP BY film_id) g ON g.film_id = f.film_id
    LEFT JOIN (SELECT film_id, count(*) AS n FROM d_cast GROUP BY film_id) cc ON cc.film_id = f.film_id
    LEFT JOIN (SELECT film_id, count(*) AS n FROM d_crew GROUP BY film_id) cw ON cw.film_id = f.film_id"""

V_OVERDUE = f"""SELECT * EXCLUDE (rating) FROM (
    SELECT rental_id, customer_id, inventory_id, store_id, period_start AS rental_date,
           epoch_us({AS_OF}) - epoch_us(period_start) AS days_outstanding FROM d_rental WHERE period_end IS NULL
) JOIN {SHELF} USING (inventory_id)
  JOIN (SELECT store_id, zip_code AS store_zip, street_name AS store_address FROM d_store) USING (store_id)
  JOIN (SELECT customer_id, phone, email, full_name FROM d_customer) USING (customer_id)
  WHERE days_outstanding > 5 * 86400000000"""

# takings by store, month and customer first; the customers are then the rows
V_REVENUE = f"""SELECT store_id, street_name, zip_code, taken.* EXCLUDE (store_id) FROM (
    SELECT store_id, revenue_month, sum(n)::bigint AS payment_count, sum(paid)::double AS total_revenue,
           {rdiv(cents('sum(paid)'), '100 * sum(n)', 6)} AS avg_payment, count(*) AS unique_customers
    FROM (SELECT rented.store_id, bill.customer_id, date_trunc('month', bill.payment_date)::timestamp AS revenue_month,
                 count(*) AS n, sum(bill.amount) AS paid
          FROM d_payment bill JOIN (SELECT rental_id, store_id FROM d_rental) rented USING (rental_id) GROUP BY 1, 2, 3)
    GROUP BY store_id, revenue_month
) taken JOIN d_store USING (store_id)"""

# discs by store, status and film first; the films are then the rows
V_STOCK = """SELECT store_id, street_name, zip_code, status_code, description AS status_description, disc_count, unique_films
    FROM (SELECT store_id, status_id, sum(n)::bigint AS disc_count, count(*) AS unique_films
          FROM (SELECT store_id, status_id, film_id, count(*) AS n FROM d_inventory GROUP BY ALL) GROUP BY ALL)
    JOIN d_status USING (status_id) JOIN d_store USING (store_id)"""

register("v1_customer_rentals", views.customer_rentals, sql(V_RENTALS))
register(
    "v2_film_catalog", views.film_catalog,
    sql(f"SELECT * REPLACE (release_date::varchar AS release_date, popularity::double AS popularity, "
        f"vote_average::double AS vote_average) FROM ({V_CATALOG})"),
)
register("v3_overdue_rentals", lambda t: views.overdue_rentals(t, NOW), sql(V_OVERDUE))
register("v4_revenue_summary", views.revenue_summary, sql(V_REVENUE))


def _revenue_in_two_steps(t):
    """Revenue from the parts kept with a snapshot: a first load, then later payments as changes."""
    spark = t.payment.sparkSession
    root = session.scratch_path(spark, "snapshot")
    early = F.col("payment_date") < F.lit("1999-06-15").cast("timestamp_ntz")
    tables.write_snapshot({"payment": t.payment.filter(early), "rental": t.rental, "store": t.store}, root, 1)
    views.refresh_revenue_parts(spark, root)
    tables.write_changes({"payment": t.payment.filter(~early)}, root, 3)
    views.refresh_revenue_parts(spark, root)
    now = tables.read_snapshot(spark, root)
    return views.revenue_summary(now, now.revenue_part)


register("v4_revenue_from_parts", _revenue_in_two_steps, sql(V_REVENUE))
register("v5_store_inventory_summary", views.store_inventory_summary, sql(V_STOCK))
