"""Application queries S1 to S33, each over every key of its table."""

from crosscheck import binding
from crosscheck.binding import AS_OF as NOW
from crosscheck.binding_sql import AS_OF, CELLS_FIRST, cents, digest, dist, draw, rdiv, sql
from crosscheck.q_showcase import ACTORS, DAYS, GENRES, MONTHS, film_counts
from crosscheck.q_views import V_CATALOG, V_OVERDUE, V_RENTALS, V_REVENUE, V_STOCK
from crosscheck.export import plain
from crosscheck.registry import ORACLE, QUERIES, register
from kiosklake.functions.text import STOPWORDS
from kiosklake.plans import customers, films, stores, trends
from kiosklake.session import prepare


def ago(n: int, unit: str = "DAY") -> str:
    return f"({AS_OF} - INTERVAL {n} {unit})"


def top(by: str, order: str, k: int) -> str:
    return f"QUALIFY row_number() OVER ({f'PARTITION BY {by}' if by else ''} ORDER BY {order}) <= {k}"


register("s1_above_average_renters", lambda t: customers.above_average_renters(t, NOW, 365), sql(f"""
    SELECT store_id, customer_id, full_name, n AS rental_count FROM counts c
    WHERE n > (SELECT avg(n) FROM counts x WHERE x.store_id = c.store_id)""",
    counts=f"""SELECT c.store_id, c.customer_id, c.full_name, count(*) AS n FROM d_customer c
    JOIN d_rental r ON r.customer_id = c.customer_id WHERE r.period_start >= {ago(365)} GROUP BY ALL"""))

register("s2_customers_at_a_glance", lambda t: customers.customers_at_a_glance(t, NOW, 900), sql(f"""
    SELECT c.customer_id, c.full_name, count(r.rental_id) AS total_rentals,
    count(r.rental_id) FILTER (r.period_end IS NULL) AS open_rentals, round(sum(p.amount), 2)::double AS total_spent
    FROM d_customer c LEFT JOIN d_rental r ON c.customer_id = r.customer_id AND r.period_start >= {ago(900)}
    LEFT JOIN d_payment p ON r.rental_id = p.rental_id AND p.payment_date >= {ago(900)} GROUP BY ALL"""))

CARD = """film_id, title, release_date::varchar AS release_date, rating, popularity::double AS popularity,
    vote_average::double AS vote_average"""
register("s3_film_lookup", lambda t: films.film_lookup(t, "RING"), sql(f"""
    SELECT {CARD}, runtime FROM d_film WHERE title ILIKE '%RING%' ORDER BY film_id LIMIT 200"""))
register("s3_films_by_id", lambda t: films.films_by_id(t, t.film_cast.select("film_id").distinct()), sql(f"""
    SELECT {CARD}, runtime FROM d_film WHERE film_id IN (SELECT film_id FROM d_cast)"""))

register("s4_catalog_recent", lambda t: films.catalog_recent(t, NOW, 3), sql(f"""
    SELECT film_id, title, genres, vote_average::double AS vote_average, popularity::double AS popularity, cast_count, crew_count
    FROM ({V_CATALOG}) WHERE release_date >= {ago(3, 'YEAR')} ORDER BY popularity DESC NULLS FIRST, film_id LIMIT 25"""))
register("s4_catalog_top_rated", lambda t: films.catalog_top_rated(t, 7.5), sql(f"""
    SELECT film_id, title, genres, release_date::varchar AS release_date, vote_average::double AS vote_average,
    popularity::double AS popularity, cast_count
    FROM ({V_CATALOG}) WHERE vote_average >= 7.5::float AND vote_count >= 100
    ORDER BY vote_average DESC NULLS FIRST, film_id LIMIT 25"""))
register("s4_catalog_big_budget", lambda t: films.catalog_big_budget(t, NOW, 1_000_000, 6), sql(f"""
    SELECT film_id, title, genres, release_date::varchar AS release_date, budget, revenue, vote_average::double AS vote_average,
    runtime FROM ({V_CATALOG}) WHERE budget >= 1000000 AND release_date >= {ago(6, 'YEAR')}
    ORDER BY revenue DESC NULLS LAST, film_id LIMIT 25"""))

register("s5_films_in_genre", lambda t: films.films_in_genre(t, 7), sql(f"""
    SELECT {CARD} FROM d_film WHERE list_contains(genre_ids, 7) ORDER BY popularity DESC NULLS FIRST, film_id LIMIT 20"""))
register("s5_films_with_rating", lambda t: films.films_with_rating(t, "PG-13"), sql(f"""
    SELECT {CARD} FROM d_film WHERE rating = 'PG-13' ORDER BY d_film.vote_average DESC NULLS FIRST, film_id LIMIT 20"""))
register("s5_popular_films", films.popular_films, sql(f"""
    SELECT {CARD} FROM d_film ORDER BY d_film.popularity DESC NULLS FIRST, film_id LIMIT 20"""))


def _search(spark, sf_dir):
    docs = binding.documents_as_films(binding.given(prepare(spark), sf_dir))
    return plain(films.search_films(docs, ["From", "erin"]))


STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
QUERIES["s5_search_films"] = _search
ORACLE["s5_search_films"] = f"""
    SELECT film_id, title, NULL::varchar AS release_date, NULL::varchar AS rating, popularity,
    len(list_filter(words, lambda w: w IN ('from', 'erin')))::double / len(words) AS rank
    FROM (SELECT doc_id AS film_id, source || ' ' || doc_id AS title, (doc_id * 13 % 6000)::double AS popularity,
            list_filter(regexp_split_to_array(lower(concat_ws(' ', source || ' ' || doc_id, text)), '[^\\p{{L}}\\p{{N}}]+'),
                        lambda w: w <> '' AND w NOT IN ({STOP})) AS words FROM documents)
    WHERE list_contains(words, 'from') AND list_contains(words, 'erin')
    ORDER BY rank DESC, film_id LIMIT 20"""

register("s6_disc_offers", customers.disc_offers, sql(f"""
    SELECT customer_id, inventory_id, store_id FROM (
        SELECT n.customer_id, d.inventory_id, n.store_id, count(*) OVER (PARTITION BY n.customer_id) AS total,
            row_number() OVER (PARTITION BY n.customer_id ORDER BY {CELLS_FIRST}, d.inventory_id) AS rn
        FROM near n JOIN d_place g ON g.store_id = n.store_id JOIN d_disc d ON d.store_id = n.store_id AND d.is_available)
    WHERE rn = floor({draw('offer', 'customer_id')} * total) + 1""",
    near=f"""SELECT customer_id, store_id FROM (SELECT c.customer_id, s.store_id, {dist('s.lat', 's.lng', 'c.lat', 'c.lng')} AS m
         FROM d_customer c, d_store s
         WHERE c.lat IS NOT NULL AND c.customer_id NOT IN (SELECT customer_id FROM d_rental WHERE period_end IS NULL))
        WHERE m <= 25000"""))

NEWEST = "rental_date DESC, rental_id DESC, payment_date DESC NULLS FIRST, amount DESC NULLS FIRST"
register("s7_account_history", lambda t: customers.account_history(t, NOW, 900), sql(f"""
    SELECT customer_id, film_title, rental_date, return_date, amount, rental_store_id, rating FROM ({V_RENTALS})
    WHERE rental_date >= {ago(900)} {top('customer_id', NEWEST, 20)}"""))
register("s7_account_spending", customers.account_spending, sql(f"""
    SELECT c.customer_id, count(r.rental_id) AS total_rentals, coalesce(sum(p.amount), 0)::double AS total_spent,
    coalesce({rdiv(cents('coalesce(sum(p.amount), 0)'), '100 * count(p.amount)', 6)}, 0.0::double) AS avg_payment,
    min(r.period_start) AS first_rental, max(r.period_start) AS last_rental
    FROM d_customer c LEFT JOIN d_rental r ON r.customer_id = c.customer_id LEFT JOIN d_payment p ON p.rental_id = r.rental_id
    GROUP BY c.customer_id"""))
register("s7_account_store_history", customers.account_store_history, sql(f"""
    SELECT customer_id, rental_store_id, film_title, rental_date, return_date, amount FROM ({V_RENTALS})
    {top('customer_id, rental_store_id', NEWEST, 20)}"""))
register("s8_recent_rentals", lambda t: customers.recent_rentals(t, NOW, 1200, k=5), sql(f"""
    SELECT r.customer_id, r.rental_id, f.title, r.period_start AS rented_at, r.period_end AS returned_at, p.amount::double AS amount
    FROM d_rental r JOIN d_inventory i ON r.inventory_id = i.inventory_id JOIN d_film f ON i.film_id = f.film_id
    LEFT JOIN d_payment p ON r.rental_id = p.rental_id WHERE r.period_start >= {ago(1200)}
    {top('r.customer_id', 'r.period_start DESC, r.rental_id DESC, p.payment_id DESC NULLS FIRST', 5)}"""))

WORN = f"""SELECT store_id, inventory_id, title, rental_count FROM d_disc JOIN d_film USING (film_id)
    JOIN (SELECT inventory_id, count(*) AS rental_count FROM d_rental GROUP BY inventory_id) USING (inventory_id)
    WHERE rental_count >= 15 AND status_id = 1 {top('store_id', 'rental_count DESC, inventory_id', 10)}"""
register("s9_worn_discs", lambda t: stores.worn_discs(t), sql(WORN))
register("s9_recycle_discs", lambda t: stores.recycle_discs(t, NOW)[0], sql(f"""
    SELECT i.inventory_id, i.film_id, i.store_id, CASE WHEN h THEN 4 ELSE i.status_id END AS status_id, i.circulation_start,
    CASE WHEN h THEN {AS_OF} ELSE i.last_update END AS last_update
    FROM (SELECT *, inventory_id IN (SELECT inventory_id FROM worn) AND NOT is_out AS h FROM d_disc) i""", worn=WORN))

KM = lambda a, b: f"round({dist(f'{a}.lat', f'{a}.lng', f'{b}.lat', f'{b}.lng')} / 1000, 1)"
register("s10_film_near_zip", films.film_near_zip, sql(f"""
    SELECT zip_code, film_id, store_id, street_name, road_ref, copies_available, distance_km FROM near
    JOIN (SELECT film_id, store_id, count(*) AS copies_available FROM d_disc WHERE is_available GROUP BY ALL) USING (store_id)
    {top('zip_code, film_id', 'distance_km, store_id', 10)}""",
    near=f"""SELECT * FROM (SELECT z.zip_code, s.store_id, s.street_name, s.road_ref, {KM('s', 'z')} AS distance_km,
        {dist('z.lat', 'z.lng', 's.lat', 's.lng')} AS m FROM d_store s, d_zip z) WHERE m <= 50000"""))

register("s11_film_cast", films.cast_of, sql("""
    SELECT fc.film_id, fc.person_id, p.name, p.popularity::double AS popularity, fc.film_character
    FROM d_cast fc JOIN d_person p ON fc.person_id = p.person_id"""))
register("s12_film_detail", films.film_detail, sql(f"""
    SELECT {CARD}, overview, budget, revenue, runtime FROM d_film"""))
register("s12_film_crew", films.crew_of, sql("""
    SELECT fc.film_id, fc.person_id, p.name, fc.department, fc.job FROM d_crew fc JOIN d_person p ON fc.person_id = p.person_id"""))

BUSY = lambda n: f"period_start < {AS_OF} AND (period_end IS NULL OR period_end > {ago(n)})"
register("s13_genre_popularity", lambda t: trends.genre_popularity(t, NOW, 365),
         sql(GENRES, film_counts=film_counts(f"WHERE {BUSY(365)}")))
# counts per disc first, then discs and their counts per store and film
register("s14_utilization", lambda t: stores.utilization(t, NOW, 900), sql(f"""
    SELECT store_id, film_id, title, popularity::double AS popularity, total_copies, rentals_in_period,
    {rdiv('rentals_in_period', 'total_copies', 1)} AS rentals_per_copy
    FROM (SELECT store_id, film_id, count(*) AS total_copies, sum(coalesce(n, 0))::bigint AS rentals_in_period
          FROM d_disc LEFT JOIN uses USING (inventory_id) WHERE status_id = 1 GROUP BY ALL) JOIN d_film USING (film_id)
    {top('store_id', 'rentals_per_copy DESC NULLS LAST, film_id', 50)}""",
    uses=f"SELECT inventory_id, count(*) AS n FROM d_rental WHERE period_start >= {ago(900)} GROUP BY inventory_id"))
register("s15_stock_of_stores", stores.stock_of_stores, sql("""
    SELECT s.store_id, count(*) AS total_items, count(DISTINCT i.film_id) AS unique_films,
    count(*) FILTER (i.is_available) AS available FROM d_store s JOIN d_disc i ON i.store_id = s.store_id GROUP BY s.store_id"""))
# copies are counted apart as free and out, before films are known
SHELVED = """SELECT store_id, film_id, sum((NOT is_out)::int)::bigint AS free, sum(is_out::int)::bigint AS gone
    FROM d_disc WHERE status_id = 1 GROUP BY ALL"""
register("s16_new_arrivals", lambda t: stores.new_arrivals(t, "2000-06-01", days=900), sql(f"""
    SELECT store_id, {CARD}, free + gone AS copies_in_stock, free AS copies_available
    FROM shelved JOIN (FROM d_film WHERE release_date >= DATE '2000-06-01' - 900) USING (film_id)
    {top('store_id', 'release_date DESC NULLS FIRST, popularity DESC NULLS FIRST, film_id', 20)}""", shelved=SHELVED))
register("s17_longest_overdue", lambda t: stores.longest_overdue(t, NOW), sql(f"""
    SELECT rental_id, full_name, email, film_title, days_outstanding, store_address, store_zip FROM ({V_OVERDUE})
    ORDER BY days_outstanding DESC, rental_id LIMIT 50"""))
register("s17_overdue_by_store", lambda t: stores.overdue_by_store(t, NOW), sql(f"""
    SELECT store_id, rental_id, full_name, phone, film_title, days_outstanding FROM ({V_OVERDUE})"""))
register("s18_overdue_at_store", lambda t: stores.overdue_at_store(t, NOW, k=20), sql(f"""
    SELECT store_id, rental_id, full_name, film_title AS title, rental_date AS rented_at,
    days_outstanding // 86400000000 AS days_out FROM ({V_OVERDUE}) {top('store_id', 'rental_date, rental_id', 20)}"""))
register("s19_payment_detail", lambda t: trends.payment_detail(t, NOW, 1500), sql(f"""
    SELECT c.full_name, c.email, f.title, f.overview, p.amount::double AS amount, p.payment_date, r.store_id
    FROM d_rental r JOIN d_payment p ON p.rental_id = r.rental_id JOIN d_customer c ON c.customer_id = r.customer_id
    JOIN d_inventory i ON i.inventory_id = r.inventory_id JOIN d_film f ON f.film_id = i.film_id
    WHERE r.period_start >= {ago(1500)}"""))
RECENT = "SELECT r.store_id, r.rental_id, r.period_start, r.period_end, r.customer_id, c.full_name " \
         "FROM d_rental r JOIN d_customer c ON r.customer_id = c.customer_id WHERE r.period_start > TIMESTAMP '1998-01-01'"
register("s20_recent_activity", lambda t: stores.recent_activity(t, "1998-01-01", k=40),
         sql(f"{RECENT} {top('r.store_id', 'r.last_update DESC NULLS FIRST, r.rental_id DESC', 40)}"))
register("s21_recent_store_rentals", lambda t: stores.recent_store_rentals(t, "1998-01-01", k=40),
         sql(f"{RECENT} {top('r.store_id', 'r.rental_id DESC', 40)}"))
register("s22_weekday_trend", lambda t: trends.weekday_trend(t, NOW, 365),
         sql(f"{DAYS} FROM d_rental WHERE {BUSY(365)} GROUP BY 1, 2"))
register("s24_store_revenue_trend", trends.store_revenue_trend, sql(f"""
    SELECT store_id, revenue_month, total_revenue, payment_count, avg_payment, unique_customers FROM ({V_REVENUE})
    {top('store_id', 'revenue_month DESC', 12)}"""))
register("s24_top_stores", lambda t: trends.top_stores(t, NOW, 6), sql(f"""
    SELECT store_id, street_name, total_revenue, payment_count, unique_customers FROM ({V_REVENUE})
    WHERE revenue_month = date_trunc('month', {ago(6, 'MONTH')}) ORDER BY total_revenue DESC, store_id LIMIT 20"""))
register("s24_month_comparison", lambda t: trends.month_comparison(t, NOW, 12), sql(f"""
    SELECT revenue_month, count(*) AS store_count, sum(total)::double AS chain_revenue, sum(n)::bigint AS chain_rentals,
    {rdiv('sum(mean)', 'count(*) * 1000000', 2)} AS chain_avg_payment
    FROM (SELECT revenue_month, payment_count AS n, total_revenue::decimal(18,2) AS total,
                 round(avg_payment * 1000000)::hugeint AS mean FROM ({V_REVENUE}))
    WHERE revenue_month >= date_trunc('month', {ago(12, 'MONTH')}) GROUP BY revenue_month"""))
register("s25_monthly_revenue", lambda t: trends.monthly_revenue(t, NOW),
         sql(f"{MONTHS} WHERE r.period_start >= {ago(12, 'MONTH')} GROUP BY 1) ORDER BY month DESC LIMIT 12"))
register("s26_stale_discs", lambda t: stores.stale_discs(t, NOW), sql(f"""
    SELECT store_id, inventory_id, title, popularity, last_returned,
    (epoch_us({AS_OF}) - epoch_us(idle_since)) // 86400000000 AS days_idle
    FROM (SELECT store_id, inventory_id, title, popularity::double AS popularity, last_returned,
                 coalesce(last_returned, circulation_start) AS idle_since
          FROM d_disc JOIN d_film USING (film_id) LEFT JOIN seen USING (inventory_id) WHERE status_id = 1)
    WHERE idle_since < {ago(90)} {top('store_id', 'days_idle DESC, inventory_id', 50)}""",
    seen="SELECT inventory_id, max(period_end) AS last_returned FROM d_rental GROUP BY inventory_id"))
register("s27_dashboard", stores.dashboard,
         sql(f"SELECT store_id, status_code, status_description, disc_count, unique_films FROM ({V_STOCK})"))
register("s27_compare_stores", stores.compare_stores,
         sql(f"SELECT store_id, street_name, status_code, disc_count, unique_films FROM ({V_STOCK})"))
register("s27_low_stock", lambda t: stores.low_stock(t, 441), sql(f"""
    SELECT store_id, street_name, zip_code, disc_count, unique_films FROM ({V_STOCK})
    WHERE status_code = 'in_circulation' AND unique_films < 441 ORDER BY unique_films, store_id LIMIT 20"""))
register("s28_store_shelf", stores.store_shelf, sql(f"""
    SELECT i.store_id, f.film_id, f.title, f.rating, f.popularity::double AS popularity, count(*) AS total_copies,
    count(*) FILTER (i.is_available) AS available FROM d_disc i JOIN d_film f ON i.film_id = f.film_id
    GROUP BY i.store_id, f.film_id, f.title, f.rating, f.popularity
    {top('i.store_id', 'f.popularity DESC NULLS FIRST, f.film_id', 50)}"""))
# a rental weighs as many times as it was paid, and once if it was not
register("s29_performance", lambda t: stores.performance(t, NOW, 900), sql(f"""
    SELECT store_id, street_name, coalesce(weight, 0)::bigint AS total_rentals, round(coalesce(taken, 0), 2)::double AS total_revenue,
    {rdiv('coalesce(held, 0)', 'coalesce(weight, 0) * 3600000000', 1)} AS avg_hours_rented,
    coalesce(discs, 0) AS unique_items_rented, coalesce(stock, 0) AS total_inventory
    FROM d_store LEFT JOIN busy USING (store_id)
    LEFT JOIN (SELECT store_id, count(*) AS stock FROM d_disc WHERE status_id = 1 GROUP BY store_id) USING (store_id)
    ORDER BY total_revenue DESC, store_id LIMIT 25""",
    bills="SELECT rental_id, count(*) AS times, sum(amount) AS paid FROM d_payment GROUP BY rental_id",
    busy=f"""SELECT store_id, sum(coalesce(times, 1)) AS weight, sum(paid) AS taken, count(DISTINCT inventory_id) AS discs,
        sum(coalesce(times, 1) * (epoch_us(coalesce(period_end, {AS_OF})) - epoch_us(period_start))) AS held
        FROM d_rental LEFT JOIN bills USING (rental_id) WHERE period_start >= {ago(900)} GROUP BY store_id"""))
register("s30_nearest_stores", films.nearest_stores, sql(f"""
    SELECT zip_code, store_id, street_name, road_ref, phone, distance_km FROM (
        SELECT z.zip_code, s.store_id, s.street_name, s.road_ref, s.phone, {KM('s', 'z')} AS distance_km,
        {dist('z.lat', 'z.lng', 's.lat', 's.lng')} AS m FROM d_store s, d_zip z)
    WHERE m <= 50000 {top('zip_code', 'm, store_id', 10)}"""))
LATELY = film_counts(f"WHERE r.period_start > {ago(30)}")
register("s31_top_actors_unreduced", lambda t: trends.actor_report_unreduced(t, NOW), sql(ACTORS, film_counts=LATELY))
register("s32_top_actors", lambda t: trends.actor_report(t, NOW), sql(ACTORS, film_counts=LATELY))
DISC = f"""SELECT store_id, inventory_id FROM d_inventory WHERE status_id = 1
    {top('store_id', 'last_update DESC NULLS FIRST, inventory_id', 1)}"""
register("s33_latest_touched_disc", stores.latest_touched_disc, sql(DISC))
# each rental once per bill, or once without: the bills of a rental are a list first
HISTORY = """SELECT inventory_id, rental_id, rented_at, returned_at, rented_from_store, shop.street AS store_address,
    shop.y AS store_lat, shop.x AS store_lng, names[customer_id] AS customer, unnest(coalesce(bills, [NULL])) AS amount
    FROM (SELECT inventory_id, rental_id, customer_id, period_start AS rented_at, period_end AS returned_at,
            store_id AS rented_from_store, shops[store_id] AS shop, names
          FROM d_rental, (SELECT map(list(store_id), list({'street': street_name, 'y': lat, 'x': lng})) AS shops FROM d_store),
            (SELECT map(list(customer_id), list(full_name)) AS names FROM d_customer))
    LEFT JOIN (SELECT rental_id, list(amount::double) AS bills FROM d_payment GROUP BY rental_id) USING (rental_id)"""
register("s33_disc_history", stores.disc_history, sql(HISTORY))
register("s33_disc_location", stores.disc_location, sql("""
    SELECT i.inventory_id, f.title, i.store_id, s.street_name, i.status_id, i.last_update, i.circulation_start
    FROM d_inventory i JOIN d_film f ON i.film_id = f.film_id JOIN d_store s ON i.store_id = s.store_id"""))
