from pyspark.sql import functions as F

from kiosklake.functions import periods
from kiosklake.plans import customers, earlier, films, reports, showcase, stores, trends, views
from tests.conftest import AS_OF, dt, money


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_customer_rentals_has_a_row_per_payment(tables):
    got = rows(views.customer_rentals(tables).orderBy("rental_id", "amount"), "rental_id", "amount")
    assert [a for r, a in got if r == 4] == [money("1.99"), money("5.00")]
    assert [a for r, a in got if r == 6] == [None]
    assert len(got) == 9


def test_film_catalog_keeps_films_without_genres(tables):
    got = {r.film_id: (r.genres, r.cast_count, r.crew_count) for r in views.film_catalog(tables).collect()}
    assert got == {1: ("Action, Drama", 3, 1), 2: ("Action", 2, 1), 3: (None, 3, 0), 4: (None, 2, 1)}


def test_overdue_views(tables):
    late = views.overdue_rentals(tables, AS_OF)
    assert sorted(rows(late, "rental_id")) == [(6,), (7,), (8,)]
    listed = reports.overdue_in_circulation(tables, AS_OF)
    # disc 14 is lost already; film 2 is a classic
    assert rows(listed, "rental_id", "days_overdue", "replacement_cost") == [
        (6, 75, money("9.99")), (7, 74, money("9.99"))]


def test_revenue_summary(tables):
    got = {(r.store_id, str(r.revenue_month)[:7]): (r.payment_count, r.total_revenue, float(r.avg_payment), r.unique_customers)
           for r in views.revenue_summary(tables).collect()}
    assert got[(1, "2024-06")] == (2, money("6.99"), 3.495, 1)
    assert got[(1, "2025-06")] == (1, money("1.99"), 1.99, 1)


def test_status_summary_bands_and_fan_out(tables):
    got = {r.status: (r.customer_count, float(r.avg_lifetime_rentals), float(r.avg_lifetime_value))
           for r in reports.customer_status_summary(tables, AS_OF).collect()}
    assert got["Inactive"] == (1, 1.0, 0.0)
    assert got["Active (30d)"] == (1, 4.0, 1.99)
    # Bob's twice-paid rental counts twice; Cyd and Eve never rented
    assert got["At Risk (>180d)"] == (3, 0.7, 2.33)
    once = {r.status: float(r.avg_lifetime_rentals)
            for r in reports.customer_status_summary(tables, AS_OF, count_each_rental_once=True).collect()}
    assert once["At Risk (>180d)"] == 0.3


def test_balance_covers_every_customer(tables):
    got = dict(rows(reports.customer_balance(tables, "2024-06-02 12:00:00"), "customer_id", "balance"))
    assert len(got) == 6 and got[2] == money("5.00") and got[3] == money("0.00")


def test_availability(tables):
    got = {r.film_id: (r.stores_with_film, r.total_copies, r.copies_available)
           for r in reports.film_availability(tables).collect()}
    assert got == {1: (1, 2, 2), 2: (3, 3, 0), 3: (0, 0, 0), 4: (2, 3, 0)}
    order = rows(reports.film_availability(tables), "film_id")
    assert order == [(3,), (1,), (4,), (2,)]  # unknown popularity comes first
    assert rows(reports.film_availability(tables, min_stores=3), "film_id") == [(2,)]


def test_balance_report_totals_and_null_percentage(tables):
    got = {r.store_id: r for r in reports.inventory_balance(tables).collect()}
    assert [got[s].nearby_customers for s in (1, 2, 3)] == [5, 5, 0]
    stocked = tables.inventory.filter("status_id = 1").count()
    assert abs(sum(r.target_inventory for r in got.values()) - stocked) <= len(got)
    few = tables.replaced(inventory=tables.inventory.filter("inventory_id = 17"))
    row = {r.store_id: r for r in reports.inventory_balance(few).collect()}[3]
    assert row.target_inventory == 0 and row.variance_pct is None


def test_status_shares_sum_to_all_discs(tables):
    got = rows(reports.inventory_status_summary(tables), "status_code", "inventory_count", "pct_of_total")
    assert [g[0] for g in got] == ["in_circulation", "lost", "damaged", "retired"]
    assert sum(g[1] for g in got) == tables.inventory.count() and float(sum(g[2] for g in got)) == 100.0


def test_prices(tables):
    got = dict(rows(reports.film_prices(tables, AS_OF), "film_id", "replacement_cost"))
    assert got == {1: money("24.99"), 2: money("9.99"), 3: money("9.99"), 4: money("19.99")}
    assert rows(reports.price_of(tables, "daily_rental_rate"), "pricing_value") == [(money("1.99"),)]
    assert rows(reports.price_of(tables, "nothing"), "pricing_value") == [(None,)]
    assert len(rows(reports.disc_prices(tables, AS_OF), "inventory_id")) == 8


def test_monthly_trend_counts_joined_rows(tables):
    got = rows(showcase.monthly_trend(tables), "month", "rentals")
    assert ("2024-06", 2) in got and got[0][0] == "2025-06"
    assert ("2024-06", 1) in rows(showcase.monthly_trend(tables, count_each_rental_once=True), "month", "rentals")


def test_holidays_keep_quiet_days(tables):
    got = rows(showcase.busiest_holidays(tables, "2025-01-01", "2025-12-31"), "holiday_name", "rentals_on_holiday")
    assert got == [("June", 2), ("July", 0)]


def test_travel_bands_skip_nothing(tables):
    got = rows(showcase.travel_distances(tables), "distance_bucket", "rentals")
    assert sum(n for _, n in got) == tables.rental.count()
    assert got[0][0] == "< 5 km"


def test_actor_reports_agree(tables):
    fast = rows(showcase.top_actors(tables, tables.rental, min_films=1), "actor", "films", "total_rentals")
    slow = rows(showcase.top_actors_unreduced(tables, tables.rental, min_films=1), "actor", "films", "total_rentals")
    assert fast == slow and len(fast) == 4  # two people named Kim stay apart


def test_actor_pairs_merge_namesakes(tables):
    got = rows(showcase.actor_pairs(tables, min_films=2), "actor_1", "actor_2", "films_together")
    assert got == [("Kim", "Lee", 3), ("Lee", "Max", 2)]


def test_films_of_actor_order(tables):
    assert rows(showcase.films_of_actor(tables, "kIM"), "title") == [
        ("No Genre",), ("Star Night",), ("Star Night",), ("Old Island",)]


def test_genres_count_each_film_once(tables):
    got = {r.genre: (r.total_rentals, r.films_in_genre) for r in showcase.genre_rentals(tables, tables.rental).collect()}
    assert got == {"Action": (7, 2), "Drama": (3, 1)}


def test_search_needs_every_term_in_whole_text(tables):
    assert rows(films.search_films(tables.film, ["STAR", "island"]), "film_id") == [(1,)]
    # 2 of 6 words and 1 of 3: equal rank, so the lower id leads
    assert rows(films.search_films(tables.film, ["star"]), "film_id") == [(1,), (4,)]
    assert rows(films.search_films(tables.film, ["island"]), "film_id") == [(2,), (1,)]
    assert rows(films.search_films(tables.film, ["sta"]), "film_id") == []
    # stopwords are dropped, compounds cut; nothing but stopwords finds nothing
    assert rows(films.search_films(tables.film, ["the", "star"]), "film_id") == [(1,), (4,)]
    assert rows(films.search_films(tables.film, ["Star-Night"]), "film_id") == [(1,)]
    assert rows(films.search_films(tables.film, ["the", "!"]), "film_id") == []


def test_namesake_genres_count_a_film_once(tables, spark):
    twice = tables.film_genre.unionByName(spark.createDataFrame([(7, "Drama")], tables.film_genre.schema))
    both = tables.film.withColumn("genre_ids", F.when(F.col("film_id") == 1, F.array(F.lit(1), F.lit(7))).otherwise(F.col("genre_ids")))
    rental = tables.rental
    got = {r.genre: r for r in showcase.genre_rentals(tables.replaced(film_genre=twice, film=both), rental).collect()}
    once = {r.genre: r for r in showcase.genre_rentals(tables, rental).collect()}
    assert got["Drama"].films_in_genre == once["Drama"].films_in_genre == 1
    assert got["Drama"].total_rentals == 2 * once["Drama"].total_rentals


def test_catalog_pages(tables):
    assert rows(films.catalog_recent(tables, AS_OF, 3), "film_id") == [(1,), (4,)]
    assert rows(films.catalog_top_rated(tables, 5.0, 20), "film_id") == [(1,), (3,), (4,)]
    assert rows(films.catalog_big_budget(tables, AS_OF, 5, 3), "film_id") == [(1,)]
    assert rows(films.films_in_genre(tables, 2), "film_id") == [(1,), (2,)]
    assert rows(films.film_lookup(tables, "ISLAND"), "film_id") == [(2,)]


def test_zip_searches(tables):
    assert rows(films.nearest_stores(tables, 10), "store_id") == [(1,), (2,)]
    near = rows(films.film_near_zip(tables, film_id=1, zip_code=10), "store_id", "copies_available")
    assert near == [(1, 2)]


def test_offers_exclude_customers_with_an_open_rental(tables):
    got = {r.customer_id: r.inventory_id for r in customers.disc_offers(tables).collect()}
    assert set(got) == {2, 3}  # 1, 4 and 6 have one out, 5 has no position
    assert set(got.values()) <= {11, 12}


def test_customer_queries(tables):
    spent = {r.customer_id: (r.total_rentals, r.total_spent) for r in customers.account_spending(tables).collect()}
    assert spent[3] == (0, money("0.00")) and spent[2] == (2, money("6.99"))
    glance = {r.customer_id: (r.total_rentals, r.open_rentals) for r in customers.customers_at_a_glance(tables, AS_OF, 30).collect()}
    assert glance[1] == (4, 1) and glance[5] == (0, 0)
    assert rows(customers.recent_rentals(tables, AS_OF, 30, customer_id=1, k=2), "rental_id") == [(5,), (3,)]
    assert rows(customers.account_history(tables, AS_OF, 30, customer_id=1, k=1), "rental_date") == [(dt("2025-06-14 00:00:00"),)]


def test_store_queries(tables):
    assert rows(stores.worn_discs(tables, min_rentals=2), "inventory_id", "rental_count") == [(11, 2), (13, 2)]
    inventory, retired = stores.recycle_discs(tables, AS_OF, min_rentals=2)
    assert rows(retired, "inventory_id") == [(11,)]  # 13 is out
    assert rows(inventory.filter("inventory_id = 11"), "status_id") == [(4,)]
    stale = rows(stores.stale_discs(tables, AS_OF, 2), "inventory_id", "days_idle")
    assert stale == []
    assert (17, 531) in rows(stores.stale_discs(tables, AS_OF), "inventory_id", "days_idle")
    perf = {r.store_id: r for r in stores.performance(tables, AS_OF, 400).collect()}
    assert perf[3].total_rentals == 1 and perf[1].total_rentals == 6
    assert rows(stores.latest_touched_disc(tables, 1), "inventory_id") == [(18,)]
    assert rows(stores.disc_history(tables, 11), "rental_id") == [(1,), (2,)]


def test_trends(tables):
    assert {r.genre for r in trends.genre_popularity(tables, AS_OF, 30).collect()} == {"Action", "Drama"}
    assert rows(trends.payment_detail(tables, AS_OF, 400), "full_name", "amount") == [
        ("Ann", money("1.99")), ("Bob", money("5.00")), ("Bob", money("1.99"))]
    assert rows(trends.top_stores(tables, AS_OF, 0), "store_id") == [(1,)]


def test_earlier_operators(tables):
    in_stock = {r.inventory_id: r.in_stock for r in earlier.discs_with_stock_flag(tables, "2025-06-02 12:00:00").collect()}
    assert in_stock[11] is False and in_stock[12] is True and in_stock[18] is False
    holders = dict(rows(earlier.disc_holders(tables, "2025-06-02 12:00:00"), "inventory_id", "customer_id"))
    assert holders[11] == 1 and 12 not in holders
    # store 2 holds nothing newer than 2023, so film 1 is new to it
    got = rows(earlier.new_film_stock(tables, AS_OF), "store_id", "film_id", "fewest", "most")
    assert (2, 1, 8, 12) in got and all(s != 1 for s, *_ in got)
