"""Joins that make many rows of few bytes are dealt to many tasks."""

from pyspark.sql import functions as F

from crosscheck import binding
from kiosklake.functions import geo
from kiosklake.functions.numbers import draw, random_between, shuffle_key
from kiosklake.operators import geojoin, ranking
from kiosklake.plans import earlier, stock
from kiosklake.sources.tables import Tables


def _tables(spark):
    film = spark.range(400).select(
        F.col("id").alias("film_id"), F.lit(200.0).cast("float").alias("popularity"),
        F.date_add(F.lit("1999-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("release_date"),
        F.lit(5.0).cast("float").alias("vote_average"),
    ).coalesce(1)
    store = spark.range(30).select(F.col("id").alias("store_id")).coalesce(1)
    inventory = spark.range(30).select(F.col("id").alias("inventory_id"), F.col("id").alias("film_id"), F.col("id").alias("store_id"))
    return Tables({"film": film, "store": store, "inventory": inventory.coalesce(1)})


def _tasks(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_allocation_is_dealt(spark):
    plan = stock.allocation(_tables(spark), "2001-06-01 00:00:00", clear_existing=True)
    assert plan.count() == 400 * 30 and _tasks(plan) >= 4


def test_new_film_stock_is_dealt(spark):
    plan = earlier.new_film_stock(_tables(spark), "2001-06-01 00:00:00")
    # store s holds a film of day s, and there are ten films of each of the 40 days
    assert plan.count() == sum(10 * (39 - s) for s in range(30)) and _tasks(plan) >= 4


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_allocation_draws_by_comparing_digests(spark):
    plan = stock.allocation(_tables(spark), "2001-06-01 00:00:00", clear_existing=True)
    assert "conv(substring(md5(concat_ws(|, stock-copies" not in _plan(plan) and "BroadcastHashJoin" not in _plan(plan)
    low, steps = F.lit(10), F.lit(5)  # all films are of tier A
    wanted = F.floor(draw("stock-copies", F.col("film_id"), F.col("store_id")) * steps + low)
    assert plan.filter(F.col("copies") != wanted).count() == 0 and plan.agg(F.countDistinct("copies")).first()[0] == 5


def test_stores_of_lots_do_not_pass_the_driver_where_no_film_is_new(spark):
    t = _tables(spark)
    plan = stock.allocation(t.replaced(inventory=t.film.select(F.col("film_id").alias("inventory_id"), "film_id", F.col("film_id").alias("store_id"))), "2001-06-01 00:00:00")
    assert plan.collect() == []
    done = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [lot" in done and "BroadcastHashJoin [lot" not in done


def test_new_film_stock_draws_by_comparing_digests(spark):
    t = _tables(spark)
    popular = t.film.withColumn("popularity", (F.col("film_id") * 7 % 640).cast("float")).withColumn("film_id", F.col("film_id") + 1000)
    t = t.replaced(film=t.film.unionByName(popular))
    plan = earlier.new_film_stock(t, "2002-02-01 00:00:00")
    assert "conv(" not in _plan(plan)
    wanted = random_between(F.col("fewest"), F.col("most"), "new-stock", F.col("film_id"), F.col("store_id"))
    assert plan.count() == 2 * sum(10 * (39 - s) for s in range(30))
    assert plan.filter(~F.col("copies").eqNullSafe(wanted.cast("int"))).count() == 0
    assert plan.select("fewest", "most").distinct().count() >= 6


def test_radius_join_is_dealt(spark):
    spots = spark.range(300).select(F.col("id"), (F.col("id") % 10 * 0.4 + 40.0).alias("lat"), (F.col("id") % 30 * 0.4).alias("lng")).coalesce(1)
    side = lambda p: spots.select(*[F.col(c).alias(f"{p}_{c}") for c in spots.columns])
    pairs = geojoin.radius_join(side("s"), side("c"), 5_000.0, site_key="s_id", site_at=("s_lat", "s_lng"), point_key="c_id", point_at=("c_lat", "c_lng"))
    assert pairs.count() == 30 * 10 * 10 and _tasks(pairs) >= 4


def test_surely_near_pairs_are_near(spark):
    for radius in (1.0, 25_000.0, 3_000_000.0, 30_000_000.0):
        degrees = min(radius / 111_000.0, 89.0)
        at = spark.range(2000).select(
            (F.rand(1) * 170 - 85).alias("lat1"), (F.rand(2) * 360 - 180).alias("lng1"), (F.rand(3) * degrees * 2.2 - degrees * 1.1).alias("dy"), (F.rand(4) * degrees * 2.2 - degrees * 1.1).alias("dx"))
        at = at.withColumns({"lat2": F.greatest(F.least(F.col("lat1") + F.col("dy"), F.lit(90.0)), F.lit(-90.0)), "lng2": F.col("lng1") + F.col("dx")})
        at = geo.with_vector(geo.with_vector(at, ("lat1", "lng1"), "_u"), ("lat2", "lng2"), "_v")
        exact = (geo.half_chord_squared("_u", "_v") <= geo.chord_limit(radius)) & (geo.distance_between("_u", "_v") <= radius)
        near, other = at.agg(F.count_if(geojoin.within("_u", "_v", radius)), F.count_if(geojoin.within("_u", "_v", radius) != exact)).first()
        assert near and not other


def test_numbering_writes_no_digest_and_nothing_that_all_rows_share(spark, monkeypatch):
    written = []
    kept = ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda df, label: written.append(df.columns) or kept(df, label))
    added = stock.populate_inventory(_tables(spark).replaced(
        inventory=spark.createDataFrame([], "inventory_id long, film_id long, store_id long, status_id int, circulation_start timestamp_ntz, last_update timestamp_ntz")
    ), "2001-06-01 00:00:00")[1]
    assert [sorted(c) for c in written] == [["_at", "_part", "copy", "film_id", "store_id"]]
    digest = shuffle_key("inventory_id", F.col("film_id"), F.col("store_id"), F.col("copy"))
    rows = stock.allocation(_tables(spark), "2001-06-01 00:00:00", clear_existing=True)
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).withColumn("d", digest).orderBy("d", "film_id").limit(500)
    wanted = [(r["film_id"], r["store_id"]) for r in rows.collect()]
    got = added.filter("inventory_id <= 500").orderBy("inventory_id").collect()
    assert [(r["film_id"], r["store_id"]) for r in got] == wanted and {r["status_id"] for r in got} == {1}


def test_crew_is_grouped_by_hashing(spark):
    flags = [["A"], ["N"], ["R"], ["N", "A"], ["A", "9"], ["R", "N"], ["N", "B"], [None], [None, "A"], ["AA"], ["", "N"], ["Z", "O"]]
    lines = spark.createDataFrame([(p, 1, f) for p, some in enumerate(flags) for f in some], "l_partkey long, l_suppkey long, l_returnflag string")
    crew = binding.film_crew(Tables({"lineitem": lines}))
    least = [min((f for f in some if f is not None), default=None) for some in flags]
    wanted = [{"A": "Director", "N": "Writer"}.get(f, "Producer") for f in least]
    assert [r["job"] for r in crew.orderBy("film_id").collect()] == wanted
    assert "SortAggregate" not in crew._jdf.queryExecution().executedPlan().toString()


def test_rentals_are_dealt_without_the_store_that_follows_from_their_keys(spark):
    lines = spark.createDataFrame([(1, 5, 2, 3.0), (1, 5, 6, 2.0), (1, 5, 3, 4.0), (2, 9, 1, 1.0)], "l_orderkey long, l_partkey long, l_suppkey long, l_extendedprice double")
    orders = spark.range(1, 3).select(F.col("id").alias("o_orderkey"))
    supplier = spark.range(7).select(F.col("id").alias("s_suppkey"))
    rented = binding._rented(Tables({"lineitem": lines, "orders": orders, "supplier": supplier}))
    got = sorted((r["o_orderkey"], r["copy"], r["store_id"], r["price"]) for r in rented.collect())
    assert got == [(1, 2, (35 + 26) % 7, 2.0), (1, 3, (35 + 39) % 7, 4.0), (2, 1, (63 + 13) % 7, 1.0)]
    dealt = rented._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert "* 7" not in dealt
