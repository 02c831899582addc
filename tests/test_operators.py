import random

import pytest
from pyspark.sql import Window, functions as F

from kiosklake.functions.geo import distance_m
from kiosklake.operators import checks, geojoin, geotree, maintain, membership, pairs, ranking
from tests.conftest import dt, frame


def ids(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def scattered(spark, seed, n, box):
    rng = random.Random(seed)
    lat0, lat1, lng0, lng1 = box
    rows = [(i, rng.uniform(lat0, lat1), (rng.uniform(lng0, lng1) + 180) % 360 - 180) for i in range(n)]
    rows += [(n + i, rows[0][1], rows[0][2]) for i in range(20)]  # one hot position
    return rows


BOXES = [(40.0, 41.0, -75.0, -74.0), (-1.0, 1.0, 179.3, 181.0), (88.6, 90.0, -180.0, 180.0), (69.0, 70.0, 10.0, 14.0)]


def test_radius_join_and_count_match_brute_force(spark, monkeypatch):
    for number, box in enumerate(BOXES):
        sites = spark.createDataFrame(scattered(spark, number, 40, box) + [(999, None, None)], "s int, s_lat double, s_lng double")
        points = spark.createDataFrame(scattered(spark, 100 + number, 300, box) + [(999, None, 1.0)], "p int, p_lat double, p_lng double")
        metres = distance_m(F.col("s_lat"), F.col("s_lng"), F.col("p_lat"), F.col("p_lng"))
        expected = ids(sites.crossJoin(points).filter(metres <= 25000), "s", "p")
        keys = dict(site_key="s", site_at=("s_lat", "s_lng"), point_key="p", point_at=("p_lat", "p_lng"))
        assert expected
        assert ids(geojoin.radius_join(sites, points, 25000.0, **keys), "s", "p") == expected
        # a part size of 3 splits almost every cell on both sides
        assert ids(geojoin.radius_join(sites, points, 25000.0, rows_per_part=3, **keys), "s", "p") == expected
        keys.pop("point_key")
        per_site = {}
        for s, _ in expected:
            per_site[s] = per_site.get(s, 0) + 1
        for measured in (64, 2) if number % 2 else (64,):  # with 2 positions a cell most cells are cut several times
            monkeypatch.setattr(geotree, "MEASURED", measured)
            counts = geotree.count_within(sites, points, 25000.0, name="n", **keys)
            assert {r.s: r.n for r in counts.collect()} == {r.s: per_site.get(r.s, 0) for r in sites.collect()}


@pytest.mark.parametrize("measured", [64, 2])
def test_picks_are_the_nth_in_reach(spark, monkeypatch, measured):
    monkeypatch.setattr(geotree, "MEASURED", measured)
    box = BOXES[0]
    items = spark.createDataFrame(scattered(spark, 5, 60, box) + scattered(spark, 5, 20, box) + [(999, None, None)], "s int, s_lat double, s_lng double")
    items = items.withColumn("k", F.monotonically_increasing_id())  # some share their position
    rows = spark.createDataFrame(scattered(spark, 6, 12, box) + [(99, None, 1.0)], "p int, p_lat double, p_lng double")
    rows = rows.withColumn("draw", F.explode(F.expr("transform(sequence(0, 19), i -> i / 20.0D)")))
    got = geotree.pick_within(rows, items, 25000.0, row_at=("p_lat", "p_lng"), item_at=("s_lat", "s_lng"),
                              item_keys=["s", "k"], draw=F.col("draw"))
    metres = distance_m(F.col("s_lat"), F.col("s_lng"), F.col("p_lat"), F.col("p_lng"))
    reach = {}
    for r in rows.select("p", "p_lat", "p_lng").distinct().crossJoin(items).filter(metres <= 25000).collect():
        reach.setdefault(r.p, set()).add(r.k)
    picks = {}
    for r in got.collect():
        assert r.k in reach[r.p]
        picks.setdefault(r.p, []).append((r.draw, r.k))
    assert set(picks) == set(reach) and max(map(len, reach.values())) > 5
    for p, drawn in picks.items():
        order = list(dict.fromkeys(k for _, k in sorted(drawn)))  # each item's draws lie together
        assert [k for k in order] == [k for i, k in enumerate(order) if k not in order[:i]] and len(drawn) == 20
        n = len(reach[p])
        if n <= 20:
            assert set(order) == reach[p]
            assert all(abs(sum(k == q for _, k in drawn) - 20 / n) < 1.01 for q in order)


def test_dense_cells_are_cut(spark, monkeypatch):
    """A crowd on the rim of many circles: no cell that is measured holds more than it may."""
    monkeypatch.setattr(geotree, "MEASURED", 16)
    crowd = spark.range(3000).select(
        F.col("id").alias("p"), (40.2250 + (F.col("id") % 50) * 1e-5).alias("p_lat"), (-74.0 + F.floor(F.col("id") / 50) * 1e-5).alias("p_lng"))
    sites = spark.range(40).select(F.col("id").alias("s"), (40.0 + F.col("id") * 1e-5).alias("s_lat"), F.lit(-74.0).alias("s_lng"))
    made = geotree.tree(crowd, ("p_lat", "p_lng"), 25000.0)
    assert 1 < len(made.levels) < 6
    leaves = made.spots.groupBy(*made.keys(len(made.levels) - 1)).count().agg(F.max("count")).first()[0]
    assert leaves <= 16
    counts = geotree.count_within(sites, crowd, 25000.0, site_key="s", site_at=("s_lat", "s_lng"), point_at=("p_lat", "p_lng"), name="n")
    metres = distance_m(F.col("s_lat"), F.col("s_lng"), F.col("p_lat"), F.col("p_lng"))
    want = {r.s: r.n for r in sites.crossJoin(crowd).filter(metres <= 25000).groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {r.s: r.n for r in counts.collect() if r.n} == want and 0 < min(want.values()) < 3000


def test_nearest_sites(spark):
    sites = spark.createDataFrame([(1, 40.0, -74.0), (2, 40.01, -74.0), (3, 40.02, -74.0)], "s int, s_lat double, s_lng double")
    points = spark.createDataFrame([(7, 40.0, -74.0)], "p int, p_lat double, p_lng double")
    got = geojoin.nearest_sites(sites, points, 25000.0, 2, site_key="s", point_key="p",
                                site_at=("s_lat", "s_lng"), point_at=("p_lat", "p_lng"))
    assert ids(got, "p", "s") == [(7, 1), (7, 2)]


def test_numbered_equals_plain_window(spark):
    # group 0 holds two thirds of the rows
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 5).otherwise(0).alias("g"))
    got = ranking.shuffled_rank(df, "x", ["id"], by=["g"])
    order = F.md5(F.concat_ws("|", F.lit("x"), F.col("id").cast("string")))
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(order)))
    assert ids(got, "g", "id", "rn") == ids(plain, "g", "id", "rn")
    whole = ranking.shuffled_rank(df, "x", ["id"])
    assert sorted(r.rn for r in whole.collect()) == list(range(1, 3001))


def test_large_groups_are_cut(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_TASK", 40)
    test_numbered_equals_plain_window(spark)


def test_numbering_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).mapInArrow(look, "id long")
    assert ranking.shuffled_rank(df, "x", ["id"]).agg(F.max("rn")).first()[0] == 1000 and seen.value == 1000


def test_numbered_descending(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(50)], "id long, need long")
    got = ranking.numbered(df, order=[F.col("need").desc(), F.col("id")])
    want = [r.id for r in df.orderBy(F.col("need").desc(), "id").collect()]
    assert [r.id for r in got.orderBy("rn").collect()] == want


def test_random_slice(spark):
    df = spark.range(1000).select("id")
    got = ranking.random_slice(df, "s", ["id"], 10.0, 25.0)
    assert got.count() == 250
    assert ranking.random_slice(df.limit(3), "s", ["id"], 0.0, 0.1).count() == 1
    assert ranking.random_slice(df.filter("id < 0"), "s", ["id"], 0.0, 50.0).count() == 0


def test_top_per_cuts_groups_before_the_shuffle(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("g"))
    top = ranking.top_per(df, ["g"], [F.col("id").desc()], 2)
    assert ids(top, "g", "id") == [(0, 996), (0, 998), (1, 997), (1, 999)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def _cast_with_large_groups(spark):
    rng = random.Random(3)
    rows = set()
    for f in range(30):
        size = 25 if f < 8 else rng.randint(2, 8)
        rows |= {(f, p) for p in rng.sample(range(40), size)}
    return spark.createDataFrame(sorted(rows), "f int, p int").withColumn(
        "name", F.concat(F.lit("n"), (F.col("p") - F.when(F.col("p") % 7 == 6, 1).otherwise(0)).cast("string"))
    )


def test_pairs_match_brute_force(spark, monkeypatch):
    cast = _cast_with_large_groups(spark)
    a = cast.select("f", F.col("p").alias("p1"), F.col("name").alias("n1"))
    b = cast.select("f", F.col("p").alias("p2"), F.col("name").alias("n2"))
    want = a.join(b, "f").filter("p1 < p2").groupBy("n1", "n2").agg(F.countDistinct("f").alias("n")).collect()
    for least, block in ((1, 512), (3, 3), (5, 7), (9, 512)):
        monkeypatch.setattr(pairs, "BLOCK", block)
        expected = sorted((r.n1, r.n2, r.n) for r in want if r.n >= least)
        got = pairs.shared_group_pairs(cast, group="f", label="name", member="p", min_groups=least)
        assert ids(got, "label_1", "label_2", "shared") == expected
    monkeypatch.setattr(pairs, "PILOTS", 5)
    for best in (1, 4, 10):
        top = sorted((r.n for r in want), reverse=True)[best - 1]
        got = pairs.shared_group_pairs(cast, group="f", label="name", member="p", min_groups=2, best=best)
        assert set(ids(got, "label_1", "label_2", "shared")) >= {(r.n1, r.n2, r.n) for r in want if r.n >= top}


def test_the_largest_group_emits_no_pairs(spark, monkeypatch):
    """A third of all rows in one group: its pairs are looked up, never met."""
    crowd = spark.range(2000).select(F.lit(0).alias("f"), F.col("id").alias("p"))
    rest = spark.range(4000).select((F.col("id") % 800 + 1).cast("int").alias("f"), (F.col("id") * 7 % 1999).alias("p"))
    cast = crowd.union(rest).withColumn("name", F.col("p"))
    met = []
    counted = pairs._counted
    monkeypatch.setattr(pairs, "_counted", lambda entries: met.append(entries.agg(F.max("size")).first()[0]) or counted(entries))
    got = pairs.shared_group_pairs(cast, group="f", label="name", member="p", min_groups=2)
    a, b = cast.select("f", F.col("p").alias("p1")), cast.select("f", F.col("p").alias("p2"))
    want = a.join(b, "f").filter("p1 < p2").groupBy("p1", "p2").agg(F.countDistinct("f").alias("n")).filter("n >= 2")
    assert ids(got, "label_1", "label_2", "shared") == ids(want, "p1", "p2", "n") and max(met) < 10


def test_pairs_are_counted_where_their_lists_are(spark, monkeypatch):
    """Tasks grow with the pairs, a label with very many of them has several, and pairs are not shuffled."""
    cast = _cast_with_large_groups(spark)
    a = cast.select("f", F.col("p").alias("p1"), F.col("name").alias("n1"))
    b = cast.select("f", F.col("p").alias("p2"), F.col("name").alias("n2"))
    want = a.join(b, "f").filter("p1 < p2").groupBy("n1", "n2").agg(F.countDistinct("f").alias("n"))
    monkeypatch.setattr(pairs, "MET_PER_TASK", 40)
    for block in (512, 3):
        monkeypatch.setattr(pairs, "BLOCK", block)
        entries = cast.groupBy(F.col("f").alias("g"), F.col("name").alias("id")).agg(F.min("p").alias("lo"), F.max("p").alias("hi"))
        sizes = entries.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
        got = pairs._counted(entries.join(sizes, "g"))
        assert ids(got, "id_1", "id_2", "shared") == ids(want, "n1", "n2", "n")
        places = got.select("id_1", F.spark_partition_id().alias("at")).distinct().groupBy("id_1").count()
        assert places.agg(F.max("count")).first()[0] > 1
        assert "Exchange" not in got._jdf.queryExecution().sparkPlan().toString().split("Generate explode(after")[0]


def test_pairs_of_even_groups_are_neither_written_nor_looked_up(spark, monkeypatch):
    """Without groups that stand out no pair is written or looked up; rows without a group or a label meet nobody."""
    cast = spark.range(6000).select((F.col("id") % 400).alias("f"), F.pmod(F.hash("id"), F.lit(300)).alias("p"))
    cast = cast.union(spark.range(290).select(F.lit(None).cast("long"), "id")).union(spark.range(390).select("id", F.lit(None)))
    written, kept = [], pairs.materialize
    monkeypatch.setattr(pairs, "materialize", lambda df, label: written.append((label, df.columns)) or kept(df, label))
    monkeypatch.setattr(pairs, "_looked_up", None)
    a, b = cast.select("f", F.col("p").alias("p1")), cast.select("f", F.col("p").alias("p2"))
    want = a.join(b, "f").filter("p1 < p2").groupBy("p1", "p2").agg(F.countDistinct("f").alias("n"))
    for block, least in ((512, 3), (5, 3)):
        monkeypatch.setattr(pairs, "BLOCK", block)
        got = pairs.shared_group_pairs(cast, group="f", label="p", member="p", min_groups=least)
        assert ids(got, "label_1", "label_2", "shared") == ids(want.filter(F.col("n") >= least), "p1", "p2", "n")
    assert not [x for x in written if "id_2" in x[1]]


def test_members_counts_a_repeated_element_once(tables):
    got = membership.members(tables.film.select("film_id", "genre_ids"), "genre_ids", "g")
    assert ids(got, "film_id", "g") == [(1, 1), (1, 2), (2, 2), (2, 99)]


def test_not_in_follows_null_rules(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    other = lambda *v: spark.createDataFrame([(i,) for i in v], "y int")
    for values in ((1,), (1, None), (), (None,)):
        rows.createOrReplaceTempView("l")
        other(*values).createOrReplaceTempView("r")
        want = spark.sql("SELECT x FROM l WHERE x NOT IN (SELECT y FROM r)").collect()
        got = membership.not_in(rows, "x", other(*values)).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_maintenance(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, w int")
    rows = spark.createDataFrame([(2, "B", 99), (3, "C", 30), (3, "A", 31)], "k int, v string, w int")
    assert ids(maintain.insert_if_absent(target, rows, ["k"], [F.col("v")]), "k", "v", "w") == [
        (1, "a", 10), (2, "b", 20), (3, "A", 31)]
    unique = rows.filter("v <> 'A'")
    assert ids(maintain.upsert(target, unique, ["k"], ["v"]), "k", "v", "w") == [(1, "a", 10), (2, "B", 20), (3, "C", 30)]
    changed = maintain.update_from(target, unique, ["k"], {"v": "v", "w": "w"}, only_if=F.col("w") > F.lit(50))
    assert ids(changed, "k", "v", "w") == [(1, "a", 10), (2, "b", 20)]
    assert ids(maintain.update_from(target, unique, ["k"], {"w": "w"}), "k", "w") == [(1, 10), (2, 99)]
    assert ids(maintain.delete_keys(target, unique, ["k"]), "k") == [(1,)]
    numbered = maintain.with_next_ids(unique.select("v", "w"), "k", target, ["v"])
    assert sorted(r.k for r in numbered.collect()) == [3, 4]
    empty = maintain.with_next_ids(unique.select("v", "w"), "k", target.limit(0), ["v"])
    assert sorted(r.k for r in empty.collect()) == [1, 2]
    before, after = maintain.row_counts({"x": target, "y": rows}), maintain.row_counts({"x": rows})
    assert ids(maintain.count_delta(before, after), "label", "delta") == [("x", 1), ("y", -3)]


def test_update_to_null_is_kept(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    change = spark.createDataFrame([(1, None)], "k int, v string")
    assert ids(maintain.update_from(target, change, ["k"], {"v": "v"}), "k", "v") == [(1, None)]
    assert ids(maintain.upsert(target, change, ["k"], ["v"]), "k", "v") == [(1, None)]


def test_newer_than_is_inclusive_and_empty_without_target(tables):
    mark = tables.film.filter("film_id = 4")
    assert ids(maintain.newer_than(tables.film, "release_date", mark), "film_id") == [(1,), (4,)]
    assert maintain.newer_than(tables.film, "release_date", tables.film.limit(0)).count() == 0


def test_protect_column(spark, tables):
    update = tables.inventory.withColumn(
        "circulation_start", F.when(F.col("inventory_id") == 11, F.lit(None)).otherwise(F.col("circulation_start")).cast("timestamp_ntz"))
    kept, refused = maintain.protect_column(update, tables.inventory, "inventory_id", "circulation_start")
    assert kept.filter(F.col("circulation_start") != F.lit("2024-01-01").cast("timestamp_ntz")).count() == 0
    assert kept.filter(F.col("circulation_start").isNull()).count() == 0
    assert ids(refused, "inventory_id") == [(11,)]


def test_checks(spark, tables):
    assert checks.duplicate_keys(tables.film_cast, ["film_id"]).count() == 4
    assert checks.orphans(tables.rental, "customer_id", tables.customer.filter("customer_id <> 6"), "customer_id").count() == 2
    ranked = spark.createDataFrame([("NR",), ("G",), ("X",)], "r string").select("r", checks.rating_rank(F.col("r")).alias("n"))
    assert {r.r: r.n for r in ranked.collect()} == {"NR": 6, "G": 1, "X": None}
    assert checks.outside(tables.film, "rating", checks.RATINGS).count() == 0


def test_round_robin(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "rn long, item string")
    slots = spark.createDataFrame([(1, "x"), (2, "y")], "slot_rank long, slot string")
    assert ids(ranking.dealt_round_robin(items, slots, F.lit(2)), "item", "slot") == [("a", "x"), ("b", "y"), ("c", "x")]
    assert ranking.dealt_round_robin(items, slots.limit(0), F.lit(0)).count() == 0
