"""Stock jobs: proximity pools, allocation, rebalancing and pairing discs with customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kiosklake.functions import periods
from kiosklake.functions.numbers import digest_steps, draw, key_text, next_key, steps_reached
from kiosklake.operators.availability import IN_CIRCULATION, available_discs
from kiosklake.operators.geojoin import radius_join
from kiosklake.operators.geotree import pick_within
from kiosklake.operators.maintain import append, emptied, update_from, with_next_ids
from kiosklake.operators.membership import not_in
from kiosklake.operators.ranking import dealt_round_robin, numbered, paired_by_rank, shuffled_rank
from kiosklake.plans.reports import NEARBY_M, nearby_customer_counts, proportional_share, store_targets
from kiosklake.session import dealt, materialize
from kiosklake.sources.tables import Tables


def store_pool(t: Tables, radius_m: float = NEARBY_M, customers: DataFrame | None = None) -> DataFrame:
    """``(store_id, customer_id)`` pairs within the radius."""
    rows = t.customer if customers is None else customers
    return radius_join(
        t.store.select("store_id", F.col("lat").alias("s_lat"), F.col("lng").alias("s_lng")),
        rows.select("customer_id", F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng")),
        radius_m,
        site_key="store_id", site_at=("s_lat", "s_lng"),
        point_key="customer_id", point_at=("c_lat", "c_lng"),
    ).select("store_id", "customer_id")


def pool_sizes(t: Tables, radius_m: float = NEARBY_M) -> DataFrame:
    """Active customers near each store that has any; pairs are not formed."""
    active = t.customer.filter(F.col("activebool"))
    near = nearby_customer_counts(t, radius_m, active)
    return near.filter(F.col("nearby_customers") > 0).withColumnRenamed("nearby_customers", "local_count")


def random_near_store(
    t: Tables, rows: DataFrame, key: str, seed: str, radius_m: float = NEARBY_M
) -> DataFrame:
    """One seeded random store near the customer of every row; rows without one drop out.

    ``rows`` has ``key`` and ``customer_id``. Stores are drawn down a tree of counted cells,
    so customers are never listed with the stores in their reach.
    """
    placed = rows.join(t.customer.select("customer_id", F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng")), "customer_id")
    stores = t.store.select("store_id", F.col("lat").alias("s_lat"), F.col("lng").alias("s_lng"))
    return pick_within(
        placed, stores, radius_m, row_at=("c_lat", "c_lng"), item_at=("s_lat", "s_lng"), item_keys=["store_id"],
        draw=draw(seed, F.col(key)),
    ).drop("c_lat", "c_lng")


def day_targets(t: Tables, total: int, radius_m: float = NEARBY_M) -> DataFrame:
    """A chain-wide rental target split over stores by the size of their pools."""
    pools = materialize(pool_sizes(t, radius_m), "pool-sizes")  # summed and split
    whole = pools.agg(F.sum("local_count").alias("n")).scalar()
    return pools.withColumn(
        "target", proportional_share(F.lit(total), F.col("local_count"), whole)
    )


def pair_rentals(t: Tables, day: str, total: int, seed: str = "pair", radius_m: float = NEARBY_M) -> DataFrame:
    """Proposed rentals for a day: n-th free customer of a store with its n-th free disc.

    A customer near several stores is first given one of them at random.
    """
    lo, hi = periods.moment(day), periods.shift(day, days=1)
    # who and what is out on the day: asked three times below
    out = materialize(t.touching("rental", lo, hi).select("customer_id", "inventory_id"), "out")
    targets = day_targets(t, total, radius_m).filter(F.col("target") > 0).select("store_id", "target")
    targets = materialize(targets, "day-targets")  # joined to customers and to discs
    idle = t.customer.filter(F.col("activebool")).select("customer_id").join(
        out.select("customer_id").distinct(), "customer_id", "left_anti"
    )
    placed = random_near_store(
        t, idle.withColumn("who", F.col("customer_id")), "who", f"{seed}-home", radius_m
    ).select("store_id", "customer_id")
    released = t.film.filter(F.col("release_date") <= F.lit(day).cast("date")).select("film_id")
    discs = (
        t.inventory.filter(F.col("status_id") == IN_CIRCULATION)
        .select("inventory_id", "store_id", "film_id")
        .join(released, "film_id", "left_semi")
        .join(out.select("inventory_id").distinct(), "inventory_id", "left_anti")
        .select("inventory_id", "store_id")
    )

    def first(rows: DataFrame, key: str) -> DataFrame:
        ranked = shuffled_rank(rows.join(targets, "store_id"), f"{seed}-{key}", [key], by=["store_id"])
        return ranked.filter(F.col("rn") <= F.col("target")).drop("target")

    return paired_by_rank(first(placed, "customer_id"), first(discs, "inventory_id"), ["store_id"])


# --- rebalancing -------------------------------------------------------------


def rebalance_moves(
    t: Tables, max_moves: int = 10_000, seed: str = "rebalance", radius_m: float = NEARBY_M
) -> DataFrame:
    """Moves of free discs from over- to understocked stores: disc, from, to.

    Overstocked stores give up to their excess; the discs are dealt in turn to the
    understocked stores, neediest first (ties by store id).
    """
    levels = materialize(store_targets(t, radius_m), "store-targets")  # one row per store, read often
    have, want = F.col("current_inventory"), F.col("target_inventory")
    # buffers of 10 % either way, in whole numbers
    under = levels.filter(have * 10 < want * 9).select("store_id", (want - have).alias("need"))
    over = levels.filter(have * 10 > want * 11).select("store_id", (have - want).alias("excess"))
    slots = numbered(under, order=[F.col("need").desc(), F.col("store_id")], name="slot_rank").select("slot_rank", F.col("store_id").alias("to_store"))
    total = under.agg(F.count(F.lit(1)).alias("n")).scalar()
    free = available_discs(t).select("inventory_id", "store_id").join(over, "store_id")
    given = shuffled_rank(free, f"{seed}-store", ["inventory_id"], by=["store_id"]).filter(
        F.col("rn") <= F.col("excess")
    )
    given = materialize(given.select("inventory_id", "store_id"), "given-up")
    queue = shuffled_rank(given, f"{seed}-all", ["inventory_id"]).filter(F.col("rn") <= max_moves)
    return dealt_round_robin(queue, slots, total).select(
        "inventory_id", F.col("store_id").alias("from_store"), "to_store"
    )


def rebalance_inventory(
    t: Tables, as_of, max_moves: int = 10_000, seed: str = "rebalance", radius_m: float = NEARBY_M
) -> tuple[Tables, DataFrame]:
    """Apply the moves. Returns the next tables and the moves."""
    moves = rebalance_moves(t, max_moves, seed, radius_m)
    inventory = update_from(
        t.inventory, moves, ["inventory_id"], {"store_id": "to_store"}, stamp=as_of
    )
    return t.replaced(inventory=inventory), moves


# --- first allocation --------------------------------------------------------

# Per tier the share of stores, the fewest copies and the number of steps above.
TIERS = {"A": (1.0, 10, 5), "B": (0.6, 5, 3), "C": (0.3, 2, 3), "D": (0.1, 1, 2)}
_SALTS = 64


def film_tiers(film: DataFrame, as_of) -> DataFrame:
    """Films by popularity, age and rating: A (new or popular) to D (long tail)."""
    def newer(years: int):
        return F.col("release_date").cast("timestamp_ntz") > periods.shift(as_of, years=-years)

    popularity = F.col("popularity")
    tier = (
        F.when((popularity >= 100) | newer(1), "A")
        .when((popularity >= 30) | newer(3), "B")
        .when((popularity >= 10) | (F.col("vote_average") >= F.lit(7.0).cast("float")), "C")
        .otherwise("D")
    )
    return film.select("film_id", tier.alias("tier"))


def _lot(tier: Column, salt: Column) -> Column:
    """A number for a tier and a salt: one key, which stays one where all films are of a tier."""
    return F.array_position(F.array(*map(F.lit, TIERS)), tier) * _SALTS + salt


def allocation(t: Tables, as_of, seed: str = "stock", clear_existing: bool = False) -> DataFrame:
    """Copies per film and store for films without any disc.

    One draw per store decides which tiers it takes part in. Films meet the stores
    of their tier by an equi-join on a lot, which is a tier and a salt: a tier is a hot
    key, so its films are spread over salts and its short store list is repeated per salt.
    """
    inventory = emptied(t.inventory) if clear_existing else t.inventory
    films = film_tiers(not_in(t.film, "film_id", inventory.select("film_id")), as_of)
    # what a film or a store adds to the text of a pair's digest is made once, not per pair
    films = films.withColumn("film_text", key_text(f"{seed}-copies", F.col("film_id")))
    # a film makes a row per store, so films are dealt by number and not by their few bytes
    salt = F.pmod(F.xxhash64("film_id"), F.lit(_SALTS)).cast("int")
    films = dealt(films.withColumn("lot", _lot(F.col("tier"), salt)), "lot")
    chance = draw(f"{seed}-store", F.col("store_id"))
    tiers = F.array(*[
        F.struct(
            F.lit(name).alias("tier"), F.lit(share).alias("share"),
        )
        for name, (share, _, _) in TIERS.items()
    ])
    takes = (
        t.store.select("store_id", chance.alias("chance"), F.explode(tiers).alias("d"))
        .filter((F.col("d.share") >= 1.0) | (F.col("chance") < F.col("d.share")))
        .select("store_id", next_key(F.col("store_id")).alias("store_text"), "d.tier")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        .select("store_id", "store_text", _lot(F.col("tier"), F.col("salt")).alias("lot"))
    )
    # never by broadcast: the stores are listed once per lot, which their file's size does not tell
    pairs = films.join(dealt(takes, "lot").hint("merge"), "lot").withColumn("digest", F.md5(F.concat("film_text", "store_text")))
    copies = None
    for name, (_, low, steps) in TIERS.items():
        drawn = F.lit(low) + steps_reached(F.col("digest"), [F.lit(x) for x in digest_steps(low, low + steps)])
        copies = F.when(F.col("tier") == name, drawn) if copies is None else copies.when(F.col("tier") == name, drawn)
    return pairs.select("film_id", "store_id", "tier", copies.alias("copies"))


def populate_inventory(
    t: Tables, as_of, seed: str = "stock", clear_existing: bool = False
) -> tuple[Tables, DataFrame]:
    """Create the allocated discs. Clearing also empties rentals and payments."""
    base = t
    if clear_existing:
        base = t.replaced(
            inventory=emptied(t.inventory), rental=emptied(t.rental), payment=emptied(t.payment)
        )
    plan = allocation(t, as_of, seed, clear_existing)
    now = periods.moment(as_of)
    # sequence(1, 0) counts down in Spark, so zero copies must be dropped first
    discs = (
        plan.filter(F.col("copies") >= 1)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("film_id", "store_id", "copy")
    )
    added = with_next_ids(discs, "inventory_id", base.inventory, ["film_id", "store_id", "copy"])
    # what all discs share is added behind the numbering, which sorts and writes every row
    alike = {"status_id": F.lit(IN_CIRCULATION), "circulation_start": now, "last_update": now}
    added = added.withColumns(alike).select(*base.inventory.columns)
    return base.replaced(inventory=append(base.inventory, added)), added
