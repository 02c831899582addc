"""Row numbers, per-group top-k and pairing by rank, without giant single groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kiosklake.functions.numbers import shuffle_key
from kiosklake.session import materialize


def top_per(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of every group (of the whole frame when ``by`` is empty).

    Filtering ``row_number() <= k`` lets the optimizer keep only ``k`` rows per
    group in each map task, so a hot group is cut down before its shuffle.
    ``order`` must end in a unique key.
    """
    if not by:
        return df.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def first_per(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    return top_per(df, by, order, 1)


#: Rows of one group that a single task may number.
ROWS_PER_TASK = 1_000_000


def _with_offsets(placed: DataFrame, name: str) -> DataFrame:
    """Numbers over all partitions from ``_part`` and the place ``_at`` of each row in its partition.

    ``placed`` is written already, so that counting reads one column of it and nothing is
    worked out twice. There is one count per partition; offsets add up within blocks of 256
    of them, and then over the blocks.
    """
    counts = placed.groupBy("_part").agg(F.max("_at").alias("_n")).withColumn("_block", F.floor(F.col("_part") / 256))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = earlier.partitionBy("_block").orderBy("_part")
    blocks = counts.groupBy("_block").agg(F.sum("_n").alias("_all")).withColumn("_one", F.lit(1))
    ahead = earlier.partitionBy("_one").orderBy("_block")
    blocks = blocks.withColumn("_ahead", F.coalesce(F.sum("_all").over(ahead), F.lit(0))).select("_block", "_ahead")
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(blocks, "_block")
    offsets = offsets.select("_part", (F.col("_before") + F.col("_ahead")).alias("_before"))
    return (
        placed.join(offsets, "_part")
        .withColumn(name, (F.col("_at") + F.col("_before")).cast("bigint"))
        .drop("_part", "_at", "_before")
    )


def _placed(dealt: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Rows of each partition in order, with the partition and their place in it, written."""
    at = F.monotonically_increasing_id()
    rows = dealt.sortWithinPartitions(*order).withColumn("_at", at)
    # an id holds the partition above 33 bits that count its rows
    rows = rows.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    return materialize(rows.drop("_digest"), label)


def numbered(df: DataFrame, *, order: list[Column], name: str = "rn") -> DataFrame:
    """``row_number()`` over the whole frame by ``order``, which ends in a unique key.

    Rows are dealt by ranges of the order and written once; each partition's rows then get
    the number of rows in earlier partitions added. No task holds more than its range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _with_offsets(_placed(df.repartitionByRange(parts, *order), order, "ranges"), name)


def shuffled_rank(
    df: DataFrame,
    seed: str,
    keys: list[str],
    *,
    by: tuple[str, ...] | list[str] = (),
    name: str = "rn",
) -> DataFrame:
    """Row number in a seeded random order; ``keys`` identify a row.

    The order is that of a digest, which is uniform: over a whole frame its leading digits
    deal rows evenly without a sample, and the input is read once. Within groups only those
    of more than ``ROWS_PER_TASK`` rows are cut, into digits enough for their counted rows.
    """
    digest = F.col("_digest")
    order = [digest, *[F.col(k) for k in keys]]
    df = df.withColumn("_digest", shuffle_key(seed, *[F.col(k) for k in keys]))
    if not by:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        share = F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint")
        # the digits' bytes have their order and half their size
        df = df.withColumn("_to", F.floor(share * parts / 16**7).cast("int")).withColumn("_digest", F.unhex(digest))
        dealt = df.repartitionById(parts, F.col("_to")).drop("_to")
        return _with_offsets(_placed(dealt, order, "shuffled"), name)
    return _ranked_in_groups(materialize(df, "to-rank"), list(by), order, name).drop("_digest")


def _ranked_in_groups(rows: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """Numbers within groups; a very large group is cut by leading digits of ``_digest``."""
    size = F.count(F.lit(1))
    large = rows.groupBy(*by).agg(size.alias("_n")).filter(F.col("_n") > ROWS_PER_TASK)
    digits = F.ceil(F.log(16.0, F.col("_n") / F.lit(float(ROWS_PER_TASK)))).cast("int")
    large = large.select(*by, F.greatest(digits, F.lit(1)).alias("_digits"))
    cut = rows.join(large, by, "left").withColumn(
        "_piece", F.when(F.col("_digits").isNull(), F.lit("")).otherwise(F.expr("substring(_digest, 1, _digits)"))
    )
    counts = cut.filter(F.col("_digits").isNotNull()).groupBy(*by, "_piece").agg(size.alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy(*by, "_piece").orderBy(*order))
    return (
        cut.withColumn("_i", inner)
        .join(offsets, [*by, "_piece"], "left")
        .withColumn(name, (F.col("_i") + F.coalesce(F.col("_before"), F.lit(0))).cast("bigint"))
        .drop("_i", "_before", "_piece", "_digits")
    )


def pick_random(df: DataFrame, by: list[str], seed: str, keys: list[str], k: int = 1) -> DataFrame:
    """``k`` seeded random rows per group (``ORDER BY random() LIMIT k`` per row)."""
    digest = shuffle_key(seed, *[F.col(c) for c in [*by, *keys]])
    return top_per(df, by, [digest, *[F.col(c) for c in keys]], k)


def first_two(df: DataFrame, by: list[str], seed: str, item: str, name: str) -> DataFrame:
    """Per group an array of up to two seeded random items, in their random order."""
    digest = shuffle_key(seed, *[F.col(c) for c in [*by, item]])
    kept = top_per(df.withColumn("_digest", digest), by, [F.col("_digest"), F.col(item)], 2)
    pairs = F.sort_array(F.collect_list(F.struct("_digest", item)))
    return kept.groupBy(*by).agg(F.transform(pairs, lambda p: p[item]).alias(name))


def paired_by_rank(left: DataFrame, right: DataFrame, by: list[str], rank: str = "rn") -> DataFrame:
    """n-th left row with n-th right row of the same group."""
    return left.join(right, [*by, rank])


def dealt_round_robin(items: DataFrame, slots: DataFrame, total: Column) -> DataFrame:
    """Items (column ``rn``) dealt in turn to slots (column ``slot_rank`` 1..total); none without slots."""
    dealt = items.withColumn("slot_rank", (F.col("rn") - 1) % F.nullif(total, F.lit(0)) + 1)
    return dealt.join(slots, "slot_rank")


def random_slice(
    df: DataFrame, seed: str, keys: list[str], skip_pct: float, take_pct: float
) -> DataFrame:
    """Seeded slice of a frame: skip ``skip_pct`` % of its rows, take the next ``take_pct`` %.

    At least one row is taken from a non-empty frame.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()

    def share(pct: float, least: int) -> Column:
        return F.greatest(
            F.lit(least), F.round(total * F.lit(str(pct)).cast("decimal(9,4)") / 100, 0)
        ).cast("bigint")

    skip, take = share(skip_pct, 0), share(take_pct, 1)
    ranked = shuffled_rank(df, seed, keys, name="_slice")
    return ranked.filter((F.col("_slice") > skip) & (F.col("_slice") <= skip + take)).drop("_slice")
