"""Pairs of members that share many groups, counted by tiles of the groups' members."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from kiosklake.operators.ranking import top_per
from kiosklake.session import materialize

#: Labels of a group in one block: a task meets at most this many times as many pairs at once.
BLOCK = 512
#: Labels, those of most groups, whose pairs are counted first to learn how good the best are.
PILOTS = 32
#: Places of pairs (a label counts with every label of its groups) that a task counts, about.
MET_PER_TASK = 4_000_000


def shared_group_pairs(
    rows: DataFrame, *, group: str, label: str, member: str, min_groups: int, best: int | None = None,
) -> DataFrame:
    """``(label_1, label_2, shared)`` for labels that share at least ``min_groups`` groups.

    ``label`` is best a number: pairs are grouped by it. A group counts for an ordered label pair
    when it holds a member of the first label with a smaller id than some member of the second.

    With ``best`` only the pairs that can be among the ``best`` with the most groups are sure to
    be in the result, with all that tie with them: the pairs of a few frequent labels are counted
    first, the best of them set a number of groups to reach, and labels of fewer groups drop out.

    Where the ``min_groups - 1`` largest groups make half of all meetings they never emit their pairs: whoever
    shares ``min_groups`` also meets in some other group, and the large ones are looked up for the pairs that
    can still get there. Of every other group the labels are dealt to blocks, and meet block by block, so a
    group of any size is spread over as many tasks as it has tiles.
    """
    # per group and label only the smallest and largest member id matter
    entries = rows.groupBy(F.col(group).alias("g"), F.col(label).alias("id")).agg(
        F.min(member).alias("lo"), F.max(member).alias("hi")
    )
    # what has no group or no label meets nobody
    entries = materialize(entries.filter(F.col("g").isNotNull() & F.col("id").isNotNull()), "pair-entries")
    size = F.count(F.lit(1))
    reach = materialize(entries.groupBy("id").agg(size.alias("n")), "pair-labels")
    enough = reach.filter(F.col("n") >= min_groups)
    least = min_groups if best is None else max(min_groups, _reached(entries, enough, best))
    kept = entries
    if reach.agg(F.min("n").alias("n")).first()["n"] not in range(least, 1 << 62):  # else no label drops out
        kept = entries.join(reach.filter(F.col("n") >= least).select("id"), "id", "left_semi")
        kept = materialize(kept, "pair-kept")  # sized, met, and looked up
    sizes = materialize(kept.groupBy("g").agg(size.alias("size")), "pair-sizes")
    aside = top_per(sizes, [], [F.col("size").desc(), F.col("g").desc()], min_groups - 1)
    aside = materialize(aside, "pair-aside")
    if 2 * _met(aside) <= _met(sizes):
        total = _counted(_with_sizes(kept, sizes))
    else:
        rest, aside = sizes.join(aside, "g", "left_anti"), aside.select("g")
        found = _counted(_with_sizes(kept.join(aside, "g", "left_anti"), rest)).filter(F.col("shared") > least - min_groups)
        found = materialize(found, "pair-found")
        more = _looked_up(found, kept.join(aside, "g", "left_semi"))
        total = found.unionByName(more).groupBy("id_1", "id_2").agg(F.sum("shared").alias("shared"))
    return total.filter(F.col("shared") >= least).select(
        F.col("id_1").alias("label_1"), F.col("id_2").alias("label_2"), "shared"
    )


def _met(sizes: DataFrame) -> int:
    """Places of pairs in groups of these sizes: a label counts with every label of its groups."""
    return sizes.agg(F.sum(F.col("size") * F.col("size")).alias("n")).first()["n"] or 0


def _reached(entries: DataFrame, reach: DataFrame, best: int) -> int:
    """How many groups the last of the ``best`` pairs of frequent labels shares; 0 if there are fewer."""
    pilots = top_per(reach, [], [F.col("n").desc(), F.col("id")], max(PILOTS, math.isqrt(4 * best) + 1)).select("id")
    few = materialize(entries.join(pilots, "id", "left_semi"), "pair-pilots")
    first = _counted(_with_sizes(few, few.groupBy("g").agg(F.count(F.lit(1)).alias("size"))))
    last = top_per(first, [], [F.col("shared").desc(), F.col("id_1"), F.col("id_2")], best).agg(
        F.count(F.lit(1)).alias("n"), F.min("shared").alias("least")
    ).first()
    return last["least"] if last["n"] == best else 0


def _with_sizes(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """Entries with the ``size`` of groups of more than a block, 1 for the others."""
    large = materialize(sizes.filter(F.col("size") > BLOCK), "pair-large")  # no more than one for BLOCK entries
    return entries.join(large, "g", "left").withColumn("size", F.coalesce("size", F.lit(1)))


def _counted(entries: DataFrame) -> DataFrame:
    """``(id_1, id_2, shared)`` of all ordered pairs that meet in a group; ``size`` tells groups of many labels.

    The labels of a group are put into rows, one for each block of it, and written once. A label gets, tile by
    tile, the list of the labels after it. Lists are dealt by first label, to tasks of which there are more the
    more pairs meet, and only there taken apart and counted: pairs are never shuffled. The second labels of a
    first label with very many pairs are dealt to several tasks.
    """
    cut = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("id"), cut).cast("int")
    # greatest hi first, so that those after a label are the first few
    members = F.sort_array(F.collect_list(F.struct("hi", "lo", "id")), asc=False)
    blocks = entries.groupBy("g", "size", own.alias("own")).agg(members.alias("m"))
    blocks = materialize(blocks.withColumn("size", F.when(F.col("size") > BLOCK, F.col("size")).otherwise(F.size("m"))), "pair-blocks")
    every = blocks.agg(F.sum(F.size("m") * F.col("size")).alias("met"), F.max("size").alias("size")).first()
    tasks = math.ceil((every["met"] or 0) / MET_PER_TASK) + int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    loads = blocks.select(F.explode("m.id").alias("id_1"), "size").groupBy("id_1").agg(F.sum("size").alias("met"))
    busy = loads.filter(F.col("met") > MET_PER_TASK)  # no more labels than tasks
    busy = materialize(busy.select("id_1", F.ceil(F.col("met") / MET_PER_TASK).cast("int").alias("pieces")), "pair-busy")
    tiles = blocks.filter(F.col("size") <= BLOCK).select("m", F.col("m.hi").alias("his"), F.col("m.id").alias("ids"))
    if (every["size"] or 0) > BLOCK:
        many, each = blocks.filter(F.col("size") > BLOCK), F.explode(F.sequence(F.lit(0), cut - 1))
        first = many.select("g", F.col("own").alias("i"), each.alias("j"), "m")
        second = many.select("g", each.alias("i"), F.col("own").alias("j"), F.col("m.hi").alias("his"), F.col("m.id").alias("ids"))
        tiles = tiles.unionByName(first.join(second, ["g", "i", "j"]).select("m", "his", "ids"))
    one = tiles.select(F.explode("m").alias("one"), "his", "ids")
    place = F.array_position("his", F.col("one.lo"))
    longer = F.when(place > 0, place - 1).otherwise(F.size(F.filter("his", lambda hi: hi > F.col("one.lo")))).cast("int")
    lists = one.select(F.col("one.id").alias("id_1"), F.slice("ids", F.lit(1), longer).alias("after"))
    lists, keys = lists.filter(F.size("after") > 0), ["id_1"]
    if busy.first() is not None:
        dealt = lists.join(busy, "id_1", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
        dealt = dealt.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        of_piece = F.filter("after", lambda other: F.pmod(F.xxhash64(other), F.col("pieces")) == F.col("piece"))
        lists = dealt.select("id_1", "piece", F.when(F.col("pieces") == 1, F.col("after")).otherwise(of_piece).alias("after"))
        keys = ["id_1", "piece"]
    met = lists.repartition(tasks, *keys).select(*keys, F.explode("after").alias("id_2"))
    return met.groupBy(*keys, "id_2").agg(F.count(F.lit(1)).alias("shared")).select("id_1", "id_2", "shared")


def _looked_up(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """How many of the groups of ``entries`` each pair shares."""
    first = entries.select("g", F.col("id").alias("id_1"), F.col("lo").alias("lo_1"))
    second = entries.select("g", F.col("id").alias("id_2"), F.col("hi").alias("hi_2"))
    met = pairs.select("id_1", "id_2").join(first, "id_1").join(second, ["g", "id_2"]).filter(_precedes())
    return met.groupBy("id_1", "id_2").agg(F.count(F.lit(1)).alias("shared"))


def _precedes() -> Column:
    return F.col("lo_1") < F.col("hi_2")
