"""Token counts of the documents in flat token files that have no index.

A token file is a run of fixed-width ids in which one reserved id ends each document. It is
read in blocks that know nothing of documents. Every block is searched on its own for the end
id; a prefix scan over the blocks' summaries then stitches the documents that cross blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kiosklake.llm.common import prepare
from kiosklake.session import scratch_path

#: Tokens in a block, blocks in a group of the prefix scan, ids in a roster row.
BLOCK_TOKENS, GROUP, ROSTER = 1 << 18, 1024, 4096
_KIND = {2: "<u2", 4: "<u4"}


@dataclass(frozen=True)
class Shards:
    """``blocks``: (shard, block, data) without any index. ``roster``: ids in their order in a shard."""

    blocks: DataFrame
    roster: DataFrame


def write_shards(coded: DataFrame, *, end: int, width: int = 2, block: int = BLOCK_TOKENS) -> Shards:
    """Write ``ids`` (packed 32-bit, as ``byte_bpe.encode`` gives them) as flat shards of blocks.

    Each task writes one shard: its documents' ids, each followed by ``end``, cut every
    ``block`` tokens wherever that falls. The roster, kept apart, lists the ``doc_id`` of
    each document in order. Both lie in the shared folder. Documents without ids are a lone
    end id. No shuffle. An id that ``width`` bytes cannot hold raises ``ValueError``.
    """
    prepare(coded.sparkSession)
    kind, most = _KIND[width], (1 << 8 * width) - 1
    schema = "shard long, block long, data binary, roster array<long>"
    stop = np.array([end], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        held, blocks, names, named = np.zeros(0, kind), 0, [], 0

        def rows(data: list, rosters: list, first: int) -> pa.RecordBatch:
            n = max(len(data), len(rosters))
            return pa.RecordBatch.from_arrays([
                pa.array([shard] * n, pa.int64()), pa.array(range(first, first + n * (ROSTER if rosters else 1), ROSTER if rosters else 1), pa.int64()),
                pa.array(data or [None] * n, pa.binary()), pa.array(rosters or [None] * n, pa.list_(pa.int64())),
            ], ["shard", "block", "data", "roster"])

        for batch in batches:
            names += batch.column("doc_id").to_pylist()
            ids = np.frombuffer(b"".join((x or b"") + stop for x in batch.column("ids").to_pylist()), "<u4")
            if len(ids) and ids.max() > most:
                raise ValueError(f"a token id does not fit in {width} bytes")
            held = np.concatenate([held, ids.astype(kind)])
            full = len(held) // block
            if full:
                yield rows([held[i * block : (i + 1) * block].tobytes() for i in range(full)], [], blocks)
                held, blocks = held[full * block :], blocks + full
            while len(names) >= ROSTER:
                yield rows([], [names[:ROSTER]], named)
                names, named = names[ROSTER:], named + ROSTER
        if len(held):
            yield rows([held.tobytes()], [], blocks)
        if names:
            yield rows([], [names], named)

    spark = coded.sparkSession
    path = scratch_path(spark, "token-shards")
    coded.select("doc_id", "ids").mapInArrow(work, schema).write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    return Shards(
        stored.filter(F.col("data").isNotNull()).select("shard", "block", "data"),
        stored.filter(F.col("roster").isNotNull()).select("shard", F.col("block").alias("first"), "roster"),
    )


def read_token_files(spark: SparkSession, path: str, *, width: int = 2, block: int = BLOCK_TOKENS) -> DataFrame:
    """Raw token files below ``path`` as (shard, block, data); the shard is the file's path."""
    files = prepare(spark).read.format("binaryFile").load(path).filter(F.col("length") > 0)
    size = block * width
    places = F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))
    at = files.select(F.col("path").alias("shard"), "content", F.explode(places).alias("block"))
    data = F.substring("content", (F.col("block") * size + 1).cast("int"), F.lit(size))
    return at.select("shard", "block", data.alias("data"))


def _search(blocks: DataFrame, end: int, width: int) -> DataFrame:
    """One summary row per block: tokens, ends, tokens before the first and after the last end,
    and the lengths of the documents that lie inside."""
    shard = blocks.schema["shard"].dataType.simpleString()
    schema = f"shard {shard}, block long, n long, ends long, head long, tail long, inner array<long>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("n", "ends", "head", "tail", "inner")}
            for data in batch.column("data").to_pylist():
                if len(data or b"") % width:
                    raise ValueError("a token file ends inside a token")
                ids = np.frombuffer(data or b"", _KIND[width])
                at = np.flatnonzero(ids == end)
                found = (len(ids), len(at), at[0] if len(at) else len(ids), len(ids) - 1 - at[-1] if len(at) else len(ids), np.diff(at) - 1)
                for values, value in zip(out.values(), found):
                    values.append(value)
            made = [pa.array([int(x) for x in out[name]], pa.int64()) for name in ("n", "ends", "head", "tail")]
            inner = pa.array([x.tolist() for x in out["inner"]], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("block"), *made, inner], [f.split()[0] for f in schema.split(", ")])

    return blocks.select("shard", "block", "data").mapInArrow(work, schema)


def _scan(summaries: DataFrame, by: list[str], order: str) -> DataFrame:
    """Exclusive prefix scan of (tokens, ends, place after the last end) over rows with n, ends and tail."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    to_here = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after_end = F.when(F.col("ends") > 0, F.sum("n").over(to_here) - F.col("tail"))
    placed = summaries.withColumn("_after", after_end)
    none = F.lit(0).cast("long")
    return placed.withColumns({
        "_n_before": F.coalesce(F.sum("n").over(before), none),
        "_ends_before": F.coalesce(F.sum("ends").over(before), none),
        "_after_before": F.max("_after").over(before),
    }).drop("_after")


def count_tokens(blocks: DataFrame, *, end: int, width: int = 2) -> DataFrame:
    """``(shard, ordinal, n_tokens, ended)`` of every document in the shards.

    ``ordinal`` counts from 0 in a shard. Two ends in a row are a document of 0 tokens;
    tokens after the last end are a document with ``ended`` false. Blocks of a shard are
    taken in the order of ``block``; null or empty data is a block without tokens. An empty
    table gives an empty table. Only summaries are shuffled, and the prefix scan runs in
    groups of blocks first, so a shard of any size is no single task's work.
    """
    prepare(blocks.sparkSession)
    group = F.floor(F.col("block") / GROUP)
    inside = _scan(_search(blocks, end, width).withColumn("_group", group), ["shard", "_group"], "block")
    whole = inside.groupBy("shard", "_group").agg(
        F.sum("n").alias("n"), F.sum("ends").alias("ends"),
        F.max(F.when(F.col("ends") > 0, F.col("_n_before") + F.col("n") - F.col("tail"))).alias("_last"),
    )
    groups = _scan(whole.withColumn("tail", F.col("n") - F.coalesce("_last", F.lit(0))), ["shard"], "_group").select(
        "shard", "_group",
        (F.col("_n_before") - F.coalesce("_after_before", F.lit(0))).alias("_carry"),
        F.col("_ends_before").alias("_base"),
        (F.lead("_group").over(Window.partitionBy("shard").orderBy("_group")).isNull()).alias("_final"),
    )
    joined = inside.join(groups, ["shard", "_group"])
    carried = F.col("_n_before") + F.coalesce(-F.col("_after_before"), F.col("_carry"))
    final = F.col("_final") & F.lead("block").over(Window.partitionBy("shard", "_group").orderBy("block")).isNull()
    open_end = final & (F.when(F.col("ends") > 0, F.col("tail")).otherwise(carried + F.col("n")) > 0)
    closed = F.when(F.col("ends") > 0, F.concat(F.array(carried + F.col("head")), "inner")).otherwise(
        F.array().cast("array<long>")
    )
    unfinished = F.when(F.col("ends") > 0, F.col("tail")).otherwise(carried + F.col("n"))
    lengths = _lengths(closed, open_end, unfinished)
    return joined.select("shard", (F.col("_base") + F.col("_ends_before")).alias("_start"), lengths.alias("_all")).select(
        "shard", "_start", F.posexplode("_all")
    ).select("shard", (F.col("_start") + F.col("pos")).alias("ordinal"), F.col("col.n").alias("n_tokens"), F.col("col.ended"))


def _lengths(closed: Column, open_end: Column, unfinished: Column) -> Column:
    ended = F.transform(closed, lambda n: F.struct(n.alias("n"), F.lit(True).alias("ended")))
    rest = F.array(F.struct(unfinished.alias("n"), F.lit(False).alias("ended")))
    return F.when(open_end, F.concat(ended, rest)).otherwise(ended)


def with_ids(counts: DataFrame, roster: DataFrame) -> DataFrame:
    """Add the ``doc_id`` that the roster has at each (shard, ordinal)."""
    names = roster.select("shard", "first", F.posexplode("roster").alias("_at", "doc_id")).select(
        "shard", (F.col("first") + F.col("_at")).alias("ordinal"), "doc_id"
    )
    return counts.join(names, ["shard", "ordinal"])
