"""Hard negatives by vertical scans of decomposed vectors.

Rows are stored in blocks that hold one column of values per dimension, with its least and
greatest value. For an anchor the dimensions are read in descending order of its own magnitude.
After every few of them, what is read so far and the least and most that the rest can add bound
each row's score, and rows whose bounds rule them out leave the candidate bitmap. What is left
when all dimensions are read has its exact score.

First each anchor's best rows of its own label are found, its positives; each of them opens a
window of scores, and the second scan finds the best rows of other labels inside the windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kiosklake.llm.common import prepare
from kiosklake.session import materialize

#: Dimensions read between two looks at the bounds; anchors that one task scans a block for.
STRIDE, ANCHORS = 8, 4096
#: Whole numbers up to this are exact in the arithmetic used.
EXACT = float(1 << 53)

_BLOCK = "dim int, n int, ids binary, labels binary, low binary, high binary, columns array<binary>"
_TASKS = 20_000


# ---------------------------------------------------------------- blocks

def integer_rows(rows: DataFrame, *, key: str, label: str, vector: str, scale: int, asks: Column) -> DataFrame:
    """Rows that take part: ``id``, ``label``, ``vector`` of floor(scale * x), and whether they are anchors."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    return rows.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & finite).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vector"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
    )


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block of each batch and length of vectors."""
    for batch in batches:
        ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        vectors = batch.column(2)
        sizes = np.diff(vectors.offsets.to_numpy())
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        for dim in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dim)
            columns = values[starts[at] + np.arange(dim)[:, None]] if dim else np.zeros((0, len(at)), np.int64)
            low = columns.min(axis=1, initial=2**62) if dim else np.zeros(0, np.int64)
            high = columns.max(axis=1, initial=-(2**62)) if dim else np.zeros(0, np.int64)
            if dim and max(-low.min(), high.max()) >= 1 << 53:
                raise ValueError("components beyond 2**53 have no exact scores")
            narrow = np.int32 if not dim or max(-low.min(), high.max()) < 1 << 31 else np.int64
            yield pa.RecordBatch.from_pylist([{
                "dim": dim, "n": len(at), "ids": ids[at].tobytes(), "labels": labels[at].tobytes(),
                "low": low.astype(np.int64).tobytes(), "high": high.astype(np.int64).tobytes(),
                "columns": [c.astype(narrow).tobytes() for c in columns],
            }], pa.schema([
                ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
                ("low", pa.binary()), ("high", pa.binary()), ("columns", pa.list_(pa.binary())),
            ]))


class _Block:
    """A block laid out for scanning: one row of ``columns`` per dimension."""

    def __init__(self, row: dict) -> None:
        n = row["n"]
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        self.low, self.high = (np.frombuffer(row[c], np.int64).astype(np.float64) for c in ("low", "high"))
        self.columns = np.array([np.frombuffer(c, f"<i{len(c) // n}") for c in row["columns"]], np.float64).reshape(row["dim"], n)

    def reading(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Dimensions in the anchor's order, and the least and most that those from each place on add."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        a, b = anchor[order] * self.low[order], anchor[order] * self.high[order]
        if np.maximum(np.abs(a), np.abs(b)).sum() >= EXACT:
            raise ValueError("scores beyond 2**53 are not exact")
        rest = [np.append(np.cumsum(x[::-1])[::-1], 0.0) for x in (np.minimum(a, b), np.maximum(a, b))]
        return order, *rest

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, prune) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the rows left of ``bitmap``.

        ``prune`` gets the least and greatest possible scores of the rows still in it and says
        which of them stay.
        """
        order, least, most = self.reading(anchor)
        rows, score = np.flatnonzero(bitmap), np.zeros(np.count_nonzero(bitmap))
        whole = len(rows) == len(bitmap)
        for i in range(0, len(order), STRIDE):
            if not len(rows):
                break
            read = order[i : i + STRIDE]
            columns = self.columns[read]
            score += anchor[read] @ (columns if whole else columns[:, rows])
            done = min(i + STRIDE, len(order))
            stay = prune(score + least[done], score + most[done])
            if not stay.all():
                rows, score, whole = rows[stay], score[stay], False
        return rows, score


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th greatest; minus infinity if there are fewer."""
    return -np.inf if len(values) < k else np.partition(values, len(values) - k)[len(values) - k]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first by descending score, then id."""
    return np.lexsort((ids, -scores))[:k]


def _positives(block: _Block, anchor: dict, k: int) -> Iterator[tuple]:
    """The k best other rows of the anchor's label: id and score."""
    vector = np.array(anchor["vector"], np.float64)
    bitmap = (block.labels == anchor["label"]) & (block.ids != anchor["id"])
    rows, score = block.scan(vector, bitmap, lambda least, most: most >= _kth(least, k))
    for i in _best(score, block.ids[rows], k):
        yield int(block.ids[rows[i]]), int(score[i])


def _negatives(block: _Block, anchor: dict, k: int, lowest: int, highest: int) -> Iterator[tuple]:
    """For each positive the k best rows of other labels in its window: its rank, id and score."""
    vector = np.array(anchor["vector"], np.float64)
    windows = [(-(-lowest * p["score"] // 100), highest * p["score"] // 100) for p in anchor["positives"]]

    def prune(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(least), bool)
        for low, high in set(windows):
            inside = (least >= low) & (most <= high)
            stay |= (least <= high) & (most >= max(low, _kth(least[inside], k)))
        return stay

    rows, score = block.scan(vector, block.labels != anchor["label"], prune)
    for p, (low, high) in zip(anchor["positives"], windows):
        inside = np.flatnonzero((score >= low) & (score <= high))
        for i in inside[_best(score[inside], block.ids[rows[inside]], k)]:
            yield p["place"], p["id"], p["score"], int(block.ids[rows[i]]), int(score[i])


# ---------------------------------------------------------------- blocks against anchors

def _each_of(n: int) -> Column:
    """A row for each of 0 to n - 1."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _against(blocks: DataFrame, asked: DataFrame, n_blocks: int, n_asked: int) -> DataFrame:
    """One row for each block and group of anchors, dealt evenly.

    Groups of at most about ``ANCHORS`` anchors are copied to every share of the blocks, and
    blocks to every group, so neither side is ever whole in one task or broadcast by demand.
    """
    shares, groups = max(1, n_blocks), max(1, -(-n_asked // ANCHORS))
    tasks = min(shares * groups, _TASKS)
    held = asked.withColumns({"c": F.pmod(F.xxhash64("at"), F.lit(groups)), "dim": F.size("vector")})
    grouped = held.groupBy("c", "dim").agg(F.collect_list(F.struct(*asked.columns)).alias("anchors"))
    grouped = grouped.withColumn("r", _each_of(shares))
    dealt = blocks.withColumns({"r": F.pmod(F.xxhash64("block"), F.lit(shares)), "c": _each_of(groups)})
    keys = ["r", "c", "dim"]
    return dealt.repartition(tasks, *keys).join(grouped.repartition(tasks, *keys), keys).drop("r", "c", "block")


def _each(kernel, names: list[str]):
    """Run ``kernel`` over every anchor of every row, as (at, anchor id, its values)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = _Block(row)
                made = [(a["at"], a["id"], *found) for a in row["anchors"] for found in kernel(block, a)]
                columns = list(zip(*made)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def mine(
    rows: DataFrame, *, asks: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
    scale: int = 256, positives: int = 5, negatives: int = 10, lowest: int = 30, highest: int = 90,
) -> DataFrame:
    """Hard negatives of every anchor and positive, the most alike first.

    A score is the inner product of two vectors of floor(scale * component). Anchors are the
    rows of which ``asks`` holds. An anchor's positives are its ``positives`` best rows of the
    same label; for each, the result has the ``negatives`` best rows of other labels whose score
    is from ``lowest`` to ``highest`` per cent of the positive's: anchor_id, positive_id, rank,
    negative_id, positive_score and negative_score. Equal scores are ordered by id. The result
    is exact: bounds only rule out rows that cannot be in it.

    Rows with a null id, label or vector, or a component that is null or not finite, take no
    part. Repeated rows each count as a row; a row is never its own partner, nor is one of the
    same id. Vectors meet only those of their length. Anchors without a positive give no rows,
    nor do windows that no row is in, so an empty table gives an empty table. Other columns are
    ignored, whatever their names. Scores beyond 2**53 are an error. Ids and labels are whole
    numbers.

    Blocks are Arrow batches of the scan, so none holds more than 4,000 rows, whatever the
    labels; partial results are at most ``positives`` rows per anchor and block, and
    ``negatives`` per positive and block, and are cut again before they are shuffled.
    """
    spark = prepare(rows.sparkSession)
    clean = integer_rows(rows, key=key, label=label, vector=vector, scale=scale, asks=asks)
    sent = clean.select("id", "label", "vector")
    blocks = materialize(sent.mapInArrow(_to_blocks, _BLOCK).withColumn("block", F.monotonically_increasing_id()), "vector-blocks")
    asked = materialize(clean.filter("asks").select(F.monotonically_increasing_id().alias("at"), "id", "label", "vector"), "anchors")
    n_blocks, n_asked = blocks.count(), asked.count()

    pairs = _against(blocks, asked, n_blocks, n_asked)
    kernel = lambda block, anchor: _positives(block, anchor, positives)
    names = ["at", "anchor_id", "id", "score"]
    alike = pairs.mapInArrow(_each(kernel, names), ", ".join(f"{n} long" for n in names))
    place = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "id"))
    first = alike.withColumn("place", place).filter(F.col("place") <= positives)
    opened = first.groupBy("at").agg(F.sort_array(F.collect_list(F.struct(F.col("place").cast("long").alias("place"), "id", "score"))).alias("positives"))

    ready = materialize(asked.join(opened, "at"), "anchors-with-positives")
    pairs = _against(blocks, ready, n_blocks, n_asked)
    kernel = lambda block, anchor: _negatives(block, anchor, negatives, lowest, highest)
    names = ["at", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
    unlike = pairs.mapInArrow(_each(kernel, names), ", ".join(f"{n} long" for n in names))
    rank = F.row_number().over(Window.partitionBy("at", "place").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = unlike.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
