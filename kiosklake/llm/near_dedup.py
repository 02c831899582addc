"""Near duplicates by Order MinHash, candidates verified by banded alignment.

A text is its sequence of word shingles; a shingle with the number of its earlier occurrences
is a labelled shingle. A sketch keeps the least few labelled shingles under one hash function
in the order they have in the text, so two texts share it only if they agree in content and in
order. The similarity verified is that of the best alignment, common / (all - common), common
being the longest common subsequence of the shingle sequences. One minus it is a metric.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from kiosklake.llm.common import chunks, map_texts, mix, prepare, span_hashes, spans
from kiosklake.llm.components import components
from kiosklake.session import materialize

SHINGLE, SIMILAR = 5, 0.8
#: Sketches of three shingles for texts of up to 30 shingles, and of five from 24 on: two texts
#: of similarity 0.8 have lengths within a quarter, so they meet in one kind or the other. At
#: 0.8 they share no sketch with a chance of about 1 in 5,000, and less above it.
SHORT, LONG = (3, 16, 0, 30), (5, 24, 24, 1 << 62)

#: Cells of a parity sketch: a bit tells whether a cell got an odd number of labelled shingles.
CELLS = 2048

_MEMBER = np.zeros(256, bool)
_MEMBER[128:] = True
_MEMBER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column)


def _shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of texts laid end to end, the first shingle of each text, and the texts' word hashes.

    A text of one to four words is a single shingle.
    """
    starts, ends, first = spans(_MEMBER[data], offsets)
    words = span_hashes(data, starts, ends)
    counts = np.diff(first)
    sizes = np.where(counts == 0, 0, np.maximum(counts - SHINGLE + 1, 1))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(first[:-1] - bounds[:-1], sizes) + np.arange(bounds[-1])
    left = np.repeat(first[1:], sizes) - at
    padded = np.append(words, np.zeros(SHINGLE, np.uint64))
    h = np.zeros(len(at), np.uint64)
    for i in range(SHINGLE):
        h = mix(h * _STEP + np.where(left > i, padded[at + i], np.uint64(i + 1)))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix(words + _STEP * (np.arange(len(words)) - np.repeat(first[:-1], counts)).astype(np.uint64)), out=total[1:])
    return h, bounds, total[first[1:]] - total[first[:-1]]


def _labelled(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each shingle mixed with the number of equal ones before it in its text."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    run = np.flatnonzero(new)
    earlier = np.arange(len(h)) - np.repeat(run, np.diff(np.append(run, len(h))))
    out = np.empty(len(h), np.uint64)
    out[order] = mix(h + _STEP * earlier.astype(np.uint64))
    return out


def _sketches(labels: np.ndarray, bounds: np.ndarray, keep: int, number: int, kind: int) -> np.ndarray:
    """``number`` sketches of the least ``keep`` labels, in text order, of texts that have some."""
    first, counts = bounds[:-1], np.diff(bounds)
    out = np.zeros((len(first), number), np.uint64)
    if not len(first):
        return out
    for s in range(number):
        v = mix(labels ^ mix(np.array([s + 1], np.uint64) * _STEP))
        places = np.full((len(first), keep), len(labels))
        for k in range(keep):
            least = np.minimum.reduceat(v, first)
            hit = np.flatnonzero(v == np.repeat(least, counts))
            at = hit[np.searchsorted(hit, first)]
            places[:, k] = np.where(counts > k, at, len(labels))
            v[at] = _NONE
        places.sort(1)
        known = np.append(labels, np.uint64(0))[places]
        h = np.full(len(first), np.uint64(kind * 1000 + s))
        for k in range(keep):
            h = mix(h * _STEP + known[:, k])
        out[:, s] = h
    return out


def _parities(labels: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """CELLS bits per text, as signed longs: which cells got an odd number of its labels.

    Cells in which two texts' bits differ hold a label that one of them lacks, so their
    number is a lower bound of the symmetric difference.
    """
    texts = len(bounds) - 1
    out = np.zeros((texts, CELLS // 64), np.int64)
    cells = (labels >> np.uint64(20)) % np.uint64(CELLS)
    for at in range(0, texts, 256):
        end = min(at + 256, texts)
        owner = np.repeat(np.arange(end - at), np.diff(bounds[at : end + 1]))
        some = cells[bounds[at] : bounds[end]].astype(np.int64)
        odd = np.bincount(owner * CELLS + some, minlength=(end - at) * CELLS) & 1
        out[at:end] = np.packbits(odd.astype(bool).reshape(end - at, CELLS), axis=1).view(np.int64)
    return out


def _describe(column: pa.Array) -> list[pa.Array]:
    """Per text: two hashes of its words, its number of shingles, its sketches, its parities."""
    keys: list[np.ndarray] = [np.zeros((2, 0), np.int64)]
    sizes: list[np.ndarray] = [np.zeros(0, np.int64)]
    flat: list[np.ndarray] = [np.zeros(0, np.int64)]
    lengths: list[np.ndarray] = [np.zeros(0, np.int64)]
    parities: list[np.ndarray] = [np.zeros((0, CELLS // 64), np.int64)]
    for _, _, data, offsets in chunks(_lower(column)):
        hashes, bounds, digest = _shingles(data, offsets)
        counts = np.diff(bounds)
        ordered = hashes + _STEP * (np.arange(len(hashes)) - np.repeat(bounds[:-1], counts)).astype(np.uint64)
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(ordered), out=total[1:])
        keys.append(np.vstack([mix(digest), mix(total[bounds[1:]] - total[bounds[:-1]])]).view(np.int64))
        sizes.append(counts)
        labels = _labelled(hashes, bounds)
        parities.append(_parities(labels, bounds))
        per_text: list[list[np.ndarray]] = [[] for _ in counts]
        for kind, (keep, number, low, high) in enumerate((SHORT, LONG)):
            fits = np.flatnonzero((counts >= max(low, 1)) & (counts <= high))
            inside = np.repeat((counts >= max(low, 1)) & (counts <= high), counts)
            cut = np.concatenate([[0], np.cumsum(counts[fits])])
            made = _sketches(labels[inside], cut, keep, number, kind).view(np.int64)
            for row, text in enumerate(fits):
                per_text[text].append(made[row])
        flat += [x for found in per_text for x in found]
        lengths.append(np.array([sum(map(len, found)) for found in per_text], np.int64))
    bounds32 = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype(np.int32)
    both = np.concatenate(keys, 1)
    lists = pa.ListArray.from_arrays(pa.array(bounds32), pa.array(np.concatenate(flat)))
    odd = np.concatenate(parities)
    odd_lists = pa.ListArray.from_arrays(pa.array(np.arange(0, odd.size + 1, CELLS // 64, dtype=np.int32)), pa.array(odd.ravel()))
    return [pa.array(both[0]), pa.array(both[1]), pa.array(np.concatenate(sizes)), lists, odd_lists]


# ---------------------------------------------------------------- alignment

def common_in_band(a: list[int], b: list[int], band: int) -> int:
    """Longest common subsequence over alignments that stay within ``band`` of the diagonal.

    One machine integer holds a row of the band: a 0 bit is a column where the length grows.
    Row by row the band moves one column on; the bits it leaves behind are final.
    """
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    row, low, high, found = 0, 0, 0, 0
    for i, x in enumerate(a):
        new_low, new_high = max(0, i - band), min(len(b), i + band + 1)
        if new_low >= len(b):
            break
        if new_high > high:
            row |= ((1 << (new_high - high)) - 1) << (high - low)
            high = new_high
        if new_low > low:
            gone = new_low - low
            found += gone - (row & ((1 << gone) - 1)).bit_count()
            row >>= gone
            low = new_low
        match = 0
        for j in places.get(x, ()):
            if low <= j < high:
                match |= 1 << (j - low)
        if match:
            both = row & match
            row = ((row + both) | (row - both)) & ((1 << (high - low)) - 1)
    return found + (high - low) - row.bit_count()


def aligned(a: np.ndarray, labels_a: np.ndarray, b: np.ndarray, labels_b: np.ndarray) -> tuple[float, float]:
    """Bounds of the distance 1 - similarity; equal where it is known, and it is at 1 - SIMILAR or less.

    ``a`` and ``b`` are shingle sequences, the labels their labelled shingles. As many labels
    as the texts have in common bound what can be aligned; where these stand in the same
    order in both, they are aligned. Else the band is as wide as a similarity of SIMILAR needs.
    """
    n = len(a) + len(b)
    if not len(a) or not len(b):
        return (1.0, 1.0)
    shared, at_a, at_b = np.intersect1d(labels_a, labels_b, assume_unique=True, return_indices=True)
    least = 1 - len(shared) / (n - len(shared))
    in_order = at_b[np.argsort(at_a)]
    if (in_order[1:] > in_order[:-1]).all():
        return (least, least)
    if least > 1 - SIMILAR + 1e-12:
        return (least, 1.0)
    same = 0
    short = min(len(a), len(b))
    head = a[:short] != b[:short]
    start = int(head.argmax()) if head.any() else short
    tail = a[len(a) - short + start :][::-1] != b[len(b) - short + start :][::-1]
    stop = int(tail.argmax()) if tail.any() else len(tail)
    same = start + stop
    band = int(n * (1 - SIMILAR) / (1 + SIMILAR)) + 1
    same += common_in_band(a[start : len(a) - stop].tolist(), b[start : len(b) - stop].tolist(), band)
    distance = 1 - same / (n - same)
    return (distance, distance) if distance <= 1 - SIMILAR + 1e-12 else (max(least, 1 - SIMILAR), 1.0)


def _compare(column: pa.StructArray) -> list[pa.Array]:
    """Distance bounds of pairs of texts."""
    sides = []
    for side in range(2):
        rows = []
        for _, _, data, offsets in chunks(_lower(column.field(side))):
            hashes, bounds, _ = _shingles(data, offsets)
            labels = _labelled(hashes, bounds)
            rows += [(hashes[x:y], labels[x:y]) for x, y in zip(bounds, bounds[1:])]
        sides.append(rows)
    found = [aligned(*one, *other) for one, other in zip(*sides)]
    return [pa.array([x for x, _ in found], pa.float64()), pa.array([y for _, y in found], pa.float64())]


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b, low, high)``: bounds of the distance of each pair of nodes."""
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("_one")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("_two")), "b"
    )
    held = joined.select("a", "b", F.struct("_one", "_two").alias("_texts"))
    return map_texts(held, _compare, {"low": T.DoubleType(), "high": T.DoubleType()}, text="_texts", keep=["a", "b"])


# ---------------------------------------------------------------- over frames

_LONGEST = 1 / SIMILAR + 1e-9


def _pairs_across(open_members: DataFrame) -> DataFrame:
    """Pairs of bucket mates of different components that may be similar: neither their distances
    to the pivot nor their parities rule it out."""
    fields = ("node", "n", "root", "low", "high", "odd")
    x = open_members.select("key", *[F.col(c).alias(f"{c}_a") for c in fields])
    y = open_members.select("key", *[F.col(c).alias(f"{c}_b") for c in fields])
    far = 1 - SIMILAR + 1e-9
    near = (F.col("low_a") - F.col("high_b") <= far) & (F.col("low_b") - F.col("high_a") <= far)
    alike = F.greatest("n_a", "n_b") <= F.least("n_a", "n_b") * _LONGEST
    bits = F.zip_with("odd_a", "odd_b", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    apart = F.aggregate(bits, F.lit(0), lambda n, bit: n + bit)
    # similarity SIMILAR leaves a symmetric difference of at most this
    close = apart <= (F.col("n_a") + F.col("n_b")) * ((1 - SIMILAR) / (1 + SIMILAR)) + 1e-6
    other = (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b"))
    met = x.join(y, "key").filter(other & alike & near & close)
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows' keys with their text node, and ``(node, root)`` of the nodes with links."""
    prepare(docs.sparkSession)
    held = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    described = materialize(map_texts(
        held, _describe,
        {"k1": T.LongType(), "k2": T.LongType(), "n": T.LongType(), "sketches": T.ArrayType(T.LongType()),
         "odd": T.ArrayType(T.LongType())},
        keep=["doc_id", "h"],
    ), "described")
    worded = described.filter("n > 0")
    # one node for all copies of a text, with one of its rows to take the text from
    nodes = materialize(
        worded.groupBy("k1", "k2", "n").agg(
            F.min(F.struct("doc_id", "h")).alias("row"), F.first("sketches").alias("sketches"), F.first("odd").alias("odd")
        ).withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    entries = nodes.select("node", "n", F.explode("sketches").alias("key"))
    # another pivot in each bucket, so that members meet many
    lot = F.struct(F.xxhash64("key", "node"), "node", "n")
    shared = entries.groupBy("key").agg(F.min(lot).alias("pivot"), F.count(F.lit(1)).alias("_size"))
    buckets = shared.filter("_size > 1").select("key", F.col("pivot.node").alias("pivot"), F.col("pivot.n").alias("pivot_n"))
    members = materialize(entries.join(buckets, "key"), "bucket-members")
    wanted = members.select("node").distinct().join(nodes.select("node", "row"), "node")
    texts = materialize(
        held.join(
            wanted.select("node", F.col("row.doc_id").alias("_id"), F.col("row.h").alias("_h")),
            F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")),
        ).dropDuplicates(["node"]).select("node", "text"),
        "candidate-texts",
    )
    # first every member against its bucket's pivot
    alike = F.greatest("n", "pivot_n") <= F.least("n", "pivot_n") * _LONGEST
    star = members.filter((F.col("node") != F.col("pivot")) & alike).select(
        F.col("pivot").alias("a"), F.col("node").alias("b")
    ).distinct()
    near = materialize(_verify(star, texts), "near")
    linked = F.col("high") <= 1 - SIMILAR + 1e-9
    roots = components(near.filter(linked).select("a", "b"))
    # then, in buckets that still hold several components, the members across them
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = placed.groupBy("key").agg(F.min("root").alias("_x"), F.max("root").alias("_y")).filter("_x <> _y").select("key")
    apart = 1 - F.least("n", "pivot_n") / F.greatest("n", "pivot_n")
    own = F.col("node") == F.col("pivot")
    unsettled = placed.join(split, "key", "left_semi").join(nodes.select("node", "odd"), "node")
    known = unsettled.join(
        near.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "low", "high"), ["pivot", "node"], "left"
    ).withColumns({
        "low": F.when(own, 0.0).otherwise(F.coalesce("low", apart)), "high": F.when(own, 0.0).otherwise(F.coalesce("high", F.lit(1.0))),
    })
    done = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = _pairs_across(known).join(done, ["a", "b"], "left_anti")
    more = _verify(materialize(rest, "pairs-across"), texts).filter(linked).select("a", "b")
    # components so far stand for their links
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
    final = components(links.filter("a <> b"))
    rows = described.join(nodes.select("k1", "k2", "n", "node"), ["k1", "k2", "n"], "left")
    return rows.select("doc_id", "h", "node"), final


def classify(docs: DataFrame) -> DataFrame:
    """``(doc_id, h, class_id, class_size)`` for every row; ``h`` is a hash of its text.

    Rows whose words are the same (case and punctuation aside), and rows linked by an
    alignment of similarity 0.8 or more, directly or through others, share a class; its id
    is the least ``doc_id`` in it. Copies of one text are one node. Each member of a bucket
    is aligned with the bucket's pivot; members left in different components are aligned
    with each other unless a link is ruled out by their distances to the pivot (the distance
    is a metric) or by their parity sketches, so no pair within the candidates is lost.

    A text without a word, null and empty ones included, is in no class: its id is its own
    ``doc_id``. Null ids take part; a class of null ids alone has a null id. Repeated rows
    are rows of the same class. Other columns are ignored; an empty table gives an empty table.
    """
    rows, roots = _classes(docs)
    rooted = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialize(rooted.select("doc_id", "h", "root"), "rooted")
    worded = rooted.filter(F.col("root").isNotNull())
    ids = worded.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    alone = rooted.filter(F.col("root").isNull()).select(
        "doc_id", "h", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size")
    )
    return worded.join(ids, "root").select("doc_id", "h", "class_id", "class_size").unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, with the columns it came with; texts without a word all stay.

    It is the row of least id, then of least text hash; of rows equal in both one stays.
    """
    rows, roots = _classes(docs)
    rooted = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialize(rooted.select("doc_id", "h", "root"), "rooted")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "h")
    kept = rooted.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min(first).alias("row"))
    chosen = materialize(
        kept.select(F.col("row.doc_id").alias("_id"), F.col("row.h").alias("_h")).join(
            rooted.groupBy(F.col("doc_id").alias("_id2"), F.col("h").alias("_h2")).agg(F.count(F.lit(1)).alias("_rows")),
            F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_h") == F.col("_h2")),
        ).select("_id", "_h", "_rows"),
        "chosen-rows",
    )
    wordless = rooted.filter(F.col("root").isNull()).select(
        F.col("doc_id").alias("_id"), F.col("h").alias("_h"), F.lit(1).cast("long").alias("_rows")
    ).distinct()
    held = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text"))
    met = held.join(
        chosen.unionByName(wordless), F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_h"))
    )
    once = met.filter("_rows = 1").select("_row.*")
    repeated = met.filter("_rows > 1").dropDuplicates(["_doc", "_text"]).select("_row.*")
    return once.unionByName(repeated)
