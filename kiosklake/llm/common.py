"""What the corpus operators share: table access, row keys, sampling, byte-level text scans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kiosklake.session import materialize, prepare as prepare_session, with_local_dir  # noqa: F401

# Arrow batches are cut by bytes as well as rows, so that long texts cannot swell a worker.
_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
#: Bytes of text that one numpy pass works on.
CHUNK_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on."""
    for key, value in _BATCHES.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return with_local_dir(prepare_session(spark, shares=False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` worked out once, however often and deep ``body`` names it."""
    return F.transform(F.array(value), body)[0]


SEPARATORS = " \t\n\u000b\f\r"


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space, in order."""
    bare = F.btrim(text, F.lit(SEPARATORS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def unit_hash(seed: str, *columns: Column) -> Column:
    """A uniform double in [0, 1) from the columns."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return bits.cast("double") * F.lit(2.0**-53)


def usable_labels(labels: DataFrame, label: str, train: Column) -> DataFrame:
    """``(doc_id, y)``: null ids and labels are left out, as are ids whose labels disagree."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & train)
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("_high"))
        .filter(F.col("y") == F.col("_high"))
        .select("doc_id", F.col("y").cast("int").alias("y"))
    )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, *, train: Column, limit: int, seed: str
) -> DataFrame:
    """``(text, y)`` of labelled training rows, about ``limit`` of them when there are more.

    ``train`` is a condition on ``doc_id``. Rows are picked by a hash of the id, so the
    sample is spread over all tasks. Null ids and labels are left out, as are ids whose
    labels disagree.
    """
    usable = usable_labels(labels, label, train)
    known = usable.count()
    picked = unit_hash(seed, F.col("doc_id")) < limit / max(known, limit)
    texts = docs.filter(F.col("doc_id").isNotNull() & train & picked).select("doc_id", "text")
    return texts.join(usable.filter(picked), "doc_id").select("text", "y")


# ---------------------------------------------------------------- texts as bytes

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; null counts as empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first row, end row, bytes, offsets."""
    data, offsets = utf8(column)
    row, rows = 0, len(column)
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if len(_POWERS.get("up", ())) < n + 1:
        size = max(n + 1, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][: n + 1], _POWERS["down"][: n + 1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def spans(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true bytes that don't cross texts: starts, ends, and the first run of each text."""
    edge = np.zeros(len(member) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(member) + 1, bool)
    before[1:] = member
    starts = np.flatnonzero(member & (edge[:-1] | ~before[:-1]))
    ends = np.flatnonzero(before[1:] & (edge[1:] | ~np.append(member[1:], False))) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over values[bounds[i]:bounds[i + 1]]."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of about CHUNK_BYTES, so that what is made of them stays small."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        for row, end, _, _ in chunks(column):
            yield row, end
        return
    step = max(1, len(column) * CHUNK_BYTES // max(column.nbytes, CHUNK_BYTES))
    for row in range(0, len(column), step):
        yield row, min(row + step, len(column))


def map_texts(
    docs: DataFrame,
    work: Callable[[pa.Array], list],
    fields: dict[str, T.DataType],
    *,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add the columns ``fields`` that ``work`` makes of each batch of whole texts.

    ``keep`` names the columns to carry along (all by default); one that bears the name of
    a new column gives way to it. One pass over the rows, no shuffle.
    """
    prepare(docs.sparkSession)
    carried = [c for c in (docs.columns if keep is None else keep) if c not in fields]
    sent = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(text).alias("_text"))
    schema = T.StructType([*sent.schema.fields[:-1], *[T.StructField(n, t) for n, t in fields.items()]])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for row, end in _slices(column):
                made = work(column.slice(row, end - row))
                yield pa.RecordBatch.from_arrays([*batch.slice(row, end - row).columns[:-1], *made], schema.names)

    return sent.mapInArrow(each, schema)
