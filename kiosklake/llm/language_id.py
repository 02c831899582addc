"""Language of a text: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from kiosklake.llm.common import map_texts, prepare, unit_hash

#: Hash buckets of n-grams, n-gram lengths, and smoothing.
BUCKETS, SIZES, SMOOTHING = 1 << 15, (1, 2, 3), 0.5
#: About so many training texts are used when there are more, and so many languages at most:
#: together they bound what is gathered and broadcast (buckets x languages doubles).
MAX_TEXTS, MAX_LANGUAGES = 20_000, 200
#: The answer for texts without a letter.
UNKNOWN = "und"
_PIECE = 1 << 18


def _grams(codes: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Bucket of the n-gram that starts at each position, and its length, for each size."""
    x = codes.astype(np.uint64) + np.uint64(1)
    h = np.zeros(len(x), np.uint64)
    for n in range(1, max(SIZES) + 1):
        h = h[: len(x) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + x[n - 1 :]
        if n in SIZES and len(h):
            m = h * np.uint64(0xD6E8FEB86659FD93)
            yield ((m ^ (m >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(49)).astype(np.int64), n


def _pieces(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Code points of the lower-cased words between single spaces, in runs of bounded size.

    Everything in ASCII and Latin-1 but letters counts as a space. With each run comes the
    length of its overlap with the run before.
    """
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (codes <= 64) | ((codes >= 91) & (codes <= 96)) | ((codes >= 123) & (codes <= 191)) | (codes == 0x3000)
    blank |= (codes >= 0x2000) & (codes <= 0x206F)
    codes = np.where(blank, np.uint32(32), codes)
    codes = codes[~(blank & np.append(False, blank[:-1]))]
    for at in range(0, len(codes), _PIECE):
        yield codes[max(0, at - max(SIZES) + 1) : at + _PIECE], min(at, max(SIZES) - 1)


def _counted(piece: np.ndarray, overlap: int) -> np.ndarray:
    """Buckets of the n-grams of a piece that end beyond its overlap with the one before."""
    found = [b[max(0, overlap - n + 1) :] for b, n in _grams(piece)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _has_letter(text: str) -> bool:
    return text.isalpha() or any(map(str.isalpha, text))


@dataclass(frozen=True)
class Model:
    """Languages, and a (buckets + 1) x languages matrix of log probabilities; priors in the last row."""

    languages: tuple[str, ...]
    logs: np.ndarray


def _histograms(texts: DataFrame) -> DataFrame:
    """Per language and task: n-gram counts by bucket, as one array, and the number of texts."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                row = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                for piece, overlap in _pieces(text):
                    row[:BUCKETS] += np.bincount(_counted(piece, overlap), minlength=BUCKETS)
                row[BUCKETS] += 1
        for lang, row in counts.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used), pa.array(row[used])], ["lang", "bucket", "n"]
            )

    return texts.select("lang", "text").mapInArrow(work, "lang string, bucket long, n long")


def train(docs: DataFrame, *, train_on: Column, limit: int = MAX_TEXTS) -> Model:
    """Learn from the texts and non-null languages of the rows that ``train_on`` admits.

    About ``limit`` texts, picked by a hash of the id, are counted, in Spark; per language
    at most ``BUCKETS`` sums reach the driver. Null ids and null texts are left out. More
    than ``MAX_LANGUAGES`` languages raise an error. No training text: a model without
    languages, which answers ``und`` to everything.
    """
    prepare(docs.sparkSession)
    usable = docs.filter(train_on & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    sizes = usable.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = limit / max(limit, sum(r["count"] for r in sizes))
    # a language with few texts keeps at least its even part of the sample
    even = limit / max(len(sizes), 1)
    picked = F.lit(False)
    for r in sizes:
        part = max(share, min(1.0, 0.2 * even / r["count"]))
        picked = picked | ((F.col("lang") == r["lang"]) & (unit_hash("language", F.col("doc_id")) < part))
    sample = usable.filter(picked & F.col("text").isNotNull())
    sums = _histograms(sample).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = sums.toArrow()
    languages = tuple(sorted(set(got.column("lang").to_pylist())))
    logs = np.zeros((BUCKETS + 1, len(languages)))
    if languages:
        place = {lang: i for i, lang in enumerate(languages)}
        column = np.array([place[x] for x in got.column("lang").to_pylist()])
        logs[got.column("bucket").to_numpy(), column] = got.column("n").to_numpy()
        counts = logs[:BUCKETS] + SMOOTHING
        logs[:BUCKETS] = np.log(counts / counts.sum(0))
        logs[BUCKETS] = np.log(logs[BUCKETS] / logs[BUCKETS].sum())
    return Model(languages, logs.astype(np.float64))


def _judge(column: pa.Array, model: Model) -> list[pa.Array]:
    names: list[str] = []
    scores: list[float] = []
    for text in column.to_pylist():
        if not text or not model.languages or not _has_letter(text):
            names.append(UNKNOWN)
            scores.append(0.0)
            continue
        total = model.logs[BUCKETS].copy()
        for piece, overlap in _pieces(text):
            seen = np.bincount(_counted(piece, overlap), minlength=BUCKETS)
            used = np.flatnonzero(seen)
            total += seen[used] @ model.logs[used]
        best = int(total.argmax())
        names.append(model.languages[best])
        scores.append(float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum()))
    return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]


def predict(docs: DataFrame, model: Model, *, keep: list[str] | None = None) -> DataFrame:
    """Every row with ``lang_pred`` and ``score``, the posterior of that language.

    The matrix of log probabilities is broadcast (``MAX_LANGUAGES`` bounds it) and each text
    is a sparse row of n-gram counts times that matrix. Null texts and texts without a
    letter get ``und`` and 0. Equal texts get equal answers, ties go to the language first
    in order; repeated rows and null ids stay as they are; other columns pass through, but
    for ``lang_pred`` and ``score``, which are replaced. An empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = {"lang_pred": T.StringType(), "score": T.DoubleType()}
    return map_texts(docs, lambda texts: _judge(texts, shared.value), fields, keep=keep)
