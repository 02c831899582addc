"""Quality scores learned from preference pairs (Bradley-Terry), cut at a score quantile."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from kiosklake.llm.common import chunks, map_texts, materialize, mix, prepare, span_hashes, spans, sums, usable_labels
from kiosklake.operators.ranking import numbered

FEATURES = (
    "log_words", "mean_word", "symbols", "upper", "digits", "distinct", "repeats", "same_as_last",
    "exclaims", "short_words", "lines", "stops", "bare_marks", "non_ascii",
)
#: Preference pairs that each row of the more frequent label is in.
ROUNDS = 4
#: Sums over pairs are added in whole units of this size, so that their order does not matter.
_UNIT = 2.0**-24
#: A document is predicted good at or above this score.
ACCEPT = 0.7


def _flags(wanted: str) -> np.ndarray:
    table = np.zeros(256, np.float64)
    table[list(wanted.encode())] = 1
    return table


_WORD = np.ones(256, bool)
_WORD[list(b" \t\n\x0b\x0c\r")] = False
_UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = 1
_ALNUM = _LETTER + _flags("0123456789")
_COUNTED = {
    "symbols": _flags("#*$%&|<>"), "digits": _flags("0123456789"), "exclaims": _flags("!?"),
    "lines": _flags("\n"), "stops": _flags(".,;:"),
}


def _share_distinct(hashes: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of distinct hashes, and per hash whether an equal one came before it."""
    order = np.lexsort((hashes, owner))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.bincount(owner[order][~again], minlength=texts), again[np.argsort(order, kind="stable")] if len(order) else again


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text."""
    texts = len(offsets) - 1
    starts, ends, first = spans(_WORD[data], offsets)
    words = np.diff(first)
    owner = np.repeat(np.arange(texts), words)
    hashes = span_hashes(data, starts, ends)
    length = (ends - starts).astype(float)
    per_word, size = np.maximum(words, 1.0), np.maximum(np.diff(offsets), 1.0)
    by_text = lambda table: sums(table[data], offsets)
    letters = by_text(_LETTER)
    distinct, _ = _share_distinct(hashes, owner, texts)
    pairs = mix(hashes[:-1] + np.uint64(3) * mix(hashes[1:])) if len(hashes) > 1 else hashes[:0]
    inside = owner[1:] == owner[:-1]
    pair_distinct, _ = _share_distinct(pairs[inside], owner[1:][inside], texts)
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & inside
    solid = np.zeros(len(data) + 1)
    np.cumsum(_ALNUM[data], out=solid[1:])
    out = {
        "log_words": np.log1p(words),
        "mean_word": np.log1p(sums(length, first) / per_word),
        "upper": by_text(_UPPER) / np.maximum(letters, 1),
        "distinct": distinct / per_word,
        "repeats": 1 - pair_distinct / np.maximum(words - 1, 1),
        "same_as_last": sums(same, first) / per_word,
        "short_words": sums((length <= 4).astype(float), first) / per_word,
        "bare_marks": sums((solid[ends] == solid[starts]).astype(float), first) / per_word,
        "non_ascii": by_text((np.arange(256) >= 128).astype(float)) / size,
    } | {name: np.log1p(by_text(table) / per_word) for name, table in _COUNTED.items()}
    return np.column_stack([out[name] for name in FEATURES])


def _each(column: pa.Array) -> np.ndarray:
    done = [measure(data, offsets) for _, _, data, offsets in chunks(column)]
    return np.vstack(done) if done else np.zeros((0, len(FEATURES)))


def features(texts: DataFrame) -> DataFrame:
    """``(doc_id, text)`` rows as ``(doc_id, features)``."""
    def lists(column: pa.Array) -> list:
        rows = _each(column)
        bounds = np.arange(0, rows.size + 1, len(FEATURES), dtype=np.int32)
        return [pa.ListArray.from_arrays(bounds, pa.array(rows.ravel()))]

    return map_texts(texts, lists, {"features": T.ArrayType(T.DoubleType())}, keep=["doc_id"])


@dataclass(frozen=True)
class Ranker:
    """A linear score over standardised features, and the cut that a quantile of the scores gave."""

    centre: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Scores in 0..1; the cut lies at ACCEPT."""
        strength = (rows - np.array(self.centre)) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(strength - self.cut + np.log(ACCEPT / (1 - ACCEPT)), -40, 40)))


def _partners(n, few: int):
    """Which rows of the rarer label (from 0) the ``n``-th of the other is paired with."""
    return [(n + turn * max(few // ROUNDS, 1)) % few for turn in range(min(ROUNDS, few))]


def _pair_sums(gap: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Over pairs: number, slope and curve of the logistic loss, in units."""
    p = 1 / (1 + np.exp(-np.clip(gap @ w, -40, 40)))
    slope = gap * (p - 1)[:, None]
    upper = np.triu_indices(len(w))
    sides = (gap * (p * (1 - p))[:, None])[:, upper[0]] * gap[:, upper[1]]
    units = lambda x: np.rint(x / _UNIT).astype(np.int64).sum(0)
    return np.concatenate([[len(gap)], units(slope), units(sides)])


def _newton(sums_at: Callable[[np.ndarray], np.ndarray], width: int, decay: float) -> np.ndarray:
    """Weights of the least logistic loss; ``sums_at`` gives the sums over all pairs at some weights."""
    w = np.zeros(width)
    upper = np.triu_indices(width)
    for _ in range(30):
        total = sums_at(w)
        n, values = total[0], total[1:].astype(float) * _UNIT
        slope = values[:width] / n + decay * w
        curve = np.zeros((width, width))
        curve[upper] = values[width:] / n
        curve = curve + np.triu(curve, 1).T + decay * np.eye(width)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit(rows: np.ndarray, labels: np.ndarray, *, seed: int = 7, decay: float = 1e-3) -> Ranker:
    """Learn from pairs (better, worse) of the labelled rows; ``train`` does the same on Spark.

    P(a preferred to b) = 1 / (1 + exp(-(s(a) - s(b)))), s linear in the features; Newton
    steps on the logistic loss of the feature differences. Every row is in pairs: those of the
    more frequent label in ROUNDS of them. The cut is the quantile of the training scores at
    the share of label 0, in the middle of the gap there. Without rows of both labels there
    are no pairs: weights are 0 and every score is ACCEPT.
    """
    width = rows.shape[1] if rows.ndim == 2 else len(FEATURES)
    draw = np.random.default_rng(seed)
    good, bad = (draw.permutation(np.flatnonzero(labels == y)) for y in (1, 0))
    if not len(good) or not len(bad):
        return Ranker((0.0,) * width, (0.0,) * width, 0.0)
    centre, spread = rows.mean(0), rows.std(0)
    spread = np.where(spread > 0, spread, 1)
    scaled = (rows - centre) / spread
    many, few, sign = (good, bad, 1) if len(good) >= len(bad) else (bad, good, -1)
    turns = _partners(np.arange(len(many)), len(few))
    gap = sign * np.vstack([scaled[many] - scaled[few[turn]] for turn in turns])
    w = _newton(lambda at: _pair_sums(gap, at), width, decay)
    scores = np.sort(scaled @ w)
    k = len(bad)
    cut = (scores[k - 1] + scores[min(k, len(scores) - 1)]) / 2
    return Ranker(tuple(centre), tuple(w / spread), float(cut))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _pairs(rows: DataFrame, count: dict[int, int]) -> DataFrame:
    """The feature differences (better less worse) of the preference pairs, as ``gap``."""
    # by a digest of the features: the same pairs whatever order the rows come in
    order = [F.xxhash64("y", "features"), F.col("features"), F.col("_row")]
    many, few = (1, 0) if count[1] >= count[0] else (0, 1)
    first, second = (
        numbered(rows.filter(F.col("y") == y), order=order, name="n").select((F.col("n") - 1).alias("n"), F.col("features").alias(name))
        for y, name in ((many, "a"), (few, "b"))
    )
    turns = F.explode(F.array(*_partners(F.col("n"), count[few])))
    met = first.select(turns.alias("n"), "a").join(second, "n")
    better, worse = ("a", "b") if many == 1 else ("b", "a")
    return met.select(F.zip_with(better, worse, lambda x, y: x - y).alias("gap"))


def train(docs: DataFrame, labels: DataFrame, *, train_on: Column, decay: float = 1e-3) -> Ranker:
    """Fit on all labelled rows that ``train_on`` (a condition on ``doc_id``) admits, as ``fit`` does.

    Features, pairs and scores stay in Spark; each Newton step is one pass over the pairs, of
    which a row of sums per task reaches the driver.
    """
    prepare(docs.sparkSession)
    usable = usable_labels(labels, "quality", train_on).filter(F.col("y").isin(0, 1))
    # texts are measured before the join, which then deals out features alone
    measured = features(docs.filter(F.col("doc_id").isNotNull() & train_on))
    rows = materialize(measured.join(usable, "doc_id").select("y", "features"), "quality-features")
    rows = rows.withColumn("_row", F.monotonically_increasing_id())  # splits what is equal
    width = len(FEATURES)
    count = {0: 0, 1: 0} | {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not count[0] or not count[1]:
        return fit(np.zeros((0, width)), np.zeros(0))
    column = [F.col("features")[i] for i in range(width)]
    whole = [F.rint(x / F.lit(_UNIT)).cast("decimal(20,0)") for x in column]  # added up in any order
    centre = np.array([float(x) * _UNIT for x in rows.agg(*[F.avg(x).alias(f"c{i}") for i, x in enumerate(whole)]).first()])
    squares = [F.rint((x - F.lit(float(c))) ** 2 / F.lit(_UNIT)).cast("decimal(20,0)") for x, c in zip(column, centre)]
    spread = np.sqrt([float(x) * _UNIT for x in rows.agg(*[F.avg(x).alias(f"s{i}") for i, x in enumerate(squares)]).first()])
    spread = np.where(spread > 0, spread, 1)
    pairs = materialize(_pairs(rows, count), "quality-pairs")

    def sums_at(w: np.ndarray) -> np.ndarray:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = sum(_pair_sums(_matrix(b.column(0)) / spread, w) for b in batches if b.num_rows)
            if isinstance(total, np.ndarray):
                yield pa.RecordBatch.from_pydict({"sums": [total.tolist()]})

        return np.sum([r["sums"] for r in pairs.mapInArrow(each, "sums array<bigint>").collect()], axis=0)

    weights = _newton(sums_at, width, decay) / spread

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                strength = ((_matrix(batch.column(0)) - centre) * weights).sum(1)
                yield pa.RecordBatch.from_pydict({"strength": strength})

    strength = rows.select("features").mapInArrow(strengths, "strength double").withColumn("_row", F.monotonically_increasing_id())
    ranked = numbered(strength, order=[F.col("strength"), F.col("_row")])
    # the last score of the lowest count[0] and the first above them
    cut = ranked.filter(F.col("rn").isin(count[0], count[0] + 1)).agg(F.avg("strength")).first()[0]
    return Ranker(tuple(centre.tolist()), tuple(weights.tolist()), float(cut))


def score(docs: DataFrame, model: Ranker, *, name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Every row with its score; the predicted label is 1 at ACCEPT or above.

    Whole texts are measured; null and empty texts have the features of an empty text.
    Equal texts get equal scores. Repeated rows, null ids and other columns stay as they
    are (a column called ``name`` is replaced); an empty table gives an empty table.
    ``keep`` names the columns to return beside the score, all by default.
    """
    return map_texts(docs, lambda texts: [pa.array(model.score(_each(texts)))], {name: T.DoubleType()}, keep=keep)


def keep_good(docs: DataFrame, model: Ranker) -> DataFrame:
    """Only the rows scored at ACCEPT or above, with the columns they came with."""
    return score(docs, model, name="_score").filter(F.col("_score") >= ACCEPT).drop("_score")
