"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length."""

from __future__ import annotations

import hashlib
import math
import unicodedata
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from kiosklake.llm.common import labelled_sample, map_texts, materialize, prepare

#: Bounds of what is fitted: labelled texts, lexicon entries and exception phrases.
MAX_LABELLED, MAX_TERMS, MAX_PHRASES = 8_000, 2_000, 2_000
#: Candidate terms are word beginnings of these lengths, and whole words up to the last length.
STEM_LENGTHS = (4, 5, 6, 7, 8)
LONGEST_WORD = 24
#: A term's log odds must exceed this: two standard errors below the estimate by its surroundings,
#: or by the estimate from its texts, if so many texts are toxic ones and chance would hardly deal
#: them so. That evidence (in nats, a bound on the log of the chance) rests on the term's own texts
#: and the shares of the labels, so it asks no more of a larger sample.
LEAST_ODDS = 1.5
LEAST_TEXTS, LEAST_EVIDENCE = 3, 8.0
#: A phrase around a term is an exception from so many harmless texts on: if no toxic text has it,
#: or if its log odds are at most MOST_ODDS and its texts are less toxic than the word's texts are,
#: with so much evidence. So many phrases of all words are weighed in a pass over the sample.
PHRASE_TEXTS, MOST_ODDS, PHRASE_EVIDENCE, MAX_WEIGHED = 3, 0.5, 4.0, 20_000
ACCEPT = 0.7
#: Texts of the sample are copies if they share one of so many bands of so many least hashes.
BANDS, BAND_ROWS = 16, 4

# Characters that look like, or stand for, a Latin letter.
_LOOKS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʟ": "l", "ɴ": "n", "ø": "o",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
}


class _Folding(dict):
    """Code point to its folded form, worked out on first use: letters stay, marks and joiners go."""

    def __missing__(self, code: int):
        char = chr(code)
        if char in _LOOKS:
            out = _LOOKS[char]
        elif char.isalpha():
            out = char
        elif unicodedata.category(char) in ("Mn", "Me", "Cf"):
            out = ""
        else:
            out = " "
        self[code] = out
        return out


_FOLDING = _Folding()


def fold(text: str | None) -> str:
    """Lower case, accents off, look-alikes and digits as the letters they stand for, all else a space."""
    low = (text or "").lower()
    if not low.isascii():
        low = unicodedata.normalize("NFKD", low)
    return f" {' '.join(low.translate(_FOLDING).split())} "


def _key(folded: str) -> int:
    return int.from_bytes(hashlib.blake2b(folded.encode(), digest_size=8).digest(), "little", signed=True)


def _sketch(column: pa.Array) -> list[list[int]]:
    """Per text its key and the hashes of BANDS bands of least 3-word hashes; copies share some band."""
    draw = np.random.default_rng(7)
    times, plus = draw.integers(1, 1 << 63, (2, BANDS * BAND_ROWS), np.uint64)
    out = []
    for text in column.to_pylist():
        folded = fold(text)
        words = folded.split()
        grams = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
        hashes = np.array([_key(g) for g in grams], np.int64).view(np.uint64)
        least = np.full(BANDS * BAND_ROWS, np.uint64(2**64 - 1))
        for at in range(0, len(hashes), 4096):
            mixed = hashes[at : at + 4096, None] * (times | np.uint64(1)) + plus
            least = np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(axis=0))
        bands = [zlib.crc32(b.tobytes(), k) for k, b in enumerate(least.reshape(BANDS, BAND_ROWS))]
        out.append([_key(folded), *[b * BANDS + k for k, b in enumerate(bands)]])
    return out


def _copies(sketches: list[list[int]]) -> dict[int, int]:
    """The group of each text that has copies, by key: texts that share a band, and theirs in turn."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = x = above[above[x]]
        return x

    first: dict[int, int] = {}
    for key, *bands in sorted(sketches):
        for band in bands:
            a, b = top(key), top(first.setdefault(band, key))
            above[max(a, b)] = min(a, b)
    many = {top(key) for key in above if top(key) != key} | {key for key, n in Counter(k for k, *_ in sketches).items() if n > 1}
    return {key: top(key) for key in above if top(key) in many}


def _pairs(column: pa.Array, copies: dict[int, int]) -> list[pa.Array]:
    """Per text its words and pairs of words, and its group of copies (null without copies)."""
    found: list[list[str]] = []
    groups: list[int | None] = []
    for text in column.to_pylist():
        folded = fold(text)
        words = folded.split()
        found.append([f" {p} " for p in {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}])
        groups.append(copies.get(_key(folded)))
    return [pa.array(found, pa.list_(pa.string())), pa.array(groups, pa.int64())]


def _harmless_phrases(sample: DataFrame, copies: dict[int, int], share: float) -> frozenset[str]:
    """Phrases of two words, of any words of the sample that might be terms, that are exceptions by their odds.

    A word's phrase counts if it is held against the word: its texts are toxic much less often
    than all texts of the word. A word without so many toxic texts as a term needs is left out.
    """
    found = map_texts(sample, lambda col: _pairs(col, copies), {"phrase": T.ArrayType(T.StringType()), "group": T.LongType()}, keep=["y"])
    each = found.select("y", "group", F.explode("phrase").alias("phrase"))
    once = lambda n: F.when(F.col("group").isNull(), n).otherwise(F.least(n, F.lit(1)))
    counts = each.groupBy("phrase", "group").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).groupBy(
        "phrase"
    ).agg(F.sum(once(F.col("t"))).alias("t"), F.sum(once(F.col("c"))).alias("c"))
    least = max(LEAST_TEXTS, math.ceil(LEAST_EVIDENCE / -math.log(share)))
    words_in = F.split(F.trim("phrase"), " ")
    t, c = F.col("t"), F.col("c")
    alone = F.size(words_in) == 1
    odds = F.log((t + 0.5) / (c + 0.5)) - math.log(share / (1 - share))
    counts = materialize(
        counts.filter((c >= PHRASE_TEXTS) & F.when(alone, t >= least).otherwise(odds <= MOST_ODDS)).withColumn("words", words_in),
        "toxic-phrases",
    )
    words = counts.filter(F.size("words") == 1).select(F.col("words")[0].alias("word"), (t / (t + c)).alias("_share"))
    phrases = counts.filter(F.size("words") == 2).withColumn("word", F.explode("words")).join(F.broadcast(words), "word")
    evidence = _evidence(t, c, F.col("_share"))
    spared = phrases.filter((t / (t + c) < F.col("_share")) & (evidence >= PHRASE_EVIDENCE))
    best = spared.groupBy("phrase").agg(F.max(evidence).alias("least")).orderBy(F.col("least").desc(), "phrase")
    return frozenset(r["phrase"] for r in best.limit(MAX_WEIGHED).collect())


def _candidates(column: pa.Array, copies: dict[int, int], spared: frozenset[str] = frozenset()) -> list[pa.Array]:
    """Per text word beginnings and words: each with a hash of the words around it (kind 0), and
    each once with the text's group of copies (kind 1; kind 2 and no key for a text without
    copies). ``apart`` is 1 if the use, or one of the text's uses, is in none of the phrases ``spared``.

    Copies of a passage repeat its words in the same surroundings, so counting different
    surroundings counts independent uses. A word always used in one phrase has but one
    surrounding; counting texts, one for each group of copies, supports it.
    """
    terms: list[str] = []
    kinds: list[int] = []
    keys: list[int] = []
    aparts: list[int] = []
    bounds = [0]
    for text in column.to_pylist():
        folded = fold(text)
        words = ["", *folded.split(), ""]
        own: dict[str, int] = {}
        for before, word, after in set(zip(words, words[1:], words[2:])):
            place = zlib.crc32(f"{before} {after}".encode())
            apart = int(f" {before} {word} " not in spared and f" {word} {after} " not in spared)
            found = [f" {word[:n]}" for n in STEM_LENGTHS if n <= len(word)]
            if len(word) <= LONGEST_WORD:
                found.append(f" {word} ")
            terms += found
            keys += [place] * len(found)
            aparts += [apart] * len(found)
            for term in found:
                own[term] = own.get(term, 0) | apart
        kinds += [0] * (len(terms) - len(kinds))
        group = copies.get(_key(folded))
        terms += own
        aparts += own.values()
        kinds += [2 if group is None else 1] * len(own)
        keys += [group or 0] * len(own)
        bounds.append(len(terms))
    offsets = pa.array(bounds, pa.int32())
    made = (pa.array(terms, pa.string()), pa.array(kinds, pa.int32()), pa.array(keys, pa.int64()), pa.array(aparts, pa.int32()))
    return [pa.ListArray.from_arrays(offsets, values) for values in made]


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights, exception phrases, and the logistic scale that turns hits into a score."""

    terms: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = ()
    scale: tuple[float, float, float] = (0.0, 0.0, -6.0)

    def automaton(self):
        import ahocorasick

        built = ahocorasick.Automaton()
        for phrase in self.exceptions:
            built.add_word(phrase, (len(phrase), None))
        for term, weight in self.terms:
            if not built.exists(term):
                built.add_word(term, (len(term), weight))
        if len(built):
            built.make_automaton()
        return built


def hits(folded: str, automaton) -> list[tuple[int, int, float]]:
    """Spans and weights of the lexicon's matches; the heaviest of those that start at one place,
    and none that lies inside an exception phrase."""
    if not len(automaton):
        return []
    best: dict[int, tuple[int, float]] = {}
    spared: list[tuple[int, int]] = []
    for last, (length, weight) in automaton.iter(folded):
        start = last + 1 - length
        if weight is None:
            spared.append((start, last + 1))
        elif start not in best or best[start][1] < weight:
            best[start] = (last + 1, weight)
    return [
        (start, end, weight)
        for start, (end, weight) in best.items()
        # a phrase and a term may share the space at either end
        if not any(a <= start and end <= b for a, b in spared)
    ]


def _weights(column: pa.Array, automaton) -> np.ndarray:
    """Per text: log of the weight of its hits, and log of that weight per hundred words."""
    out = np.zeros((len(column), 2))
    for row, text in enumerate(column.to_pylist()):
        folded = fold(text)
        weight = sum(w for _, _, w in hits(folded, automaton))
        if weight:
            out[row] = np.log1p(weight), np.log1p(100 * weight / (folded.count(" ") - 1))
    return out


def _evidence(t: Column, c: Column, share: Column) -> Column:
    """Chernoff's bound, in nats, on the chance that of t + c texts t or more are toxic (or t or
    fewer, below the share): (t + c) times the divergence of t / (t + c) from ``share``."""
    n = (t + c).cast("double")
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    return part(t, share) + part(c, 1 - share)


def _odds(counts: DataFrame, toxic: int, harmless: int) -> DataFrame:
    """Log odds of each term, how sure they are, and whether they are enough for the lexicon.

    Counted are surroundings ``t`` and ``c`` of toxic and harmless uses and texts ``toxic_texts``
    and ``harmless_texts``, one for each group of copies.
    """
    def odds(t: Column, c: Column) -> tuple[Column, Column]:
        at = F.log((t + 0.5) / (toxic + 1.0)) - F.log((c + 0.5) / (harmless + 1.0))
        return at, at - 2 * F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))

    by_use, least_by_use = odds(F.col("t"), F.col("c"))
    t, c = F.col("toxic_texts"), F.col("harmless_texts")
    by_text, least_by_text = odds(t, c)
    sure = (t >= LEAST_TEXTS) & (by_text > LEAST_ODDS) & (_evidence(t, c, F.lit(toxic / (toxic + harmless))) >= LEAST_EVIDENCE)
    often = least_by_use > LEAST_ODDS
    return counts.withColumns({
        "weight": F.greatest(F.when(often, by_use), F.when(sure, by_text)),
        "least": F.greatest(F.when(often, least_by_use), F.when(sure, least_by_text)),
        "good": often | sure,
    })


def _shortest(found: list[tuple[str, float, float]]) -> list[tuple[str, float]]:
    """Drop a term if a beginning of it says as much."""
    least = {term: bound for term, _, bound in found}
    kept = []
    for term, weight, bound in sorted(found, key=lambda x: (len(x[0]), x[0])):
        shorter = [least[term[:n]] for n in range(2, len(term)) if term[:n] in least]
        if not shorter or max(shorter) < bound - 0.5:
            kept.append((term, weight))
        else:
            least.pop(term)
    return kept


def _phrases(column: pa.Array, automaton) -> list[list[str]]:
    """Per text the distinct phrases of a hit's word with the word before or after it."""
    out = []
    for text in column.to_pylist():
        folded, found = fold(text), set()
        for start, _, _ in hits(folded, automaton):
            end = folded.index(" ", start + 1)
            word = folded[start : end + 1]
            before, after = folded[:start].rpartition(" ")[2], folded[end + 1 :].partition(" ")[0]
            found.update([f" {before}{word}"] * bool(before) + [f"{word}{after} "] * bool(after))
        out.append(sorted(found))
    return out


def _scale(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float, float]:
    """Logistic regression of the label on the two hit measures, for a true share of label 1."""
    if not len(y) or y.min() == y.max():
        return (0.0, 0.0, -6.0 if not len(y) or y.max() == 0 else 6.0)
    rows = np.column_stack([x, np.ones(len(y))])
    # the sample's label shares may differ from the table's
    tilt = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -40, 40)))
        slope = rows.T @ (tilt * (p - y)) / len(y) + 1e-4 * w
        curve = (rows * (tilt * p * (1 - p))[:, None]).T @ rows / len(y) + 1e-4 * np.eye(3)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return tuple(float(v) for v in w)


def _terms(
    sample: DataFrame, copies: dict[int, int], toxic: int, harmless: int, spared: frozenset[str] = frozenset()
) -> DataFrame:
    """The terms that are good enough for the lexicon, by all their uses or by those outside the phrases ``spared``."""
    parts = {"term": T.StringType(), "kind": T.IntegerType(), "key": T.LongType(), "apart": T.IntegerType()}
    found = map_texts(sample, lambda col: _candidates(col, copies, spared), {n: T.ArrayType(t) for n, t in parts.items()}, keep=["y"])
    terms = found.select("y", F.explode(F.arrays_zip(*parts)).alias("_t")).select("y", "_t.*")
    seen = {"t": F.col("y"), "c": 1 - F.col("y"), "t_apart": F.col("y") * F.col("apart"), "c_apart": (1 - F.col("y")) * F.col("apart")}
    # texts without copies are added up before they are shuffled; others and surroundings count once
    used = terms.groupBy("term", "kind", "key").agg(*[F.sum(n).alias(k) for k, n in seen.items()])
    once = lambda k: F.when(F.col("kind") == 2, F.col(k)).otherwise(F.least(k, F.lit(1)))
    total = lambda k, kind: F.sum(F.when(kind, once(k)).otherwise(0))
    counts = used.groupBy("term").agg(
        *[total(k, F.col("kind") == 0).alias(k) for k in seen], *[total(k, F.col("kind") > 0).alias(f"{k}_texts") for k in seen]
    )
    ways = F.array(*[
        F.struct(*[F.col(k + end).alias(n) for n, k, end in (
            ("t", f"t{way}", ""), ("c", f"c{way}", ""), ("toxic_texts", f"t{way}", "_texts"), ("harmless_texts", f"c{way}", "_texts")
        )])
        for way in ("", "_apart")
    ])
    either = counts.select("term", F.explode(ways).alias("_w")).select("term", "_w.*")
    return _odds(either, toxic, harmless).filter("good").groupBy("term").agg(
        F.max_by("weight", "least").alias("weight"), F.max("least").alias("least")
    )


def train(docs: DataFrame, labels: DataFrame, *, train_on: Column, limit: int = MAX_LABELLED) -> Lexicon:
    """Learn terms, exception phrases and scale from the labels that ``train_on`` admits.

    About half of at most ``limit`` texts are toxic ones, if there are as many; they are
    picked by a hash of the id. Terms are counted by Spark over that sample and only the
    best ``MAX_TERMS`` reach the driver. Without texts of both labels the lexicon is empty.
    """
    prepare(docs.sparkSession)
    toxic_labels = labels.filter(F.col("toxic") == 1)
    parts = [
        labelled_sample(docs, some, "toxic", train=train_on, limit=limit // 2, seed="toxic")
        for some in (toxic_labels, labels.filter(F.col("toxic") == 0).join(toxic_labels.select("doc_id"), "doc_id", "left_anti"))
    ]
    sample = materialize(parts[0].unionByName(parts[1]), "toxic-sample")
    seen = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    toxic, harmless = seen.get(1, 0), seen.get(0, 0)
    if not toxic or not harmless:
        return Lexicon((), (), _scale(np.zeros((0, 2)), np.zeros(0), 0.5))
    usable = labels.filter(train_on & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    share = usable.agg(F.avg("toxic")).first()[0]

    copies = _copies([
        r["sketch"] for r in map_texts(
            sample, lambda col: [pa.array(_sketch(col), pa.list_(pa.int64()))], {"sketch": T.ArrayType(T.LongType())}, keep=[]
        ).collect()
    ])
    balance = toxic / (toxic + harmless)
    spared = _harmless_phrases(sample, copies, balance)
    good = _terms(sample, copies, toxic, harmless, spared)
    best = good.orderBy(F.col("least").desc(), "term").limit(MAX_TERMS).collect()
    lexicon = Lexicon(tuple(_shortest([(r["term"], r["weight"], r["least"]) for r in best])))

    phrases = map_texts(
        sample, lambda col: [pa.array(_phrases(col, lexicon.automaton()), pa.list_(pa.string()))],
        {"phrases": T.ArrayType(T.StringType())}, keep=["y"],
    )
    met = phrases.select("y", F.explode("phrases").alias("phrase")).groupBy("phrase").agg(
        F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")
    )
    # few phrases meet a term of the lexicon, and of those these are exceptions
    known = sample.sparkSession.createDataFrame([(p,) for p in sorted(spared)], "phrase string").withColumn("known", F.lit(True))
    met = met.filter(F.col("c") >= PHRASE_TEXTS).join(known, "phrase", "left").filter((F.col("t") == 0) | F.col("known"))
    exceptions = [r["phrase"] for r in met.orderBy(F.col("c").desc(), "phrase").limit(MAX_PHRASES).collect()]
    lexicon = Lexicon(lexicon.terms, tuple(sorted(exceptions)))

    pairs = map_texts(
        sample, lambda col: list(map(pa.array, _weights(col, lexicon.automaton()).T.copy())),
        {"total": T.DoubleType(), "dense": T.DoubleType()}, keep=["y"],
    ).toArrow()
    x = np.column_stack([pairs.column("total").to_numpy(), pairs.column("dense").to_numpy()])
    y = pairs.column("y").to_numpy()
    order = np.lexsort((x[:, 1], x[:, 0], y))  # the same fit whatever order the tasks end in
    return Lexicon(lexicon.terms, lexicon.exceptions, _scale(x[order], y[order], share))


def score(docs: DataFrame, lexicon: Lexicon, *, name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Every row with its toxicity score in 0..1.

    Whole texts are folded and matched; null and empty texts count as texts without a hit.
    Equal texts get equal scores; repeated rows and null ids stay as they are; other columns
    pass through (one called ``name`` is replaced). An empty table gives an empty table.
    """
    a, b, c = lexicon.scale

    def work(texts: pa.Array) -> list[pa.Array]:
        x = _weights(texts, lexicon.automaton())
        return [pa.array(1 / (1 + np.exp(-np.clip(x @ np.array([a, b]) + c, -40, 40))))]

    return map_texts(docs, work, {name: T.DoubleType()}, keep=keep)
