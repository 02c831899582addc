"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of words that repeats a block of q words, q the least such number, at least
``REPEATS`` times, and that no neighbouring word lengthens. At the scale of grams of G words,
G = 8, 16, 32 and so on, the minimizers are the grams of least hash in a window of G / 2 grams.
Inside a run with G / 2 < q <= G two grams are equal just where their distance is a multiple of
q, so some minimizer is met again q words on, with no equal one in between: equal minimizers next
to each other at a distance of (G / 2, G] are the seeds, which are then lengthened word by word.
Periods of up to ``SHORTEST`` words are found by comparing every word with the one q words on.

Why a seed is never missed: a run of 4 q words holds at least 4 q - G + 1 grams, so that a window
of G / 2 grams and its like q words on both lie inside it (G / 2 + q <= 4 q - G + 1 for q > G / 2).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from kiosklake.llm.common import CHUNK_BYTES, map_texts, mix, utf8

#: Repeats and words that make a run, and the longest period that is compared directly.
REPEATS, LEAST_WORDS, SHORTEST = 4, 6, 4

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


# ---------------------------------------------------------------- words

def _split(raw: bytes) -> Iterator[list[bytes]]:
    """Words of a text, in lists of about a megabyte. Bytes split at ASCII white space."""
    if len(raw) <= CHUNK_BYTES:
        yield raw.split()
        return
    begin, size = 0, len(raw)
    while begin < size:
        end = min(begin + CHUNK_BYTES, size)
        blanks = [at for at in (raw.find(s, end) for s in b" \t\n\x0b\x0c\r") if at >= 0]
        end = min(blanks, default=size) if end < size else size
        yield raw[begin:end].split()
        begin = end


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One number for each word, equal where words are, and the n + 1 bounds of the texts.

    Each text is followed by a number of its own, so that nothing repeats across texts.
    """
    numbers = defaultdict(count().__next__)
    parts, bounds = [], [0]
    for i, raw in enumerate(texts):
        n = 0
        for words in _split(raw):
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            n += len(words)
        parts.append(np.array([-1 - i], np.int64))
        bounds.append(bounds[-1] + n + 1)
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array(bounds, np.int64)


# ---------------------------------------------------------------- runs

def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _least_length(period, repeats: int):
    return np.maximum(LEAST_WORDS, repeats * period)


def _factors(n: int) -> list[int]:
    """Prime divisors."""
    found, d = [], 2
    while d * d <= n:
        if n % d == 0:
            found.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return found + [n] if n > 1 else found


def _by_lags(words: np.ndarray, repeats: int, found: list) -> None:
    """Runs of periods up to SHORTEST."""
    same = {}
    for q in range(1, min(SHORTEST, len(words) - 1) + 1):
        flags = words[:-q] == words[q:]
        same[q] = np.append(0, np.cumsum(flags))
        starts, ends = _stretches(flags)
        lengths = ends - starts + q
        good = lengths >= _least_length(q, repeats)
        for r in _factors(q):  # a stretch of a shorter period is that period's run
            p = q // r
            good &= same[p][np.minimum(starts + lengths - p, len(same[p]) - 1)] - same[p][starts] < lengths - p
        found.append((starts[good], lengths[good], np.full(good.sum(), q)))


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every window of ``width`` values, a power of two."""
    span = 1
    while span < width:
        values = pick(values[:-span], values[span:])
        span *= 2
    return values


def _seeds(grams: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances and places of equal minimizers next to each other, sorted."""
    width = size // 2
    low = _slide(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    # a gram is least in some window if no window that holds it has a least one below it
    least = _slide(np.concatenate((edge, low, edge)), width, np.maximum) == grams
    places = np.flatnonzero(least)
    hashes = grams[places]
    order = np.argsort(hashes, kind="stable")
    places, hashes = places[order], hashes[order]
    gap = places[1:] - places[:-1]
    seed = (hashes[1:] == hashes[:-1]) & (gap > width) & (gap <= size)
    gap, places = gap[seed], places[:-1][seed]
    order = np.lexsort((places, gap))
    return gap[order], places[order]


def _reach(words: np.ndarray, at: int, q: int, step: int) -> int:
    """How far words equal those q on, from ``at`` in the direction of ``step``."""
    size, done = 64, 0
    while True:
        if step > 0:
            a, b = words[at + done : at + done + size], words[at + q + done : at + q + done + size]
            n = min(len(a), len(b))
            differ = a[:n] != b[:n]
        else:
            low = max(at - done - size + 1, 0)
            n = at - done + 1 - low
            differ = (words[low : low + n] != words[low + q : low + q + n])[::-1]
        if differ.any():
            return done + int(np.argmax(differ))
        done += n
        if n < size:
            return done
        size *= 2


def _by_seeds(words: np.ndarray, gaps: np.ndarray, places: np.ndarray, repeats: int, found: list) -> None:
    runs, period, end = [], 0, 0
    for q, at in zip(gaps.tolist(), places.tolist()):
        if q == period and at < end:
            continue  # in the stretch of an earlier seed
        right = _reach(words, at, q, 1)
        if not right:
            continue
        start = at - (_reach(words, at - 1, q, -1) if at else 0)
        period, end = q, at + right
        length = end - start + q
        if length >= _least_length(q, repeats) and not any(
            np.array_equal(words[start : start + length - q // r], words[start + q // r : start + length]) for r in _factors(q)
        ):
            runs.append((start, length, q))
    if runs:
        found.append(tuple(np.array(x, np.int64) for x in zip(*runs)))


def find_runs(words: np.ndarray, bounds: np.ndarray, repeats: int = REPEATS) -> tuple[np.ndarray, ...]:
    """Text, start, length and period of all runs, by text, start and period.

    ``words`` holds a number for each word of texts laid end to end, each followed by a number
    that occurs nowhere else; ``bounds`` are the places where texts begin, then the end.
    """
    if repeats < REPEATS:
        raise ValueError(f"seeds are sure to be found for {REPEATS} repeats or more")
    found: list[tuple] = []
    _by_lags(words, repeats, found)
    sizes = np.diff(bounds) - 1
    size, grams, inside = 1, mix(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), None
    place = np.arange(len(words))
    kept = words
    while len(kept):
        if size > SHORTEST and len(grams) >= size // 2:
            gaps, places = _seeds(grams, size)
            _by_seeds(kept, gaps, places, repeats, collected := [])
            found += [(place[start], length, period) for start, length, period in collected]
        # of the next scale, texts that can hold a run of it
        inside = sizes >= repeats * (size + 1)
        if size >= SHORTEST and not inside.all():
            stay = np.repeat(inside, sizes + 1)
            grams = grams[stay[: len(grams)]]
            kept, place, sizes = kept[stay], place[stay], sizes[inside]
        if len(grams) <= size:
            break
        with np.errstate(over="ignore"):
            grams = mix(grams[:-size] * np.uint64(0x9E3779B97F4A7C15) + grams[size:])
        size *= 2
    start, length, period = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(bounds, start, side="right") - 1
    return text, start - bounds[text], length, period


def collapse(raw: bytes, starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> bytes:
    """The words of a text less those after the first block of a run, joined by one space."""
    if not len(starts):
        return b" ".join(b" ".join(words) for words in _split(raw) if words)
    change = np.zeros(int((starts + lengths).max()) + 1, np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    keep = np.cumsum(change) == 0
    parts, at = [], 0
    for words in _split(raw):
        flags = keep[at : at + len(words)].tolist()
        flags += [True] * (len(words) - len(flags))
        at += len(words)
        parts.append(b" ".join(compress(words, flags)))
    return b" ".join(part for part in parts if part)


# ---------------------------------------------------------------- over frames

def mark(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, repeats: int = REPEATS) -> DataFrame:
    """Every row with ``runs`` and ``collapsed``.

    ``runs`` is an array of (start, length, period) in words ``[^\\x20\\x09-\\x0D]+`` numbered from 0,
    by start, then period; ``collapsed`` holds the words that are in no run after its first
    ``period`` words, joined by one space. ``repeats`` is 4 or more.

    Null, empty and blank texts have no runs and collapse to ''. Words compare as bytes, so the
    result is exact; only a seed rests on 64-bit hashes. Equal texts get equal results; repeated
    rows and null row ids stay as they are; other columns pass through (``runs`` and
    ``collapsed`` are replaced); an empty table gives an empty table. A text is worked on as
    a whole, with some 30 bytes a byte of it; no other row waits in memory beyond a megabyte.
    """
    def work(column: pa.Array) -> list[pa.Array]:
        data, offsets = utf8(column)
        texts = [data[a:b].tobytes() for a, b in zip(offsets.tolist(), offsets.tolist()[1:])]
        words, bounds = _numbered(texts)
        at, *runs = find_runs(words, bounds, repeats)
        first = np.searchsorted(at, np.arange(len(texts) + 1))
        shown = [
            collapse(raw, *(x[a:b] for x in runs)).decode("utf-8", "replace") for raw, a, b in zip(texts, first, first[1:])
        ]
        values = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in runs], RUN.names)
        return [pa.ListArray.from_arrays(pa.array(first, pa.int32()), values), pa.array(shown, pa.string())]

    return map_texts(docs, work, {"runs": T.ArrayType(RUN), "collapsed": T.StringType()}, text=text, keep=keep)


def strongest(runs: Column) -> Column:
    """Of a row's runs the one of greatest length / period, exactly; of equals the first. Null if none."""
    none = F.lit(None).cast(RUN)
    better = lambda best, run: best["period"].isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    return F.aggregate(runs, none, lambda best, run: F.when(better(best, run), run).otherwise(best))
