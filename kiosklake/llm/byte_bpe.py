"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, offsets kept for decoding.

Pre-tokens are those of the public pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

found without a regex: each code point has a class, each class is a transition function of a
small automaton, and because functions compose associatively a scan over blocks of them gives
the automaton's state, and so the boundaries, at every place of many texts at once.
"""

from __future__ import annotations

import base64
import heapq
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from kiosklake.llm.common import chunks, map_texts

#: Distinct pre-tokens whose merges a worker remembers.
CACHE = 150_000

# ---------------------------------------------------------------- the automaton

LETTER, NUMBER, OTHER, SPACE, LAST_SPACE, BLANK, LAST_BLANK, SHORT, LONG = range(9)
_FRESH, _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _JOINABLE, _IN_BLANKS, _ONE_MORE, _TWO_MORE = range(8)
_NEXT_OF = {LETTER: _IN_LETTERS, NUMBER: _IN_NUMBERS, OTHER: _IN_OTHERS, LAST_SPACE: _JOINABLE}


def _next(state: int, symbol: int) -> int:
    """SHORT and LONG are apostrophes before one or two letters that make a contraction."""
    if state >= _ONE_MORE:
        return _FRESH if state == _ONE_MORE else _ONE_MORE
    if symbol in (SHORT, LONG):
        if state in (_IN_OTHERS, _JOINABLE):
            return _IN_OTHERS
        return _ONE_MORE if symbol == SHORT else _TWO_MORE
    return _NEXT_OF.get(symbol, _IN_BLANKS)


def _opens(state: int, symbol: int) -> bool:
    """Whether a pre-token begins at this symbol."""
    if state >= _ONE_MORE:
        return False
    if symbol in (LAST_SPACE, LAST_BLANK):
        return True  # the last blank before a word leaves the run of blanks
    if symbol in (SPACE, BLANK):
        return state != _IN_BLANKS
    own = _IN_OTHERS if symbol in (OTHER, SHORT, LONG) else _NEXT_OF[symbol]
    return state not in (own, _JOINABLE)


@lru_cache(maxsize=1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All composed transition functions: their composition, their values, and the ids of the symbols'
    functions inside a text and at its first place."""
    inner = [tuple(_next(s, x) for s in range(8)) for x in range(9)]
    first = [(_next(_FRESH, x),) * 8 for x in range(9)]
    ids = {tuple(range(8)): 0}
    todo = [*inner, *first]
    while todo:
        f = todo.pop()
        if f not in ids:
            ids[f] = len(ids)
            todo += [tuple(g[v] for v in f) for g in (*inner, *first)]
    functions = list(ids)
    then = np.array([[ids.get(tuple(g[v] for v in f), 0) for g in functions] for f in functions], np.uint16)
    symbols = [np.array([ids[f] for f in some], np.uint16) for some in (inner, first)]
    return then, np.array(functions, np.uint8), *symbols


def _scan(ids: np.ndarray, then: np.ndarray, block: int = 64) -> np.ndarray:
    """Composition of the functions up to and with each place."""
    if len(ids) <= block:
        out = ids.copy()
        for i in range(1, len(out)):
            out[i] = then[out[i - 1], out[i]]
        return out
    blocks = -(-len(ids) // block)
    lanes = np.zeros(blocks * block, np.uint16)  # 0 is the identity
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(blocks, block).T.copy()
    flat, wide = then.ravel(), np.intp(len(then))
    for i in range(1, block):
        lanes[i] = flat[lanes[i - 1] * wide + lanes[i]]
    before = np.zeros(blocks, np.uint16)
    before[1:] = _scan(lanes[-1], then)[:-1]
    lanes = flat[before * wide + lanes]
    return lanes.T.ravel()[: len(ids)]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Letter, number, other or blank by code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    # White space outside ASCII, then ASCII's.
    table[[0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = BLANK
    table[[9, 10, 11, 12, 13, 32]] = BLANK
    return table


def boundaries(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places where pre-tokens begin, in code points of texts joined end to end.

    ``starts`` holds the first place of each text that is not empty.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    symbols = _classes()[codes]
    opens_text = np.zeros(n + 2, bool)
    opens_text[starts] = True
    opens_text[n] = True
    blank = symbols == BLANK
    last = blank.copy()
    last[:-1] &= ~blank[1:]
    last &= ~opens_text[1 : n + 1]
    space = codes == 32
    symbols[space] = SPACE
    symbols[last] += 1  # SPACE to LAST_SPACE, BLANK to LAST_BLANK
    marks = np.flatnonzero(codes == 39)
    if len(marks):
        padded = np.append(codes, [0, 0])
        one, two = padded[marks + 1], padded[marks + 2]
        inside = ~opens_text[marks + 1]
        short = inside & np.isin(one, list(map(ord, "stmd")))
        pair = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        symbols[marks[short]] = SHORT
        symbols[marks[inside & ~opens_text[np.minimum(marks + 2, n)] & pair]] = LONG
    then, values, inner, first = _monoid()
    functions = inner[symbols]
    functions[starts] = first[symbols[starts]]
    states = np.zeros(n, np.uint8)
    states[1:] = values[_scan(functions, then)[:-1], _FRESH]
    states[starts] = _FRESH
    opens = np.array([[_opens(s, x) for x in range(9)] for s in range(8)])
    return np.flatnonzero(opens[states, symbols])


# ---------------------------------------------------------------- merging

class Vocabulary:
    """Merge ranks read from a rank file, and the pieces laid end to end for decoding."""

    def __init__(self, path: str) -> None:
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    piece, rank = line.split()
                    self.ranks[base64.b64decode(piece)] = int(rank)
        pieces = {rank: piece for piece, rank in self.ranks.items()}
        size = max(pieces, default=-1) + 1
        self.lengths = np.array([len(pieces.get(i, b"")) for i in range(size)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(pieces.get(i, b"") for i in range(size)), np.uint8)
        self.cache: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ranks of a pre-token: the pair of lowest rank is joined first, the leftmost of equals."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > 200:
            return self._merge_long(piece)
        none = len(ranks) + (1 << 32)
        cuts = list(range(len(piece) + 1))
        pairs = [ranks.get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            del cuts[i + 1]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(piece[cuts[i] : cuts[i + 2]], none)
            if i:
                pairs[i - 1] = ranks.get(piece[cuts[i - 1] : cuts[i + 1]], none)
        return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap, for pre-tokens of any length."""
        ranks, n = self.ranks, len(piece)
        end, back = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(at: int) -> None:
            middle = end[at]
            if middle < n:
                rank = ranks.get(piece[at : end[middle]])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, middle, end[middle]))

        for at in range(n - 1):
            offer(at)
        alive = [True] * n
        while heap:
            _, at, middle, stop = heapq.heappop(heap)
            if not alive[at] or end[at] != middle or not alive[middle] or end[middle] != stop:
                continue
            alive[middle] = False
            end[at] = stop
            if stop < n:
                back[stop] = at
            offer(at)
            if back[at] >= 0:
                offer(back[at])
        return [ranks[piece[at : end[at]]] for at in range(n) if alive[at]]

    def packed(self, piece: bytes) -> bytes:
        """Merged ids as little-endian 32-bit integers, remembered."""
        ids = self.merge(piece)
        known = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[piece] = known
        return known

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Packed ids of each of the texts that ``data`` joins."""
        raw = data.tobytes()
        codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        place = np.flatnonzero((data & 0xC0) != 0x80)
        filled = offsets[:-1] < offsets[1:]
        cuts = place[boundaries(codes, np.searchsorted(place, offsets[:-1][filled]))]
        first = np.searchsorted(cuts, offsets).tolist()
        cuts = cuts.tolist()
        cuts.append(len(raw))
        pieces = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        known, packed = self.cache.get, self.packed
        ids = [known(p) or packed(p) for p in pieces]
        return [b"".join(ids[a:b]) for a, b in zip(first, first[1:])]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        """The bytes of the ids; ``ends`` says where each id's piece stops."""
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))].tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Read once in each worker."""
    return Vocabulary(path)


# ---------------------------------------------------------------- over frames

def _clean(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that are no UTF-8 become replacement characters, text by text."""
    texts = [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(offsets, offsets[1:])]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _packed(column: pa.Array, words: Vocabulary) -> Iterator[bytes]:
    for _, _, data, offsets in chunks(column):
        try:
            yield from words.encode(data, offsets)
        except UnicodeDecodeError:
            yield from words.encode(*_clean(data, offsets))


def encode(docs: DataFrame, path: str, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row with ``ids`` and ``ends``: its token ids, and the byte offset at which each ends.

    Both are binary, little-endian unsigned 32-bit integers in order. ``path`` names a rank
    file that every worker can open. No special tokens: their strings are ordinary text. Null
    and empty texts have no ids. Equal texts get equal ids; repeated rows and null row ids
    stay as they are; other columns pass through (``ids`` and ``ends`` are replaced). An empty
    table gives an empty table.
    """
    def work(column: pa.Array) -> list[pa.Array]:
        words = vocabulary(path)
        ids = list(_packed(column, words))
        ends = [np.cumsum(words.lengths[np.frombuffer(x, "<u4")]).astype("<u4").tobytes() for x in ids]
        return [pa.array(ids, pa.binary()), pa.array(ends, pa.binary())]

    return map_texts(docs, work, {"ids": T.BinaryType(), "ends": T.BinaryType()}, text=text, keep=keep)


def decode(encoded: DataFrame, path: str, *, keep: list[str] | None = None) -> DataFrame:
    """Every row with ``decoded``: the bytes that its ``ids`` stand for, placed by its ``ends``.

    Null ids decode to no bytes. Other columns pass through (``decoded`` is replaced).
    """
    held = encoded.withColumn("_coded", F.struct("ids", "ends"))

    def work(column: pa.StructArray) -> list[pa.Array]:
        words = vocabulary(path)
        rows = zip(column.field(0).to_pylist(), column.field(1).to_pylist())
        return [pa.array([
            words.decode(np.frombuffer(ids or b"", "<u4"), np.frombuffer(ends or b"", "<u4").astype(np.int64))
            for ids, ends in rows
        ], pa.binary())]

    kept = encoded.columns if keep is None else keep
    return map_texts(held, work, {"decoded": T.BinaryType()}, text="_coded", keep=kept)
