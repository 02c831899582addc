"""SentencePiece BPE: vectorised merge rounds over flat symbol arrays, and decoding by table.

A text becomes words that no piece of the vocabulary can cross. Words not met before are merged
together: their symbols lie end to end in one array, each round finds the least pair rank of
every word, joins its leftmost pair of that rank in all words at once, and closes the gaps, until
no word has a pair left. Where joining one pair cannot give rise to a pair of the same or a lower
rank, all pairs of that rank in a word are joined in the same round, which is what joining them
one after the other would give.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from kiosklake.llm.common import CHUNK_BYTES, map_texts, utf8

#: Distinct words whose ids a worker remembers, and the longest of them in bytes.
CACHE, CACHED_BYTES = 300_000, 64

BLANK = "▁"
# Fixed values of the model format: kinds of pieces, and the kind of model that merges pairs.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES_PAIRS = 2
_NONE = np.int32(2**31 - 1)


# ---------------------------------------------------------------- the model file

def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one message of the model file."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = number()
        yield tag >> 3, data[at : at + size]
        at += size


def _read(path: str) -> tuple[list[tuple[str, float, int]], dict[int, int | bytes], dict[int, int | bytes]]:
    """Pieces with score and kind, and the settings of training and of normalising."""
    pieces, training, normalising = [], {}, {}
    with open(path, "rb") as file:
        for field, value in _fields(file.read()):
            if field == 1:
                entry = dict(_fields(value))
                score = struct.unpack("<f", entry.get(2, b"\0\0\0\0"))[0]
                pieces.append((entry.get(1, b"").decode(), score, entry.get(3, NORMAL)))
            elif field == 2:
                training = dict(_fields(value))
            elif field == 3:
                normalising = dict(_fields(value))
    return pieces, training, normalising


# ---------------------------------------------------------------- merging

class Pieces:
    """Merge ranks of a model file, and its pieces laid end to end for decoding.

    Symbols are piece ids; then come characters that occur in pieces without being one; any
    other character is the negative number -1 - code point, and never merges.
    """

    def __init__(self, path: str) -> None:
        pieces, training, normalising = _read(path)
        kinds = {kind for _, _, kind in pieces}
        if training.get(3) != MERGES_PAIRS or not training.get(35) or kinds & {USER_DEFINED, UNUSED}:
            raise ValueError(f"{path}: only pair-merging models with byte fallback, without user-defined or unused pieces")
        if normalising.get(2) or normalising.get(4, 1) or not normalising.get(3, 1) or not normalising.get(5, 1) or training.get(24):
            raise ValueError(f"{path}: only models that keep texts as they are, with one blank put before")
        self.size = len(pieces)
        symbols = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        for text in list(symbols):
            for char in text:
                symbols.setdefault(char, self.size + len(symbols))
        loose = sorted(c for c, i in symbols.items() if i >= self.size)
        symbols |= {c: self.size + k for k, c in enumerate(loose)}
        self.loose = np.array([ord(c) for c in loose], np.int64)
        self.symbol_of = -1 - np.arange(0x110000, dtype=np.int32)
        for text, i in symbols.items():
            if len(text) == 1:
                self.symbol_of[ord(text)] = i
        self.symbol_of[32] = self.symbol_of[ord(BLANK)]
        self._learn_pairs(pieces, symbols)
        self._learn_neighbours([text for text, _, kind in pieces if kind == NORMAL])
        self.byte_ids = np.zeros(256, np.int32)
        for i, (text, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte_ids[int(text[3:5], 16)] = i
        self._learn_texts(pieces)
        self.cache: dict[bytes, bytes] = {}
        self.blanks = 0
        self.blanks = self._longest_blank([text for text, _, kind in pieces if kind == NORMAL])

    def _learn_pairs(self, pieces: list, symbols: dict[str, int]) -> None:
        order = {score: rank for rank, score in enumerate(sorted({s for _, s, kind in pieces if kind == NORMAL}, reverse=True))}
        self.rank_of = np.full(self.size, _NONE, np.int32)
        self.width = self.size + len(self.loose) + 1
        pairs = {}
        for i, (text, score, kind) in enumerate(pieces):
            if kind != NORMAL:
                continue
            self.rank_of[i] = order[score]
            for cut in range(1, len(text)):
                left, right = symbols.get(text[:cut]), symbols.get(text[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.joined = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        # a piece that may join on at its own rank or a lower one
        self.early = np.zeros(self.size, bool)
        for side in (self.keys // self.width, self.keys % self.width):
            known = side < self.size
            part, whole = side[known], self.joined[known]
            self.early[part[self.rank_of[whole] <= self.rank_of[part]]] = True

    def _learn_neighbours(self, texts: list[str]) -> None:
        """Which characters stand side by side in some piece; between others no pair merges."""
        beside = {(a, b) for text in texts for a, b in zip(text, text[1:])}
        codes = np.array(sorted((ord(a) << 21) | ord(b) for a, b in beside), np.int64)
        self.beside = codes
        self.bytes_beside = np.ones((256, 256), bool)
        self.bytes_beside[:128, :128] = False
        plain = {BLANK: " "}
        for a, b in beside:
            a, b = ord(plain.get(a, a)), ord(plain.get(b, b))
            if a < 128 and b < 128:
                self.bytes_beside[a, b] = True
        if any(b == BLANK and a != BLANK for a, b in beside):
            raise ValueError("only models whose pieces have no blank after another character")
        self.bytes_beside[128:, 32] = False
        self.bytes_beside = self.bytes_beside.ravel()

    def _longest_blank(self, texts: list[str]) -> int:
        """How many blanks a long run gives off from its left at a time; 0 if it does not do so."""
        if any(BLANK + BLANK in t and t.strip(BLANK) for t in texts):
            return 0
        longest = max((len(t) for t in texts if not t.strip(BLANK)), default=0)
        if longest < 2:
            return 0
        runs = [b" " * n for n in range(1, 4 * longest)]
        known = dict(zip(range(1, 4 * longest), self.merge(runs)))
        whole = known[longest]
        holds = all(known[n] == whole + known[n - longest] for n in range(longest + 1, 4 * longest))
        return longest if holds and len(whole) == 4 else 0

    def _learn_texts(self, pieces: list) -> None:
        """What each id decodes to."""
        shown = {UNKNOWN: " ⁇ ".encode(), CONTROL: b""}
        flat = [
            bytes([int(text[3:5], 16)]) if kind == BYTE else shown.get(kind, text.replace(BLANK, " ").encode())
            for text, _, kind in pieces
        ]
        self.lengths = np.array([len(x) for x in flat], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(flat), np.uint8)
        self.kinds = np.array([kind for _, _, kind in pieces], np.int8)
        self.opens_blank = np.array([kind == NORMAL and text.startswith(BLANK) for text, _, kind in pieces])

    # -- rounds

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; the greatest rank where it is none."""
        key = left.astype(np.int64) * self.width + right
        key[(left < 0) | (right < 0)] = -1
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        if not len(self.keys):
            return np.full(len(key), _NONE, np.int32), np.zeros(len(key), np.int32)
        piece = self.joined[at]
        return np.where(self.keys[at] == key, self.rank_of[piece], _NONE), piece

    def _rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols and the word of each; ``word`` ascends."""
        rank = np.full(len(symbols), _NONE, np.int32)
        piece = np.zeros(len(symbols), np.int32)

        def renew(at: np.ndarray) -> None:
            rank[at] = _NONE
            at = at[at + 1 < len(symbols)]
            at = at[word[at] == word[at + 1]]
            rank[at], piece[at] = self._pairs(symbols[at], symbols[at + 1])

        renew(np.arange(len(symbols)))
        done_symbols, done_words = [], []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(word))))
            live = low != _NONE
            if not live.all():
                done_symbols.append(symbols[~live])
                done_words.append(word[~live])
                symbols, word, rank, piece, low = (x[live] for x in (symbols, word, rank, piece, low))
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == low)
            opens = np.append(True, at[1:] != at[:-1] + 1)
            run = np.flatnonzero(opens)
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[place % 2 == 0]  # of overlapping pairs, the first, third and so on
            early = self.early[piece[at]]
            if early.any():
                one_only = np.isin(word[at], word[at[early]])
                leftmost = np.append(True, word[at[1:]] != word[at[:-1]])
                at = at[leftmost | ~one_only]
            symbols[at] = piece[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, word, rank, piece = (x[stay] for x in (symbols, word, rank, piece))
            at = at - np.arange(len(at))
            renew(np.concatenate((at, at[at > 0] - 1)))
        if not done_symbols:
            return symbols, word
        word = np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return np.concatenate(done_symbols)[order], word[order]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Packed ids (32-bit) of each word; a blank is an ASCII space. Words are valid UTF-8."""
        raw = b"".join(words)
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        data = np.frombuffer(raw, np.uint8)
        place = np.cumsum((data & 0xC0) != 0x80)  # characters up to and with each byte
        ends = np.cumsum([len(w) for w in words])
        first = np.append(0, place[ends - 1]) if len(data) else np.zeros(len(words) + 1, np.int64)
        opens = np.zeros(len(codes) + 1, bool)
        opens[first] = True
        named = np.where(codes == 32, ord(BLANK), codes)
        pair = (named[:-1] << 21) | named[1:]
        at = np.minimum(np.searchsorted(self.beside, pair), max(len(self.beside) - 1, 0))
        if len(self.beside):
            opens[1:-1] |= self.beside[at] != pair
        segment = np.cumsum(opens[:-1]) - 1
        symbols, segment = self._rounds(self.symbol_of[codes], segment)
        ids, sizes = self._ids(symbols)
        # how many ids come before the first segment of each word
        opening = np.append(np.cumsum(opens[:-1]), np.count_nonzero(opens[:-1]) + 1)[first] - 1
        before = np.append(0, np.cumsum(sizes))[np.searchsorted(segment, opening)]
        packed = ids.astype("<i4").tobytes()
        return [packed[4 * a : 4 * b] for a, b in zip(before.tolist(), before.tolist()[1:])]

    def _ids(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, characters outside the vocabulary by their bytes; ids of each symbol."""
        sizes = np.ones(len(symbols), np.int64)
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.size))
        if not len(odd):
            return symbols, sizes
        code = -1 - symbols[odd].astype(np.int64)
        inner = code < 0
        code[inner] = self.loose[symbols[odd[inner]] - self.size]
        sizes[odd] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        ids = np.repeat(symbols, sizes)
        raw = code.astype("<u4").tobytes().decode("utf-32-le").encode()
        at = np.repeat(np.cumsum(sizes)[odd] - sizes[odd], sizes[odd])
        at += np.arange(len(at)) - np.repeat(np.cumsum(sizes[odd]) - sizes[odd], sizes[odd])
        ids[at] = self.byte_ids[np.frombuffer(raw, np.uint8)]
        return ids, sizes

    # -- texts

    def _words(self, raw: bytes, starts: np.ndarray) -> tuple[list[bytes], list[int]]:
        """Words of texts joined end to end, and the first word of each text."""
        data = np.frombuffer(raw, np.uint8)
        opens = np.zeros(len(data) + 1, bool)
        opens[1:-1] = ~self.bytes_beside[(data[:-1].astype(np.uint16) << 8) | data[1:]]
        opens[starts] = True
        if self.blanks and b" " * (self.blanks + 1) in raw:
            blank = np.flatnonzero(data == 32)
            new = np.append(True, (blank[1:] != blank[:-1] + 1)) | opens[blank]
            run = np.flatnonzero(new)
            place = np.arange(len(blank)) - np.repeat(run, np.diff(np.append(run, len(blank))))
            opens[blank[place % self.blanks == 0]] = True
        cuts = np.flatnonzero(opens[:-1])
        first = np.searchsorted(cuts, starts).tolist()
        cuts = cuts.tolist()
        cuts.append(len(raw))
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])], first

    def _encode_run(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each of some texts that have their blank before them."""
        starts = np.cumsum([0, *map(len, texts)])
        words, first = self._words(b"".join(texts), starts)
        if len(self.cache) > CACHE:
            self.cache.clear()
        met = set(words)
        fresh = list(met - self.cache.keys())
        known = self.cache
        if fresh:
            made = dict(zip(fresh, self.merge(fresh)))
            self.cache.update((w, ids) for w, ids in made.items() if len(w) <= CACHED_BYTES)
            if len(made) and max(map(len, fresh)) > CACHED_BYTES:
                known = {w: self.cache.get(w) or made[w] for w in met}
        ids = list(map(known.__getitem__, words))
        return [b"".join(ids[a:b]) for a, b in zip(first, first[1:])]

    def encode(self, column: pa.Array) -> Iterator[bytes]:
        """Packed ids of every text, in pieces of about CHUNK_BYTES cut between words."""
        data, offsets = utf8(column)
        run, size = [], 0
        for a, b in zip(offsets.tolist(), offsets.tolist()[1:]):
            text = _clean(data[a:b].tobytes())
            if len(text) > CHUNK_BYTES:
                yield from self._encode_run(run)
                run, size = [], 0
                yield b"".join(self._encode_run([part])[0] for part in _parts(text))
                continue
            run.append(text)
            size += len(text)
            if size > CHUNK_BYTES:
                yield from self._encode_run(run)
                run, size = [], 0
        yield from self._encode_run(run)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of what the ids stand for, less the blank put before the text."""
        control = self.kinds[ids] == CONTROL
        if control.any():  # bytes on both sides of a control piece form no character
            parts = [self._text(part) for part in np.split(ids[~control], np.flatnonzero(control) - np.arange(control.sum()))]
        else:
            parts = [self._text(ids)]
        text = b"".join(parts)
        spoken = ids[~control]
        return text[1:] if len(spoken) and self.opens_blank[spoken[0]] else text

    def _text(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        shift = np.repeat(self.starts[ids] - (np.cumsum(lengths) - lengths), lengths)
        raw = self.flat[shift + np.arange(len(shift))].tobytes()
        try:
            raw.decode()
        except UnicodeDecodeError:
            return _mend(raw)
        return raw


def _clean(text: bytes) -> bytes:
    """Valid UTF-8 with the model's blanks as spaces and one of them put before."""
    if not text:
        return text
    try:
        text.decode()
    except UnicodeDecodeError:
        text = text.decode("utf-8", "replace").encode()
    return b" " + text.replace(BLANK.encode(), b" ")


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts that begin with a blank after a character that is none."""
    begin, at = 0, CHUNK_BYTES
    while True:
        at = text.find(b" ", at)
        if at < 0:
            yield text[begin:]
            return
        if text[at - 1] != 32:
            yield text[begin:at]
            begin, at = at, at + CHUNK_BYTES
        else:
            at += 1


def _mend(raw: bytes) -> bytes:
    """Each byte that is part of no character becomes a replacement character."""
    out = []
    while raw:
        try:
            raw.decode()
            out.append(raw)
            break
        except UnicodeDecodeError as error:
            out += [raw[: error.start], "�".encode()]
            raw = raw[error.start + 1 :]
    return b"".join(out)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """Read once in each worker."""
    return Pieces(path)


# ---------------------------------------------------------------- over frames

def encode(docs: DataFrame, path: str, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row with ``ids``: the ids (array of int) of its whole text, without begin and end ids.

    ``path`` names a model file that every worker can open. Null and empty texts have an empty
    array. Strings of control pieces are ordinary text; the model's own blank character counts as
    a space, as in the library. Equal texts get equal ids; repeated rows and null row ids stay as
    they are; other columns pass through (``ids`` is replaced). An empty table gives an empty
    table. One task holds one text and about a megabyte of others; a text is worked on in parts.
    """
    def work(column: pa.Array) -> list[pa.Array]:
        packed = list(pieces(path).encode(column))
        ends = np.cumsum([0, *map(len, packed)]) // 4
        values = pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32())
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)]

    return map_texts(docs, work, {"ids": T.ArrayType(T.IntegerType())}, text=text, keep=keep)


def decode(encoded: DataFrame, path: str, *, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Every row with ``decoded``: the text of its ``ids``.

    Null ids give an empty text; unknown ids show as the model's sign for them, control ids as
    nothing, and bytes that form no character as replacement characters. An id outside the
    vocabulary is an error. Other columns pass through (``decoded`` is replaced).
    """
    def work(column: pa.ListArray) -> list[pa.Array]:
        known = pieces(path)
        texts = [known.decode(np.array(x.values if x.is_valid else [], np.int64)) for x in column]
        return [pa.array([t.decode() for t in texts], pa.string())]

    return map_texts(encoded, work, {"decoded": T.StringType()}, text=ids, keep=keep)
