"""Encoding and decoding against the public library, merge rounds against merging one pair at a time."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given as forall, settings, strategies as st

from kiosklake.llm import queries, sentence_piece

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(texts):
    return [np.frombuffer(x, "<i4").tolist() for x in sentence_piece.pieces(PATH).encode(pa.array(texts, pa.string()))]


PARTS = [" ", "  ", " " * 17, "▁", "\n", "\t", "a", "b", "in", "the", "er", "ing", "é", "ß", "1", "٣", "!", "==", "//", "漢", "字",
         "😀", "\x00", "<s>", "<unk>", "<0x0A>", "​", "x" * 9, "http"]


@settings(max_examples=300, deadline=None)
@forall(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), min_size=1, max_size=6))
def test_like_the_library(library, texts):
    assert ids_of(texts) == library.encode(texts, num_threads=1)


@settings(max_examples=150, deadline=None)
@forall(st.text(st.characters(codec="utf-8"), max_size=60))
def test_any_text(library, text):
    ids = ids_of([text])[0]
    assert ids == library.encode(text)
    assert sentence_piece.pieces(PATH).decode(np.array(ids, np.int64)).decode() == library.decode(ids)


@settings(max_examples=200, deadline=None)
@forall(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 258), st.sampled_from([0, 1, 2, 259, 260])), max_size=12))
def test_any_ids_decode_like_the_library(library, ids):
    assert sentence_piece.pieces(PATH).decode(np.array(ids, np.int64)).decode() == library.decode(ids)


def one_by_one(known, text):
    """Merges the best pair, the leftmost of equals, until none is left."""
    symbols = known.symbol_of[np.array([ord(c) for c in text])].tolist()
    while len(symbols) > 1:
        rank, piece = known._pairs(np.array(symbols[:-1]), np.array(symbols[1:]))
        at = int(np.argmin(rank))
        if rank[at] == sentence_piece._NONE:
            break
        symbols[at : at + 2] = [int(piece[at])]
    return symbols


@settings(max_examples=150, deadline=None)
@forall(st.lists(st.text(st.sampled_from("abinther=x▁0"), min_size=1, max_size=30), min_size=1, max_size=5))
def test_rounds_are_like_single_merges(words):
    known = sentence_piece.pieces(PATH)
    flat = np.concatenate([known.symbol_of[np.array([ord(c) for c in w])] for w in words])
    symbols, word = known._rounds(flat, np.repeat(np.arange(len(words)), [len(w) for w in words]))
    assert [symbols[word == i].tolist() for i in range(len(words))] == [one_by_one(known, w) for w in words]


def test_long_texts(library, monkeypatch):
    texts = ["x" * 50_000, " " * 40_000, "a" + " " * 5_000 + "字", "=" * 3_001, "\n" * 999, "abcd" * 3_000, "", "漢" * 2_000,
             "word " * 5_000 + "  end"]
    assert ids_of(texts) == library.encode(texts, num_threads=1)
    monkeypatch.setattr(sentence_piece, "CHUNK_BYTES", 100)  # cut between words
    assert ids_of(texts) == library.encode(texts, num_threads=1)


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(sentence_piece, "CACHE", 3)
    texts = [f"some words {i} and {i * i}" for i in range(300)]
    assert [ids_of([t])[0] for t in texts] == library.encode(texts)


def test_edges(edge, empty, library):
    rows = sentence_piece.decode(sentence_piece.encode(edge, PATH), PATH).collect()
    assert len(rows) == edge.count()
    for r in rows:
        assert r["ids"] == library.encode(r["text"] or "") and r["decoded"] == library.decode(r["ids"]) and r["score"] == "x"
    assert sentence_piece.decode(sentence_piece.encode(empty, PATH), PATH).count() == 0


def test_bytes_that_are_no_text(spark, library):
    frame = spark.sql("SELECT 1 AS doc_id, cast(x'61ff2062' AS string) AS text")
    assert sentence_piece.encode(frame, PATH).first()["ids"] == library.encode("a� b")


def test_null_ids_decode_to_nothing(spark):
    assert sentence_piece.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first()["decoded"] == ""


def test_query(spark, given, library):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.QUERIES["op13_sentence_piece"](spark, given).collect()}
    want = {}
    for r in spark.read.parquet(f"{given}/documents.parquet").collect():
        ids = library.encode(r["text"] or "")
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want[r["doc_id"]] = (len(ids), *digest)
    assert got == want
