"""Encoding against the public library, decoding as an exact round trip, counts against lengths."""

import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given as forall, settings, strategies as st

from kiosklake.llm import byte_bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.vocabulary(PATH).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(texts):
    return [np.frombuffer(x, "<u4").tolist() for x in byte_bpe._packed(pa.array(texts), byte_bpe.vocabulary(PATH))]


PARTS = ["'", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", "\t", "a", "é", "ß", "1", "٣", "²", "!", "#", " ",
         "　", "漢", "😀", "\r", "'S", "́", "<|endoftext|>", "\x00", "\x85", "​"]


@settings(max_examples=300, deadline=None)
@forall(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), min_size=1, max_size=6))
def test_like_the_library(library, texts):
    assert ids_of(texts) == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=100, deadline=None)
@forall(st.text(st.characters(codec="utf-8", max_codepoint=0x2FFF), max_size=60))
def test_any_text_round_trips(text):
    words = byte_bpe.vocabulary(PATH)
    ids = np.array(ids_of([text])[0], np.int64)
    assert words.decode(ids, np.cumsum(words.lengths[ids])) == text.encode()


def test_long_pieces(library):
    texts = ["a" * 5000, "xyz" * 700, " " * 3000, "'" * 301, "!" * 999 + "'s", "é" * 999, ""]
    assert ids_of(texts) == [library.encode_ordinary(t) for t in texts]


def test_edges(edge, empty, library):
    coded = byte_bpe.encode(edge, PATH)
    rows = byte_bpe.decode(coded, PATH).collect()
    assert len(rows) == edge.count()
    for r in rows:
        text = r["text"] or ""
        assert [x for (x,) in struct.iter_unpack("<I", r["ids"])] == library.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode() and r["score"] == "x"
    assert byte_bpe.decode(byte_bpe.encode(empty, PATH), PATH).count() == 0


@pytest.mark.parametrize("block, group", [(7, 3), (64, 1024), (1 << 18, 1024)])
def test_counts_across_blocks(edge, monkeypatch, block, group):
    monkeypatch.setattr(token_counts, "GROUP", group)
    coded = byte_bpe.encode(edge.filter("doc_id is null or doc_id <> 7"), PATH)
    shards = token_counts.write_shards(coded, end=50256, block=block)
    counts = token_counts.count_tokens(shards.blocks, end=50256)
    got = sorted(((r["doc_id"], r["n_tokens"]) for r in token_counts.with_ids(counts, shards.roster).collect()), key=str)
    want = sorted(((r["doc_id"], len(r["ids"]) // 4) for r in coded.collect()), key=str)
    assert got == want and counts.filter("not ended").count() == 0


def test_counts_without_end_and_empty(spark, tmp_path):
    def count(*blocks):
        rows = [("f", i, np.array(b, "<u2").tobytes()) for i, b in enumerate(blocks)]
        got = token_counts.count_tokens(spark.createDataFrame(rows, "shard string, block long, data binary"), end=9)
        return [(r["n_tokens"], r["ended"]) for r in got.orderBy("ordinal").collect()]

    assert count([1, 2], [3, 9, 9, 4], [], [5, 6]) == [(3, True), (0, True), (3, False)]
    assert count([1, 2]) == [(2, False)]
    assert count([1, 9]) == [(1, True)]
    assert count([]) == []
    none = token_counts.count_tokens(spark.createDataFrame([], "shard long, block long, data binary"), end=9)
    assert none.count() == 0
    # raw files, read in blocks
    (tmp_path / "a.bin").write_bytes(np.array([1, 1, 1, 9, 2, 2, 9, 9], "<u2").tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    read = token_counts.read_token_files(spark, str(tmp_path), block=3)
    got = token_counts.count_tokens(read, end=9).orderBy("ordinal").collect()
    assert [r["n_tokens"] for r in got] == [3, 2, 0]


def test_too_wide_ids_fail(spark):
    coded = spark.createDataFrame([(1, struct.pack("<I", 70_000))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="does not fit"):
        token_counts.write_shards(coded, end=5)


def test_null_ids_decode_to_nothing(spark):
    row = byte_bpe.decode(spark.createDataFrame([(1, None, None)], "doc_id long, ids binary, ends binary"), PATH).first()
    assert bytes(row["decoded"]) == b""
