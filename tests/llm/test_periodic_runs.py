"""Periodic runs against a search of every period at every place."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given as forall, settings, strategies as st

from kiosklake.llm import periodic_runs, queries


def plain(words, repeats=4):
    runs = []
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            begin = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - begin + q
            shorter = any(all(words[k] == words[k + p] for k in range(begin, begin + length - p)) for p in range(1, q))
            if length >= max(6, repeats * q) and not shorter:
                runs.append((begin, length, q))
            i = max(i, begin + 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def by_every_lag(words, repeats=4):
    """The same, comparing all words with those q on at once."""
    ids = {}
    w = np.array([ids.setdefault(x, len(ids)) for x in words], np.int64)
    runs = []
    for q in range(1, len(w) // repeats + 1):
        apart = np.flatnonzero(np.concatenate(([True], w[:-q] != w[q:], [True])))
        for begin, end in zip(apart, apart[1:] - 1):
            length = int(end - begin) + q
            if end > begin and length >= max(6, repeats * q):
                run = w[begin : begin + length]
                if not any((run[:-p] == run[p:]).all() for p in range(1, q)):
                    runs.append((int(begin), length, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def found(texts, repeats=4):
    words, bounds = periodic_runs._numbered([t.encode() for t in texts])
    at, *runs = periodic_runs.find_runs(words, bounds, repeats)
    return [[tuple(int(x[k]) for x in runs) for k in np.flatnonzero(at == i)] for i in range(len(texts))]


pieces = st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=30), st.integers(1, 200))


@settings(max_examples=300, deadline=None)
@forall(st.lists(st.lists(pieces, max_size=4), min_size=1, max_size=4), st.integers(4, 6))
def test_all_runs_are_found(docs, repeats):
    texts = [[b[i % len(b)] for b, n in doc for i in range(min(n, 7 * len(b)))] for doc in docs]
    assert found([" ".join(t) for t in texts], repeats) == [plain(t, repeats) for t in texts]


@pytest.mark.parametrize("q", [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65, 100])
@pytest.mark.parametrize("rest", [0, 1])
def test_every_period_at_its_least_length(q, rest):
    around = [f"x{i}" for i in range(20)]
    block = [f"w{i}" for i in range(q)]
    inner = [block[i % q] for i in range(max(4 * q, 6) - rest)]
    words = around + inner + [f"y{i}" for i in range(20)]
    assert found([" ".join(words)])[0] == ([] if rest else [(20, max(4 * q, 6), q)])


def test_long_texts_in_parts(monkeypatch):
    words = [f"w{i * i % 977}" for i in range(3_000)] * 5 + ["z"] * 1_000
    text = "\n ".join(words)
    want = found([text])
    monkeypatch.setattr(periodic_runs, "CHUNK_BYTES", 50)
    assert found([text]) == want and want[0][-1] == (15_000, 1_000, 1)
    runs = [np.array(x) for x in zip(*want[0])]
    assert periodic_runs.collapse(text.encode(), *runs).decode() == plain_collapse(words, want[0])


def test_many_words_alike_stay_fast():
    fibonacci = ["a", "b"]
    while len(fibonacci[-1]) < 100_000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    assert found([" ".join(fibonacci[-1])]) == [[]]  # full of repeats, none of them fourfold
    assert found(["a " * 300_000]) == [[(0, 300_000, 1)]]


def test_too_few_repeats_are_refused():
    with pytest.raises(ValueError):
        found(["a a a"], repeats=3)


def test_edges(edge, empty):
    rows = periodic_runs.mark(edge).collect()
    assert len(rows) == edge.count()
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        if len(words) < 1000:
            runs = by_every_lag(words)
            assert [tuple(x) for x in r["runs"]] == runs and r["collapsed"] == plain_collapse(words, runs)
        assert r["score"] == "x"
    assert periodic_runs.mark(empty).count() == 0


def test_strongest(spark):
    frame = spark.createDataFrame([([(0, 9, 2), (3, 6, 1), (4, 12, 2), (5, 6, 1)],), ([],)], "runs array<struct<start:long,length:long,period:long>>")
    assert [r["b"] and tuple(r["b"]) for r in frame.select(periodic_runs.strongest(frame["runs"]).alias("b")).collect()] == [(3, 6, 1), None]


def test_query(spark, given):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op12_periodic_runs"](spark, given).collect()}
    want, changed = {}, 0
    for doc_id, text in spark.read.parquet(f"{given}/documents.parquet").select("doc_id", "text").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        runs = by_every_lag(words)
        assert n > 150 or runs == plain(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        digest = [hashlib.sha256(x.encode()).hexdigest()
                  for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), plain_collapse(words, runs))]
        want[doc_id] = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digest)
    assert changed > 3 and got == want
