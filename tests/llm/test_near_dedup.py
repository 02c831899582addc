"""Order MinHash against every pair of a small table, and the alignment against plain programming."""

import random
import re

import numpy as np
import pytest
from hypothesis import given as forall, settings, strategies as st

from kiosklake.llm import near_dedup as nd
from kiosklake.llm.components import components


def plain_lcs(a, b, band):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            met = best[i][j] + 1 if x == y and abs(i - j) <= band else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], met)
    return best[-1][-1]


@settings(max_examples=300, deadline=None)
@forall(st.lists(st.integers(0, 4), max_size=20), st.lists(st.integers(0, 4), max_size=20), st.integers(0, 25))
def test_band(a, b, band):
    assert nd.common_in_band(a, b, band) == plain_lcs(a, b, band)


def plain_classes(texts):
    """Least row number of each text's component under the similarity of aligned shingles."""
    shingles = []
    for text in texts:
        words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
        shingles.append([tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else [])
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(shingles):
        for j, b in enumerate(shingles[:i]):
            if a and b:
                common = plain_lcs(a, b, len(a) + len(b))
                if common / (len(a) + len(b) - common) >= 0.8:
                    low, high = sorted((find(i), find(j)))
                    root[high] = low
    return [find(i) for i in range(len(texts))]


def family(draw, words, copies, edits):
    """A text and copies of it with some words changed."""
    base = [draw.choice(words) for _ in range(draw.choice([6, 12, 25, 33, 60, 120]))]
    out = [base]
    for _ in range(copies):
        copy = list(draw.choice(out))
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(len(copy))] = draw.choice(words)
        out.append(copy)
    return [" ".join(x) for x in out]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_against_all_pairs(spark, seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(draw.choice(words) for _ in range(60))
    texts = [t for _ in range(14) for t in family(draw, words, draw.randint(0, 5), draw.randint(0, 3))]
    # texts that share a passage of over 50 words, and are else unlike
    texts += [passage + " " + " ".join(draw.choice(words) for _ in range(90)) for _ in range(12)]
    want = plain_classes(texts)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in nd.classify(rows).collect()}
    assert [got[i] for i in range(len(texts))] == want
    kept = sorted(r["doc_id"] for r in nd.keep_one(rows).collect())
    assert kept == sorted(set(want))


def test_parities_bound_the_difference():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 900).astype(np.uint64)
    for changed in (0, 1, 40, 300):
        other = base.copy()
        other[:changed] = draw.integers(0, 2**63, changed).astype(np.uint64)
        both = nd._parities(np.concatenate([base, other]), np.array([0, 900, 1800])).view(np.uint64)
        apart = sum(int(x).bit_count() for x in both[0] ^ both[1])
        assert apart <= 2 * changed and apart >= 1.5 * changed * (changed < 100)


def test_order_counts():
    """The same shingles in another order are no near copy."""
    draw = random.Random(5)
    blocks = [" ".join(f"b{k}w{draw.randrange(10**6)}" for _ in range(12)) for k in range(8)]
    one, other = " ".join(blocks), " ".join(reversed(blocks))
    data = [nd.pa.array([x]) for x in (one, other)]
    low, high = nd._compare(nd.pa.StructArray.from_arrays(data, ["a", "b"]))
    assert low[0].as_py() > 0.2


def test_edges(edge, empty):
    rows = sorted(nd.classify(edge).collect(), key=str)
    assert len(rows) == edge.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert {r["class_id"] for i in (1, 2) for r in by_id[i]} == {1}
    assert {r["class_size"] for r in by_id[1]} == {3}
    for i in (3, 4, 5, 8):  # no word: a class of its own
        assert [(r["class_id"], r["class_size"]) for r in by_id[i]] == [(i, 1)]
    assert {r["class_id"] for r in by_id[None]} == {None}
    kept = nd.keep_one(edge)
    assert kept.columns == edge.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(["1", "3", "4", "5", "None", "None", "7", "8", "9", "10", "10"])
    assert nd.classify(empty).count() == 0 and nd.keep_one(empty).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_large_group_of_copies_makes_few_pairs(spark):
    """A large group of near copies is tied to pivots, not expanded into its pairs."""
    draw = random.Random(9)
    base = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    texts = []
    for _ in range(300):
        copy = list(base)
        copy[draw.randrange(150)] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(copy))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r["class_id"] for r in nd.classify(rows).collect()} == {0}
