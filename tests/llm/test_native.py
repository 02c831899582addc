"""Quality rules, perspectives, fingerprints and mixing against plain Python."""

import collections
import hashlib
import math
import re

import pytest
from crosscheck import compare
from pyspark.sql import functions as F

from kiosklake.llm import chat, fingerprints, mixing, quality_rules, queries

PYTHON_NODES = re.compile("Python|Pandas|Arrow")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, given, name):
    assert compare.difference(queries.QUERIES[name](spark, given), compare.duck(given), queries.ORACLE[name]) is None


def plain_rules(text):
    text = text or ""
    w = words(text)
    windows = collections.defaultdict(list)
    for i in range(len(w) - 7):
        windows[tuple(w[i : i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_rules_against_plain_python(spark, edge, empty):
    odd = ["a b c d e f g h " * 3, "one two three four five six seven eight nine\n" * 4 + " x", "a\nb\na\n\n\n \n", "w " * 500, "😀 é # <|>", "\x0b\x0c\r"]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    for frame in (edge, extra):
        rows = quality_rules.apply_rules(frame).collect()
        assert len(rows) == frame.count()
        for r in rows:
            q = r["quality"]
            assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"], q["base_failed"]) == plain_rules(r["text"])
            assert q["kept"] == (not q["base_failed"] and not q["failed"])
    assert quality_rules.apply_rules(empty).count() == 0
    kept = quality_rules.keep_good(edge)
    assert kept.columns == edge.columns and {r["doc_id"] for r in kept.collect()} >= {1, 2}


def test_rule_table_is_a_parameter(edge):
    none = (quality_rules.Rule("never", "n_words", high=0),)
    assert {tuple(r["quality"]["failed"]) for r in quality_rules.apply_rules(edge, none).filter("length(text) > 99").collect()} == {("never",)}


def test_native_plans(edge):
    frames = [quality_rules.apply_rules(edge), fingerprints.fingerprint(edge, ["doc_id"]), mixing.mix(edge),
              fingerprints.edited_neighbours(edge)]
    for frame in frames:
        assert not PYTHON_NODES.search(frame._jdf.queryExecution().executedPlan().toString())


def test_perspectives(spark):
    turns = [(1, 0, "system", "Be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello"), (1, 3, "ann", None), (1, 4, None, "who?"),
             (1, None, "bob", "late"), (2, 0, "system", "alone"), (None, 0, "cy", "x"), (None, 1, "cy", "x"), (3, 600, "ann", "far")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("speaker", F.lit("clash"))
    rows = chat.rotate(frame.unionByName(frame.filter("conv_id = 3"))).collect()
    seen = collections.defaultdict(dict)
    for r in rows:
        seen[r["conv_id"], r["speaker"]][r["part"]] = r
    assert set(seen) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "cy"), (3, "ann")}
    ann = seen[1, "ann"][0]
    assert ann["rendered"] == (
        "<|im_start|>system\nBe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\nhello<|im_end|>\n"
        "<|im_start|>assistant\n<|im_end|>\n<|im_start|>user name=unknown\nwho?<|im_end|>\n"
    )
    assert [ann["rendered"][s["start"] : s["end"]] for s in ann["spans"]] == ["hi<|im_end|>", "<|im_end|>"]
    assert seen[1, "ann"][None]["spans"] == [] and len(seen[1, "bob"][None]["spans"]) == 1
    assert seen[3, "ann"][1]["n_turns"] == 2  # a repeated row is there twice
    assert chat.rotate(frame.limit(0)).count() == 0


def test_long_dialogue_comes_in_parts(spark):
    turns = spark.range(1300).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("role"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    rows = chat.rotate(turns).filter("speaker = 'a'").orderBy("part").collect()
    assert [r["n_turns"] for r in rows] == [512, 512, 276]
    spoken = [r["rendered"][s["start"] : s["end"]] for r in rows for s in r["spans"]]
    assert spoken == [f"t{i}<|im_end|>" for i in range(0, 1300, 2)]


def jaccard(one, other):
    a, b = collections.Counter(words(one)), collections.Counter(words(other))
    either = set(a) | set(b)
    return sum(min(a[w], b[w]) for w in either) / max(1, sum(max(a[w], b[w]) for w in either)) if either else 1.0


def test_fingerprints_estimate_generalised_jaccard(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base * 2 + [f"x{k}_{i}" for i in range(20 * k)]) for k in range(6)] + [" ".join(base), " ".join(base * 5)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    picks = {r["doc_id"]: r["picks"] for r in fingerprints.fingerprint(frame, ["doc_id"], samples=400).collect()}
    for i in range(len(texts)):
        for j in range(i):
            got = sum(a == b for a, b in zip(picks[i], picks[j])) / 400
            assert abs(got - jaccard(texts[i], texts[j])) < 0.11, (i, j)


def test_production_likeness_against_exact_jaccard(spark):
    shares = [0.2, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
    texts, exact = [], []
    for k in range(280):
        same = round(300 * shares[k % 7])
        common, rest = [f"c{k}_{i}" for i in range(same)], (300 - same) // 2
        pair = [" ".join([*common, *(f"{side}{k}_{i}" for i in range(rest))]) for side in "ab"]
        texts += pair
        exact.append(jaccard(*pair))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    picks = {r["doc_id"]: r["picks"] for r in fingerprints.fingerprint(frame, ["doc_id"]).collect()}
    got = [sum(x == y for x, y in zip(picks[2 * k], picks[2 * k + 1])) / len(picks[2 * k]) for k in range(280)]
    errors = [g - e for g, e in zip(got, exact)]
    assert math.sqrt(sum(x * x for x in errors) / 280) < 0.065  # about 0.054 expected of 64 samples, 0.076 of 32
    assert abs(sum(errors) / 280) < 0.015
    assert max(map(abs, errors)) < 0.25


def test_a_row_without_weight_bears_what_a_group_has_one_value_of(spark):
    rows = [(1, h, n, m, None) for h, n, m in ((7, 1, 1), (8, 2, 1), (9, 0, 3), (10, 4, 0))] + [(1, None, 0, 0, "one"), (2, None, 0, 0, "two")]
    terms = spark.createDataFrame(rows, "k int, h long, n long, m long, title string")
    both = {r["k"]: r for r in fingerprints.sample_terms(terms, ["k"], 20, {"n": "picks", "m": "edited"}, ("title",)).collect()}
    assert {k: r["title"] for k, r in both.items()} == {1: "one", 2: "two"}
    for weight, name in (("n", "picks"), ("m", "edited")):
        alone = fingerprints.sample_terms(terms.filter(F.col(weight) > 0), ["k"], 20, {weight: "picks"}).collect()
        assert both[1][name] == alone[0]["picks"] and len(both[1][name]) == 20 and both[2][name] == [0] * 20


def test_neighbours(spark, edge, empty):
    frame = edge.select("doc_id", "text", "score")
    for got, rows in ((fingerprints.edited_neighbours(frame).collect(), frame.collect()),):
        assert len(got) == len(rows)
    single = frame.filter("doc_id in (1, 3, 4, 5, 7, 8, 9)")
    got = {r["doc_id"]: r for r in fingerprints.edited_neighbours(single).collect()}
    ids = sorted(got, reverse=True)
    texts = {r["doc_id"]: r["text"] or "" for r in single.collect()}
    for i, after in zip(ids, ids[1:] + ids[:1]):
        text, other, half = texts[i], texts[after], len(texts[i]) // 2
        edited = text[: len(text) - half] + other[:half]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(got[i]["near_next"] - jaccard(text, other)) < 0.3
        assert abs(got[i]["near_edited"] - jaccard(text, edited)) < 0.3
        assert len(got[i]["fingerprint"]) == 8 * fingerprints.SAMPLES
        assert (got[i]["near_next"] == 1.0) >= (got[i]["fingerprint"] == got[after]["fingerprint"])
    assert fingerprints.edited_neighbours(empty).count() == 0
    alone = fingerprints.edited_neighbours(single.filter("doc_id = 1")).collect()
    assert [r["near_next"] for r in alone] == [1.0]


def source_rows(spark, sizes, words_each=10):
    rows = [(k * 100_000 + i, " ".join(f"w{j}" for j in range(words_each)), f"s{k}") for k, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixture_meets_entropy_and_budget(spark):
    docs = source_rows(spark, [600, 200, 100, 100])
    budget = 4000.0
    rows = mixing.mix(docs, entropy_share=0.97, max_repeats=100, budget=budget, block_tokens=100).select("doc_id", "source", "_mix.*").collect()
    weights = {r["source"]: r["weight"] for r in rows}
    assert sum(weights.values()) == pytest.approx(1)
    assert -sum(w * math.log(w) for w in weights.values()) == pytest.approx(0.97 * math.log(4), abs=1e-5)
    shares = {"s0": 0.6, "s1": 0.2, "s2": 0.1, "s3": 0.1}
    exponent = math.log(weights["s0"] / weights["s1"]) / math.log(3)
    assert all(w == pytest.approx(shares[s] ** exponent / sum(v**exponent for v in shares.values())) for s, w in weights.items())
    for s, w in weights.items():
        drawn = sum(r["n_tokens"] for r in rows if r["source"] == s)
        assert w * budget - 10 - 1e-6 <= drawn <= w * budget + 1e-6
    # the last epoch is the first part of the permutation: whole blocks, then part of one
    part = [r for r in rows if r["source"] == "s0"]
    by_block = collections.Counter(r["block"] for r in part)
    every = collections.Counter(r["block"] for r in mixing.mix(docs, budget=None, block_tokens=100).select("source", "_mix.*").filter("source = 's0' and epoch = 1").collect())
    last = max(by_block)
    assert all(by_block[b] == every[b] for b in every if b < last)
    assert {r["turn"] for r in part if r["block"] == last} & {r["turn"] for r in part if r["block"] != last} == set()


def test_repetition_limit_and_whole_sources(spark):
    docs = source_rows(spark, [1000, 100, 10])
    rows = mixing.mix(docs, entropy_share=1.0, max_repeats=3.0).select("doc_id", "source", "_mix.*").collect()
    seen = collections.Counter(r["doc_id"] for r in rows)
    assert len(seen) == 1110  # by default no document is left out
    assert max(seen.values()) <= 3
    assert sum(r["source"] == "s2" for r in rows) == pytest.approx(30, abs=1)
    even = mixing.mix(docs, entropy_share=0.1).count()
    assert even == 1110  # the natural shares do already


def test_mixture_edges(edge, empty):
    rows = mixing.mix(edge).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in edge.collect()}
    assert mixing.mix(edge).drop("_mix").columns == [c for c in edge.columns if c != "_mix"]
    assert all(r["_mix"]["epoch"] >= 1 for r in rows)
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(edge.filter("text is null")).count() == 2  # no token at all: kept once
