"""The stages one by one over given documents, and the queries' names and columns."""

import collections
import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from kiosklake.llm import byte_bpe, near_dedup, quality_rules, queries
from kiosklake.llm.common import table

COLUMNS = {
    "op1_order_minhash": ["doc_id", "class_id", "class_size"],
    "op2_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op3_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_token_counts": ["doc_id", "n_tokens", "shard", "ordinal"],
    "op6_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op7_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op8_quality_ranking": ["doc_id", "held_out", "score", "predicted"],
    "op9_weighted_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
}


def test_registered():
    names = {f"op{n}_" for n in range(1, 11)}
    assert all(any(q.startswith(n) for q in entry.queries()) for n in names) and "pipeline" in entry.queries()
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, given, name):
    got = queries.QUERIES[name](spark, given)
    assert got.columns == COLUMNS[name]
    assert got.count() == table(spark, given, "documents").count()


def test_digests(spark, given):
    import hashlib

    import numpy as np
    import public_tokenizers
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.vocabulary(queries.RANKS).ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, given, "documents").collect()}
    counts = {r["doc_id"]: r["n_tokens"] for r in queries.QUERIES["op5_token_counts"](spark, given).collect()}
    for r in queries.QUERIES["op3_byte_bpe"](spark, given).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == counts[r["doc_id"]] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_stages(spark, given):
    docs = table(spark, given, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, given)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        before, docs = docs, spark.createDataFrame(after.collect(), after.schema)
        kept[name] = (before, docs)
    labels = {r["doc_id"]: r["quality"] for r in table(spark, given, "labels").collect()}
    before, after = kept["quality_classifier"]
    stay = {r["doc_id"] for r in after.collect()}
    judged = [(labels[r["doc_id"]], r["doc_id"] in stay) for r in before.collect() if r["doc_id"] in labels]
    assert sum(q == s for q, s in judged) >= 0.95 * len(judged)
    before, after = kept["quality_rules"]
    want = {r["doc_id"] for r in quality_rules.apply_rules(before).filter("quality.kept").collect()}
    assert {r["doc_id"] for r in after.collect()} == want
    before, after = kept["near_duplicates"]
    classes = collections.defaultdict(set)
    for r in near_dedup.classify(before).collect():
        classes[r["class_id"]].add(r["doc_id"])
    left = [r["doc_id"] for r in after.collect()]
    assert len(left) == len(classes) and all(len(ids & set(left)) == 1 for ids in classes.values())
    before, after = kept["source_mix"]
    assert {r["doc_id"] for r in after.collect()} == set(left)
    ids = corpus_pipeline.token_ids(spark, docs, given)
    assert ids.count() == docs.count() and ids.columns == ["doc_id", "source", "n_tokens", "ids", "ends"]


def test_stages_on_odd_rows(spark, edge, empty, given):
    for rows in (edge, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, given).columns in (rows.columns, [c for c in rows.columns if c != "_mix"])
        assert corpus_pipeline.token_ids(spark, rows, given).count() == rows.count()


def test_planted_copies_leave(spark, given):
    draw = random.Random(4)
    base = [f"w{draw.randrange(10**6)}" for _ in range(200)]
    near = list(base)
    near[50] = "changed"
    texts = [" ".join(base), " ".join(near), " ".join(base), "a clean text of its own " + " ".join(f"u{i}" for i in range(60))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], table(spark, given, "documents").schema)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, given).collect()) == [0, 3]
