"""Language, toxicity and quality: held-out accuracy, and defined answers for odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kiosklake.llm import language_id, quality_rank, queries, toxicity
from kiosklake.llm.common import table

GIVEN = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, truth, predicted, least", [
    ("op2_language_id", "lang", "lang_pred", 0.98), ("op7_toxicity", "toxic", "predicted", 0.95),
    ("op8_quality_ranking", "quality", "predicted", 0.97),
])
def test_held_out_accuracy(spark, given, name, truth, predicted, least):
    got = queries.QUERIES[name](spark, GIVEN)
    known = table(spark, GIVEN, "documents" if truth == "lang" else "labels").select("doc_id", truth)
    rows = got.join(known, "doc_id").filter(f"held_out and {truth} is not null").select(truth, predicted, "score").collect()
    assert len(rows) > 50
    assert np.mean([r[truth] == r[predicted] for r in rows]) >= least
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert got.count() == table(spark, GIVEN, "documents").count()


def test_language_edges(edge, empty):
    model = language_id.train(edge, train_on=F.lit(True))
    rows = language_id.predict(edge, model).collect()
    assert len(rows) == edge.count()
    for r in rows:
        if not r["text"] or not any(map(str.isalpha, r["text"])):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in model.languages and 0 < r["score"] <= 1
    nothing = language_id.train(empty, train_on=F.lit(True))
    assert {r["lang_pred"] for r in language_id.predict(edge, nothing).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0


def test_language_pieces_agree_with_the_whole(monkeypatch):
    text = " ".join(random.Random(1).choice(["der", "Hund", "und", "Käse", "12", "ist"]) for _ in range(500))
    def counted():
        return np.bincount(np.concatenate([language_id._counted(p, o) for p, o in language_id._pieces(text)]), minlength=4)

    whole = counted()
    monkeypatch.setattr(language_id, "_PIECE", 37)
    assert (counted() == whole).all()


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 2)
    rows = spark.createDataFrame([(i, "text", f"l{i}") for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        language_id.train(rows, train_on=F.lit(True))


def test_folding():
    assert toxicity.fold("ID1OT! ídіоt 1d10t") == " idiot idiot idiot "  # the second with Cyrillic letters
    assert toxicity.fold(None) == toxicity.fold("!?") == "  " or toxicity.fold(None) == " " * len(toxicity.fold(None))
    assert toxicity.fold("id​iot") == " idiot "


def test_exception_phrases_spare_a_hit():
    lexicon = toxicity.Lexicon(((" trash ", 5.0), (" trash", 2.0), (" moro", 3.0)), (" trash can ",))
    auto = lexicon.automaton()
    plain = toxicity.hits(toxicity.fold("what trash, moroon"), auto)
    assert sorted(w for _, _, w in plain) == [3.0, 5.0]  # the heavier of two terms at one place
    assert toxicity.hits(toxicity.fold("a trash can"), auto) == []
    assert len(toxicity.hits(toxicity.fold("a trash can and trash"), auto)) == 1
    assert toxicity.hits(toxicity.fold(""), auto) == [] and toxicity.hits(" a ", toxicity.Lexicon(()).automaton()) == []


def test_length_lowers_the_dense_measure():
    auto = toxicity.Lexicon(((" trash ", 5.0),)).automaton()
    short, long = toxicity._weights(pa.array(["trash here", "trash " + "word " * 500]), auto)
    assert short[0] == long[0] and short[1] > long[1]


def test_toxicity_learns_and_edges(spark, edge, empty):
    draw = random.Random(2)
    words = [f"{a}{b}{c}" for a in "bcdf" for b in "aeio" for c in "lmnrst"]
    texts, labels = [], []
    for i in range(300):
        said = [draw.choice(words) for _ in range(30)]
        bad = i % 3 == 0
        if bad:
            said.insert(draw.randrange(30), draw.choice(["grumpelo", "zorrock"]))
        if not bad and i % 40 == 1:
            # now and then the same word in a phrase that harmless texts have
            said.insert(draw.randrange(30), "zorrock opera")
        texts.append((i, " ".join(said)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.train(docs, known, train_on=F.col("doc_id") % 4 != 0)
    assert any(t.startswith(" grum") for t, _ in lexicon.terms)
    rows = toxicity.score(docs, lexicon).join(known, "doc_id").filter("doc_id % 4 = 0").collect()
    assert np.mean([(r["score"] >= toxicity.ACCEPT) == bool(r["toxic"]) for r in rows]) > 0.9
    scored = toxicity.score(edge, lexicon).collect()
    assert len(scored) == edge.count() and all(0 <= r["score"] <= 1 for r in scored)
    none = toxicity.train(empty, known, train_on=F.lit(True))
    assert none.terms == () and toxicity.score(empty, none).count() == 0
    assert all(r["score"] < 0.5 for r in toxicity.score(edge, none).collect())


def test_ranking_recovers_an_order():
    draw = np.random.default_rng(1)
    rows = draw.normal(size=(400, 3))
    worth = rows @ np.array([2.0, -1.0, 0.0])
    labels = (worth > np.quantile(worth, 0.3)).astype(int)
    model = quality_rank.fit(rows, labels)
    scores = model.score(rows)
    assert np.mean((scores >= quality_rank.ACCEPT) == (labels == 1)) > 0.97
    assert np.mean(scores >= quality_rank.ACCEPT) == pytest.approx(labels.mean())  # the quantile sets the cut


def test_ranking_edges(edge, empty, spark):
    labels = spark.createDataFrame([(1, 1), (7, 0), (7, 1), (None, 1), (9, None), (8, 0)], "doc_id long, quality int")
    model = quality_rank.train(edge, labels, train_on=F.lit(True))
    rows = quality_rank.score(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["text"] in (None, "")}) == 1
    blank = quality_rank.train(edge, labels.filter("quality = 1"), train_on=F.lit(True))
    assert {round(r["score"], 9) for r in quality_rank.score(edge, blank).collect()} == {quality_rank.ACCEPT}
    assert quality_rank.train(empty, labels, train_on=F.lit(True)).weights == blank.weights
    assert quality_rank.score(empty, model).count() == 0
    kept = quality_rank.keep_good(edge, model)
    assert kept.columns == edge.columns


def toxic_rows(spark, make, n=1200):
    """Labelled rows of which every second is toxic; ``make`` adds words to 40 plain ones."""
    draw = random.Random(5)
    words = [f"{a}{b}{c}{d}" for a in "bcdf" for b in "aeio" for c in "lmnrst" for d in ("", "a", "o")]
    rows = []
    for i in range(n):
        said = [draw.choice(words) for _ in range(40)]
        make(i, i % 2, said, draw)
        rows.append((i, " ".join(said), i % 2))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "toxic")


def held_out(docs, labels, held):
    lexicon = toxicity.train(docs, labels, train_on=~held)
    rows = toxicity.score(docs, lexicon).join(labels, "doc_id").filter(held).select("score", "toxic").collect()
    hit = [r["score"] >= toxicity.ACCEPT for r in rows]
    right = sum(h and r["toxic"] == 1 for h, r in zip(hit, rows))
    return lexicon, right / max(1, sum(r["toxic"] for r in rows)), right / max(1, sum(hit))


def test_toxic_words_of_one_phrase_and_rare_ones(spark):
    def make(i, bad, said, draw):
        if bad and i % 10 == 1:
            said[9:9] = "you utter snorvik fool".split()  # always in the same words
        elif bad and i % 40 == 3:
            said.insert(draw.randrange(40), "quagbert")  # one toxic text in 20
        elif bad:
            said.insert(draw.randrange(40), draw.choice(["grumpelo", "zorrock"]))

    lexicon, recall, precision = held_out(*toxic_rows(spark, make), F.floor(F.col("doc_id") / 10) % 3 == 1)
    for word in ("snorvik", "quagbert"):
        assert any(f" {word} ".startswith(t) for t, _ in lexicon.terms), word
    assert recall > 0.95 and precision > 0.95


def test_support_does_not_grow_with_the_sample(spark):
    for size in (300, 4000):
        counts = spark.createDataFrame([("rare", 1, 0, 20, 0), ("copied", 1, 0, 1, 0), ("plain", 9, 9, 20, 20)],
                                       "term string, t long, c long, toxic_texts long, harmless_texts long")
        assert [r["term"] for r in toxicity._odds(counts, size, size).filter("good").collect()] == ["rare"]


def test_copies_count_once():
    base = [f"w{i}" for i in range(200)]
    near = [" ".join(base[:k] + ["new"] + base[k + 1 :]) for k in range(0, 200, 9)]
    other = [" ".join(f"v{j}x{i}" for i in range(50)) for j in range(5)]
    sketches = toxicity._sketch(pa.array([" ".join(base), *near, *other, None]))
    groups = toxicity._copies(sketches)
    assert len({groups.get(s[0], s[0]) for s in sketches}) == 1 + 5 + 1


def test_harmless_phrase_of_an_ambiguous_word(spark):
    draw = random.Random(2)
    words = [f"{a}{b}{c}" for a in "bcdf" for b in "aeio" for c in "lmnrst"]
    texts = []
    for i in range(300):
        said = [draw.choice(words) for _ in range(30)]
        bad = i % 3 == 0
        if bad:
            said.insert(draw.randrange(30), draw.choice(["grumpelo", "zorrock"]))
        if i % 5 == 1:
            # the same word in a phrase that harmless texts have, and toxic ones too
            said.insert(draw.randrange(30), "zorrock opera")
        texts.append((i, " ".join(said), int(bad)))
    docs = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    lexicon, recall, precision = held_out(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), F.col("doc_id") % 4 == 0)
    assert " zorrock opera " in lexicon.exceptions
    assert recall > 0.9 and precision > 0.9


def test_ranking_learns_from_all_labelled_rows(spark):
    n = 24_000
    row = F.col("id")
    word = F.substring(F.md5(F.concat_ws("-", row, F.lit("w"))), 1, (row % 23 + 3).cast("int"))
    text = F.concat_ws(" ", word, F.md5(row.cast("string")), F.repeat(F.lit("so it goes "), (row % 17).cast("int")), F.reverse(word))
    rows = spark.range(n).select(row.alias("doc_id"), text.alias("text"), (F.xxhash64("id") % 3 == 0).cast("int").alias("quality"))
    docs, labels = rows.select("doc_id", "text"), rows.select("doc_id", "quality")
    model = quality_rank.train(docs, labels, train_on=F.lit(True))
    good = labels.filter("quality = 1").count()
    # the cut is a quantile of all training scores, so it leaves as many as have the label, but for ties
    accepted = quality_rank.score(docs, model).agg(
        F.count_if(F.col("score") > quality_rank.ACCEPT + 1e-9).alias("over"), F.count_if(F.col("score") >= quality_rank.ACCEPT - 1e-9).alias("at")
    ).first()
    assert accepted["over"] <= good <= accepted["at"] and accepted["at"] - accepted["over"] < 20


def test_every_row_is_in_pairs(spark):
    rows = spark.createDataFrame([(int(i % 5 == 0), [float(i), 0.0]) for i in range(50)], "y int, features array<double>")
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    gaps = quality_rank._pairs(rows, {0: 40, 1: 10}).collect()
    assert len(gaps) == 40 * quality_rank.ROUNDS
    assert len({r["gap"][0] for r in gaps}) > 40
