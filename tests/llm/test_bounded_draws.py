"""Draws cut short by the bound without logarithms pick what full draws pick."""

from pyspark.sql import functions as F

from kiosklake.llm import fingerprints

BOTH = {"n": "picks", "m": "edited"}


def test_bounded_draws_are_full_draws_where_sure(spark):
    place, h = F.col("id") % 40, F.xxhash64("id")
    terms = spark.range(8000).select(
        place.alias("k"), h.alias("h"), (F.pmod(h, F.lit(5)) - 1).alias("n"), (F.pmod(h, F.lit(3))).alias("m"), F.lit(0.02).alias("most"),
    ).withColumns({"n": F.greatest("n", F.lit(0)), "m": F.greatest("m", F.lit(0))})
    full = {r["k"]: r for r in fingerprints.sample_terms(terms, ["k"], 64, BOTH).collect()}
    some = fingerprints.sample_terms(terms, ["k"], 64, BOTH, most="most").collect()
    assert len(some) == 40 and 0 < sum(r["sure"] for r in some) < 40
    assert all(r["picks"] == full[r["k"]]["picks"] and r["edited"] == full[r["k"]]["edited"] for r in some if r["sure"])


def test_texts_drawn_again_are_as_texts_drawn_once(edge, monkeypatch):
    def run(sure):
        monkeypatch.setattr(fingerprints, "SURE", sure)
        return sorted(map(str, fingerprints.edited_neighbours(edge).collect()))

    assert run(1e9) == run(0.5) == run(9.0)
