import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kiosklake.functions import geo, numbers, periods, text
from kiosklake.plans import earlier, stock
from tests.conftest import dt, frame


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_overlap_is_half_open(tables):
    def ids(lo, hi):
        start, end = F.col("period_start"), F.col("period_end")
        return {r.rental_id for r in tables.rental.filter(periods.overlaps(start, end, lo, hi)).collect()}

    # rental 2 is [06-02 10:00, 06-03 10:00)
    assert 2 not in ids("2025-06-03 10:00:00", "2025-06-04 00:00:00")
    assert 3 in ids("2025-06-03 10:00:00", "2025-06-04 00:00:00")
    assert 2 not in ids("2025-06-02 00:00:00", "2025-06-02 10:00:00")
    assert {5, 6, 7, 8} <= ids("2025-06-14 12:00:00", "2025-06-15 00:00:00")
    assert ids("2025-06-02 12:00:00", "2025-06-02 12:00:00") == set()


def test_contains_start_but_not_end(spark):
    at = lambda t: periods.contains(periods.moment("2025-01-01"), periods.moment("2025-01-02"), t)
    assert one(spark, a=at("2025-01-01"), b=at("2025-01-02")) == {"a": True, "b": False}


def test_rental_days(spark):
    start = periods.moment("2025-01-01 00:00:00")
    days = lambda end: periods.rental_days(start, periods.moment(end))
    got = one(spark, a=days("2025-01-01 00:00:01"), b=days("2025-01-02 00:00:00"), c=days("2025-01-02 00:00:01"),
              d=days("2025-01-02 00:00:00.000001"))
    assert got == {"a": 1, "b": 1, "c": 2, "d": 2}


def test_empty_period_is_rejected(spark):
    _, end = periods.make_period(periods.moment("2025-01-01"), periods.moment("2025-01-01"))
    with pytest.raises(PySparkException):
        spark.range(1).select(end).collect()


def test_calendar_parts(spark):
    sunday = periods.moment("2025-06-01 23:00:00")
    got = one(spark, n=periods.dow_number(sunday), name=periods.dow_name(sunday), m=periods.month_text(sunday),
              start=periods.month_start(sunday), last=periods.last_day(periods.moment("2024-02-10")))
    assert (got["n"], got["name"], got["m"]) == (0, "Sunday   ", "2025-06")
    assert got["start"] == dt("2025-06-01 00:00:00")
    assert str(got["last"]) == "2024-02-29"


def test_ratio_rounds_half_away_and_guards_zero(spark):
    r = lambda a, b, k: numbers.ratio(F.lit(a), F.lit(b), k)
    got = one(spark, a=r(5, 2, 0), b=r(-5, 2, 0), c=r(1, 3, 2), z=r(1, 0, 2))
    assert (float(got["a"]), float(got["b"]), float(got["c"]), got["z"]) == (3.0, -3.0, 0.33, None)
    assert one(spark, x=numbers.half_even_int(F.lit(2.5)), y=numbers.half_even_int(F.lit(3.5))) == {"x": 2, "y": 4}


def test_steps_reached_is_the_floored_draw(spark):
    rows = spark.range(3000).select("id", numbers.shuffle_key("s", F.col("id"), F.lit(None)).alias("digest"))
    assert rows.filter(F.col("digest") != F.md5(F.concat(numbers.key_text("s", F.col("id")), numbers.next_key(F.lit(None))))).count() == 0
    wrong = []
    for low, high in {*earlier.BOUNDS, *[(low, low + n) for _, low, n in stock.TIERS.values()], (0, 100)}:
        steps = numbers.digest_steps(low, high)
        drawn = low + numbers.steps_reached(F.col("digest"), [F.lit(x) for x in steps])
        wrong.append(F.count_if(drawn != numbers.random_between(low, high, "s", F.col("id"))))
        for step in steps:  # a step is the least digest of its number
            least = int(step, 16)
            at = [int(v / float(16**13) * (float(high) - float(low)) + float(low)) for v in (least - 1, least)]
            assert at[0] + 1 == at[1] == low + steps.index(step) + 1
    assert set(rows.agg(*[w.alias(f"w{i}") for i, w in enumerate(wrong)]).first()) == {0}


def test_draws_are_uniform_and_repeatable(spark):
    rows = spark.range(4000).select(numbers.draw("s", F.col("id")).alias("u"))
    first, again = [r.u for r in rows.collect()], [r.u for r in rows.collect()]
    assert first == again and 0 <= min(first) and max(first) < 1
    assert abs(sum(first) / len(first) - 0.5) < 0.03
    values = spark.range(500).select(numbers.random_between(3, 6, "s", F.col("id")).alias("v")).distinct().collect()
    assert {r.v for r in values} == {3, 4, 5}


def test_distance_known_pair_and_zero(spark):
    l = F.lit
    # Flinders Peak to Buninyong
    far = geo.distance_m(l(-37.95103341666667), l(144.42486788888888), l(-37.65282113888889), l(143.92649552777777))
    got = one(spark, far=far, zero=geo.distance_m(l(1.0), l(2.0), l(1.0), l(2.0)),
              wrap=geo.distance_m(l(0.0), l(179.9), l(0.0), l(-179.9)),
              null=geo.distance_m(l(None).cast("double"), l(2.0), l(1.0), l(2.0)))
    assert abs(got["far"] - 54972.271) < 1.0
    assert got["zero"] == 0.0 and got["null"] is None
    assert abs(got["wrap"] - 0.2 * math.pi * 6378137 / 180) < 1.0


def test_group_concat_and_join_sorted(spark):
    rows = spark.createDataFrame([(1, 2, "b"), (1, 1, "c"), (1, 3, None), (2, 1, None)], "k int, o int, v string")
    got = {r.k: (r.a, r.b) for r in rows.groupBy("k").agg(
        text.group_concat(F.col("v"), F.col("o")).alias("a"), text.join_sorted(F.col("v")).alias("b")).collect()}
    assert got == {1: ("c, b", "b, c"), 2: (None, None)}
