"""Rounding rules and seeded, reproducible stand-ins for random draws."""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, functions as F

MONEY_SUM = "decimal(24,2)"


def ratio(num: Column, den: Column, digits: int, num_type: str = MONEY_SUM) -> Column:
    """Exact ``num / den`` rounded half away from zero; NULL when ``den`` is 0."""
    den = F.nullif(den.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(num.cast(num_type) / den, digits)


def percent(num: Column, den: Column, digits: int) -> Column:
    return ratio(num.cast(MONEY_SUM) * F.lit(100), den, digits)


def money(value: Column) -> Column:
    return F.round(value, 2).cast(MONEY_SUM)


def half_even_int(value: Column) -> Column:
    """Float to integer the way SQL casts floats: halves go to the even neighbour."""
    return F.rint(value).cast("bigint")


def shuffle_key(seed: str, *keys: Column) -> Column:
    """Uniform hex digest of a seed and a key: replaces ``ORDER BY random()``."""
    return F.md5(key_text(seed, *keys))


def key_text(seed: str, *keys: Column) -> Column:
    """The text whose digest ``shuffle_key`` is."""
    return F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in keys])


def next_key(key: Column) -> Column:
    """What a further key adds to a ``key_text``: for joins, which put two ready parts together per pair."""
    return F.coalesce(F.concat(F.lit("|"), key.cast("string")), F.lit(""))


# 13 hex digits are 52 bits, which a double holds exactly.
_DRAW_DIGITS = 13


def draw(seed: str, *keys: Column) -> Column:
    """Uniform double in [0, 1), a pure function of seed and key."""
    digits = F.substring(shuffle_key(seed, *keys), 1, _DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(16**_DRAW_DIGITS))


def random_between(low, high, seed: str, *keys: Column, digits: int = 0) -> Column:
    """Seeded uniform value between two bounds: floored, or rounded to ``digits``."""
    low, high = _column(low).cast("double"), _column(high).cast("double")
    value = draw(seed, *keys) * (high - low) + low
    return F.floor(value) if digits == 0 else F.round(value, digits)


def digest_steps(low: int, high: int) -> list[str]:
    """The least digests whose draw between two whole bounds is floored to ``low + 1``, ``low + 2`` and so on.

    Digests have the order of their draws, so the floored draw is ``low`` and one for each of these reached:
    comparing texts takes the place of working out a number from every digest.
    """
    def floored(digits: int) -> int:
        return int(digits / float(16**_DRAW_DIGITS) * (float(high) - float(low)) + float(low))

    every = range(16**_DRAW_DIGITS)
    starts = [bisect_left(every, low + n, key=floored) for n in range(1, high - low + 1)]
    return [f"{v:0{_DRAW_DIGITS}x}" for v in starts if v < len(every)]


def steps_reached(digest: Column, steps: list[Column]) -> Column:
    """How many of the steps a digest reaches; NULL steps are not reached."""
    reached = F.lit(0)
    for step in steps:
        reached = reached + F.when(digest >= step, 1).otherwise(0)
    return reached


def sampled(pct: float, seed: str, *keys: Column) -> Column:
    """Bernoulli row filter keeping about ``pct`` percent."""
    return draw(seed, *keys) < F.lit(pct / 100.0)


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
