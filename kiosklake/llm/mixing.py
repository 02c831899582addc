"""Mixing sources by temperature: weights from token shares, realised as block permutations."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from kiosklake.llm.common import prepare, unit_hash, words
from kiosklake.session import materialize

#: Production parameters: entropy to reach as a share of the highest, how often a text may
#: be seen at most, tokens in a block, blocks in a group of the prefix sum.
ENTROPY_SHARE, MAX_REPEATS, BLOCK_TOKENS, GROUP = 0.95, 4.0, 1 << 20, 512


@dataclass(frozen=True)
class Temperature:
    """The exponent found, the sum of the raised shares, and the token budget."""

    exponent: float
    norm: float
    budget: float


def _shares(sources: DataFrame) -> tuple[DataFrame, dict]:
    total = sources.agg(
        F.sum("tokens").alias("total"), F.count(F.when(F.col("tokens") > 0, 1)).alias("n")
    ).first().asDict()
    if not total["n"]:
        return sources.withColumn("p", F.lit(0.0)), total
    shares = sources.withColumn("p", F.col("tokens") / F.lit(float(total["total"])))
    ends = shares.filter("p > 0").agg(F.min("p").alias("low"), F.max("p").alias("high")).first()
    return shares, total | ends.asDict()


def _bisect(shares: DataFrame, meets, *, rising: bool, halvings: int = 32) -> float:
    """The exponent in [0, 1] at which ``meets`` changes, by bisection.

    ``meets(exponent, s0, s1)`` is judged from sums over the sources of p**x and p**x * ln p.
    Four halvings share one pass: the 15 inner points of the interval are summed at once.
    ``rising``: it holds for high exponents; the lowest that holds is returned, else the
    highest that holds (0 or 1 if none does).
    """
    low, high = 0.0, 1.0
    live = shares.filter("p > 0")

    def judge(points: list[float]) -> list[bool]:
        power = lambda x: F.pow("p", F.lit(x))
        sums = live.agg(*[F.sum(power(x)) for x in points], *[F.sum(power(x) * F.log("p")) for x in points]).first()
        return [meets(x, sums[i], sums[len(points) + i]) for i, x in enumerate(points)]

    at_low, at_high = judge([low, high])
    if rising and (at_low or not at_high):
        return low if at_low else high
    if not rising and (at_high or not at_low):
        return high if at_high else low
    for _ in range(halvings // 4):
        inner = [low + (high - low) * k / 16 for k in range(1, 16)]
        held = judge(inner)
        points = [low, *inner, high]
        k = held.index(True) if rising and True in held else held.index(False) if not rising and False in held else 15
        low, high = points[k], points[k + 1]
    return high if rising else low


def fit(
    sources: DataFrame, *, entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS,
    budget: float | None = None,
) -> Temperature:
    """Bisect the exponent for ``sources`` (source, tokens).

    It is the highest exponent (nearest to the natural shares) whose weights have at least
    ``entropy_share`` of the highest entropy, raised as far as needed for no source to be
    repeated more than ``max_repeats`` times. ``budget`` is the number of tokens to realise;
    by default the least at which every source appears whole at least once. Only sums over
    the sources reach the driver.
    """
    shares, facts = _shares(sources)
    if not facts["n"]:
        return Temperature(1.0, 1.0, 0.0)
    total, low, high = float(facts["total"]), facts["low"], facts["high"]
    target = entropy_share * math.log(facts["n"])

    def entropy_met(x: float, s0: float, s1: float) -> bool:
        return math.log(s0) - x * s1 / s0 >= target - 1e-12

    def tokens_needed(x: float, s0: float) -> float:
        return total * s0 * high ** (1 - x) if budget is None else budget

    def repeats_met(x: float, s0: float, _: float) -> bool:
        return low ** (x - 1) / s0 * tokens_needed(x, s0) / total <= max_repeats * (1 + 1e-9)

    exponent = max(_bisect(shares, entropy_met, rising=False), _bisect(shares, repeats_met, rising=True))
    norm = shares.filter("p > 0").agg(F.sum(F.pow("p", F.lit(exponent)))).first()[0]
    return Temperature(exponent, norm, tokens_needed(exponent, norm))


def _prefix(df: DataFrame, by: list[str], order: str, value: str, name: str) -> DataFrame:
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))


def plan(rows: DataFrame, sources: DataFrame, found: Temperature, *, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per source: its weight, how many whole epochs it gets, and the place up to which a last
    epoch's permutation is taken.

    ``rows`` has (source, u, tokens), u being a document's place in [0, 1) in the permutation.
    A source's permutation is cut into blocks of about ``block_tokens``; whole blocks are taken
    while they fit the budget, and the block in which it ends is gone through in order.
    """
    total = sources.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    share = F.col("tokens") / F.lit(float(total or 1))
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(found.exponent)) / F.lit(found.norm)).otherwise(0.0)
    rate = F.when(F.col("tokens") > 0, weight * F.lit(found.budget) / F.col("tokens")).otherwise(1.0)
    # rounding must not turn a whole epoch into nearly one
    near = F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(rate)
    quotas = sources.select(
        "source", "tokens", weight.alias("weight"), F.floor(near).alias("epochs"),
        F.floor((near - F.floor(near)) * F.col("tokens")).alias("need"),
        F.greatest(F.ceil(F.col("tokens") / block_tokens), F.lit(1)).cast("double").alias("blocks"),
    )
    quotas = materialize(quotas, "mixing-quotas")
    placed = rows.join(quotas.filter("need > 0").select("source", "blocks", "need"), "source").withColumn(
        "block", F.floor(F.col("u") * F.col("blocks"))
    )
    sums = placed.groupBy("source", "need", "block").agg(F.sum("tokens").alias("n"))
    sums = sums.withColumn("group", F.floor(F.col("block") / GROUP))
    groups = _prefix(sums.groupBy("source", "group").agg(F.sum("n").alias("n")), ["source"], "group", "n", "base")
    inside = _prefix(sums, ["source", "group"], "block", "n", "ahead").join(
        groups.select("source", "group", "base"), ["source", "group"]
    )
    ahead = F.col("base") + F.col("ahead")
    last = inside.filter((ahead <= F.col("need")) & (ahead + F.col("n") > F.col("need"))).select(
        "source", "block", (F.col("need") - ahead).alias("left")
    )
    # equal rows share a place and stay together
    steps = placed.join(last, ["source", "block"]).groupBy("source", "left", "block", "blocks", "u").agg(
        F.sum("tokens").alias("n")
    )
    upto = Window.partitionBy("source").orderBy("u").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = steps.withColumn("_sum", F.sum("n").over(upto))
    cuts = fits.groupBy("source").agg(
        F.max(F.when(F.col("_sum") <= F.col("left"), F.col("u"))).alias("_in"),
        # nothing of that block fits: everything before it
        F.min(F.col("block") / F.col("blocks")).alias("_edge"),
    )
    cut = F.when(F.col("_in").isNotNull(), F.col("_in")).otherwise(F.col("_edge") - F.lit(2.0**-53))
    return quotas.join(cuts, "source", "left").select(
        "source", "tokens", "weight", "epochs", "blocks", F.coalesce(cut, F.lit(-1.0)).alias("cut")
    )


def _place(doc_id: Column, text: Column, seed: str) -> Column:
    return unit_hash(seed, doc_id, text)


def mix(
    docs: DataFrame, *, entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS,
    budget: float | None = None, block_tokens: int = BLOCK_TOKENS, seed: str = "mixing",
) -> DataFrame:
    """The mixture: every drawn copy of a row, with one struct column ``_mix``.

    Fields: ``n_tokens`` (words), ``weight`` of the source, ``epoch`` of the copy, ``block`` and
    ``turn``, by which the blocks of all sources and epochs are shuffled. A source gets its
    weight's part of the budget (see ``fit``): all its rows once for each whole epoch, then
    the first part of a further permutation, so its tokens never exceed its part.

    A null source counts as the source ''. Null and empty texts have no tokens: they come
    along with their source, and a source without any token is kept once. Rows equal in id
    and text share a place, so they are drawn together. Null ids are ids like any other.
    Other columns pass through (one called ``_mix`` is replaced). An empty table gives an
    empty table.
    """
    prepare(docs.sparkSession)
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    n_tokens = F.size(words(F.coalesce(F.col("text"), F.lit("")))).cast("long")
    rows = docs.select(
        source.alias("source"), _place(F.col("doc_id"), F.col("text"), seed).alias("u"), n_tokens.alias("tokens")
    )
    rows = materialize(rows, "mixing-rows")
    sources = materialize(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mixing-sources")
    found = fit(sources, entropy_share=entropy_share, max_repeats=max_repeats, budget=budget)
    drawn = materialize(plan(rows, sources, found, block_tokens=block_tokens), "mixing-plan")
    drawn = drawn.select(F.col("source").alias("_source"), F.struct("weight", "epochs", "blocks", "cut").alias("_plan"))
    u, rule = F.col("_u"), F.col("_plan")
    held = docs.drop("_mix").withColumns(
        {"_source": source, "_u": _place(F.col("doc_id"), F.col("text"), seed), "_n": n_tokens}
    )
    copies = (rule["epochs"] + (u <= rule["cut"]).cast("long")).cast("int")
    epochs = F.when(copies > 0, F.sequence(F.lit(1), F.greatest(copies, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    drawn_rows = held.join(drawn, "_source").withColumn("_epoch", F.explode(epochs))
    block = F.floor(u * rule["blocks"])
    mixed = F.struct(
        F.col("_n").alias("n_tokens"), rule["weight"].alias("weight"), F.col("_epoch").alias("epoch"),
        block.alias("block"), F.xxhash64(F.lit(seed), F.col("_source"), F.col("_epoch"), block).alias("turn"),
    )
    return drawn_rows.withColumn("_mix", mixed).drop("_source", "_u", "_n", "_plan", "_epoch")
