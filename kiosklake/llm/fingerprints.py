"""Document fingerprints by consistent weighted sampling.

Of a text's weighted terms each sample picks one: for a term with weight w, gamma draws r and c
and a uniform draw b that depend on the term and the sample alone give t = floor(ln w / r + b)
and a = c / exp(r * (t - b) + r); the term of least a is picked together with its t. Two texts
pick the same with a chance equal to their generalised Jaccard similarity, the sum of the lesser
weights over the sum of the greater ones.

The least a of a text of W words is exponential with mean 1 / W. Logarithms cost most of a draw, so
a draw first bounds a from below without them: with x = exp(-r) and y = exp(-c), both products of
uniform draws, a >= c * x / w and c >= 2 * (1 - y) / (1 + y). A term whose bound is above SURE / W
is not drawn further; a text with a sample whose least a is not below that (each has a chance of
exp(-SURE)) is drawn once more, in full, so what is picked is the same as without the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kiosklake.llm.common import let, prepare, words
from kiosklake.session import materialize

#: Samples in a fingerprint, draws worked out in one go, and buckets of the id order per shuffle partition.
SAMPLES, GROUPED, BUCKETS_PER_PARTITION = 64, 8, 4
#: Times the mean of the least a up to which draws of a text are worked out at first.
SURE = 9.0
_LOW, _NEVER = 0xFFFFFFFF, 2**63 - 1


def weighted_terms(text: Column) -> Column:
    """Hashes of a text's words with their counts: array of (h, n)."""
    def runs(h: Column) -> Column:
        first = F.filter(
            F.sequence(F.lit(0), F.size(h) - 1), lambda i: (i == 0) | (F.get(h, i) != F.coalesce(F.get(h, i - 1), F.lit(0)))
        )
        return let(first, lambda s: F.transform(s, lambda at, k: F.struct(
            F.get(h, at).alias("h"), (F.coalesce(F.get(s, k + 1), F.size(h)) - at).alias("n")
        )))

    none = F.array().cast("array<struct<h:bigint,n:int>>")
    in_order = F.sort_array(F.transform(words(text), lambda w: F.xxhash64(w)))
    return let(in_order, lambda h: F.when(F.size(h) == 0, none).otherwise(runs(h)))


def _level(log_a: Column) -> Column:
    """ln a in fixed point, in the high 32 bits of a long."""
    return F.shiftleft(((log_a + 160.0) * 2.0**23).cast("long"), 32)


def _uniforms(bits: Column) -> tuple[Column, Column]:
    """Two uniform draws of 32 bits each."""
    high, low = F.shiftrightunsigned(bits, 32), bits.bitwiseAND(F.lit(_LOW))
    return tuple((x.cast("double") + 0.5) * 2.0**-32 for x in (high, low))


def _bits(term: Column, first: Column, sample: int, k: int) -> Column:
    return F.xxhash64(term, first + (3 * sample + k))


def _gammas(term: Column, first: Column, sample: int, most: Column | None = None) -> tuple[Column, Column]:
    """r and ln c of a draw; ``first`` numbers the draws of the group that ``sample`` is in.

    ``most`` is a times the weight; null where a is greater by a bound that needs no logarithm.
    """
    x, y = (one * other for one, other in (_uniforms(_bits(term, first, sample, k)) for k in range(2)))
    r, log_c = -F.log(x), F.log(-F.log(y))
    if most is None:
        return r, log_c
    within = (1.0 - y) * x * 2.0 <= most * (1.0 + y)
    return F.when(within, r), F.when(within, log_c)


def _draw(term: Column, log_weight: Column, first: Column, sample: int, r: Column, log_c: Column) -> Column:
    """One long: ln a in fixed point above, what was picked (term and t) in the low 32 bits."""
    bits = _bits(term, first, sample, 2)
    b, _ = _uniforms(bits)
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t - b) - r
    return _level(log_a).bitwiseOR(bits.bitwiseXOR(t).bitwiseAND(F.lit(_LOW)))


def sample_terms(
    terms: DataFrame, by: list[str], samples: int = SAMPLES, weights: dict[str, str] | None = None,
    also: tuple[str, ...] = (), most: str | None = None,
) -> DataFrame:
    """``by`` and the sampled picks of each group's terms (column ``h``).

    ``weights`` maps columns of counts to names of the picks drawn by them; by default ``n`` gives
    ``picks``. A term has one row in a group, and is drawn once for each of its different weights
    above 0. The least of packed longs is kept per sample, so tasks combine before any shuffle; a
    term takes its draws ``GROUPED`` at a time, which keeps generated code small. A row without a
    weight above 0 is drawn by nobody, but keeps its group: one of such rows alone has picks of 0.
    ``also`` names columns that a group has one value of, and that only its rows without weight need to bear.
    ``most`` names a column, of one value in a group, above which an a need not be worked out; a column ``sure``
    then tells whether all that was picked is below it, and so is what would be picked without it.
    """
    by = [*by, *([most] if most else [])]
    weights = weights or {"n": "picks"}
    named, none, void = list(weights), F.lit(0).cast("long"), F.array().cast("array<int>")
    # a number of the first draw and, in its low byte, that of the weight; -1 where there is none
    asked, new = [], [F.col(w) > 0 for w in named]
    for k, w in enumerate(named):
        for earlier in named[:k]:
            new[k] &= F.col(w) != F.col(earlier)
        codes = F.array(*[F.lit(3 * i << 8 | k) for i in range(0, samples, GROUPED)])
        asked.append(F.when(new[k], codes).otherwise(void))
    asked = F.concat(*asked)
    logs = {f"_ln_{w}": F.log(F.greatest(F.col(w), F.lit(1)).cast("double")) for w in named}
    held = terms.select(*by, *also, "h", *named).withColumns(logs)
    held = held.withColumn("_code", F.explode(F.when(F.size(asked) == 0, F.array(F.lit(-1))).otherwise(asked)))
    which, apart = F.col("_code").bitwiseAND(F.lit(255)), F.col("_code") < 0

    def drawn_by(columns: list[str]) -> Column:
        return F.coalesce(*[F.when(which == k, F.col(c)) for k, c in enumerate(columns)])

    weight = drawn_by(named)
    held = held.select(
        *by, *[F.when(apart, F.col(c)).alias(c) for c in also], "h", F.shiftright("_code", 8).alias("_first"),
        drawn_by([f"_ln_{w}" for w in named]).alias("_ln"),
        *[F.when(F.col(w) == weight, none).otherwise(F.lit(_NEVER)).alias(f"_not_{w}") for w in named],
        *([(F.col(most) * weight).alias("_weighed")] if most else []),
    )
    # r and c are columns of their own, so that each is worked out once
    drawn = {}
    for i in range(GROUPED):
        r, log_c = _gammas(F.col("h"), F.col("_first"), i, F.col("_weighed") if most else None)
        drawn |= {f"_r{i}": r, f"_c{i}": log_c}
    held, least = held.withColumns(drawn), []
    for i in range(GROUPED):
        packed = _draw(F.col("h"), F.col("_ln"), F.col("_first"), i, F.col(f"_r{i}"), F.col(f"_c{i}"))
        least += [F.min(packed.bitwiseOR(F.col(f"_not_{w}"))).alias(f"_{w}{i}") for w in named]
    part = held.groupBy(*by, "_first", *also).agg(*least)
    pick = lambda c: F.when(F.col(c) < _NEVER, F.col(c).bitwiseAND(F.lit(_LOW))).otherwise(none)
    kept = [F.array(*[pick(f"_{w}{i}") for i in range(GROUPED)]).alias(w) for w in named]
    if most:  # two steps of the fixed point clear of rounding
        below = _level(F.log(F.col(most)) - 2.0**-22)
        kept.append((F.greatest(*[F.coalesce(f"_{w}{i}", F.lit(_NEVER)) for w in named for i in range(GROUPED)]) < below).alias("sure"))
    drawn = part.select(*by, *also, F.struct("_first", *kept).alias("_part"))
    whole = drawn.groupBy(*by).agg(F.sort_array(F.collect_list("_part")).alias("_parts"), *[F.max(c).alias(c) for c in also])
    whole = whole.withColumn("_parts", F.filter("_parts", lambda p: p["_first"] >= 0))
    return whole.select(*by, *also, *[
        F.when(F.size("_parts") == 0, F.array_repeat(none, samples))
        .otherwise(F.slice(F.flatten(F.col(f"_parts.{w}")), 1, samples)).alias(weights[w]) for w in named
    ], *([F.forall("_parts", lambda p: p["sure"]).alias("sure")] if most else []))


def as_text(picks: Column) -> Column:
    """Eight lower-case hex digits per sample."""
    return F.lower(F.array_join(F.transform(picks, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(one: Column, other: Column) -> Column:
    """Share of equal picks: an unbiased estimate of the generalised Jaccard similarity."""
    same = F.zip_with(one, other, lambda a, b: (a == b).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x) / F.size(one)


def fingerprint(docs: DataFrame, key: list[str], *, text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``key`` and ``picks`` of each text; rows equal in ``key`` must be equal in text.

    Null and empty texts have picks of 0, and so are alike to each other and to nothing else.
    Other columns are ignored; an empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    whole = docs.select(*key, weighted_terms(F.coalesce(F.col(text), F.lit(""))).alias("_terms"))
    terms = whole.select(*key, F.explode_outer("_terms").alias("_t")).select(*key, "_t.h", "_t.n")
    return sample_terms(terms, key, samples)


# ---------------------------------------------------------------- a text against its neighbour

def _bucket(doc_id: Column, splits: list) -> Column:
    """How many of the descending ``splits`` are above the id: found in two steps of root size."""
    if not splits:
        return F.lit(0).cast("long")
    step = max(1, int(len(splits) ** 0.5))
    groups = [splits[i : i + step] for i in range(0, len(splits), step)]
    above = lambda values: F.size(F.filter(values, lambda s: s > doc_id))
    heads = F.array(*[F.lit(g[-1]) for g in groups])
    nested = F.array(*[F.array(*map(F.lit, g)) for g in groups])
    within = lambda k: k * step + F.coalesce(above(F.get(nested, k)), F.lit(0))
    return F.when(doc_id.isNull(), F.lit(len(splits))).otherwise(let(above(heads), within)).cast("long")


def _links(heads: DataFrame) -> DataFrame:
    """Each bucket with the value ``_v`` that the next one begins with; after the last comes the first."""
    ids = heads.select("bucket", F.lit(1).alias("_all"))
    after = F.lead("bucket").over(Window.partitionBy("_all").orderBy("bucket"))
    first = F.min("bucket").over(Window.partitionBy("_all"))
    return ids.select("bucket", F.coalesce(after, first).alias("_to")).join(
        heads.select(F.col("bucket").alias("_to"), "_v"), "_to"
    ).select("bucket", "_v")


def _next(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Add the ``value`` of the row that follows in (bucket, place); the first follows the last.

    The neighbour within a bucket comes from a window; across buckets each one's first
    value is looked up, of which there is one per bucket.
    """
    heads = materialize(rows.filter(F.col("place") == 1).select("bucket", F.col(value).alias("_v")), "bucket-heads")
    led = rows.withColumn("_lead", F.lead(F.struct(value)).over(Window.partitionBy("bucket").orderBy("place")))
    return led.join(_links(heads), "bucket").withColumn(
        name, F.when(F.col("_lead").isNull(), F.col("_v")).otherwise(F.col(f"_lead.{value}"))
    ).drop("_lead", "_v")


def _side_terms(texts: DataFrame, known: list[str], shown: tuple[str, ...]) -> DataFrame:
    """Terms of ``text`` (counted in n) and ``_edited`` (m) by ``known``, and a row without a term that bears ``shown``.

    ``_most`` is SURE / W of the shorter one that has words.
    """
    split = texts.withColumns({"_words": words(F.col("text")), "_others": words(F.col("_edited"))})
    fewest = F.least(*[F.nullif(F.size(c), F.lit(0)) for c in ("_words", "_others")])
    side = F.col("_side")
    # words are counted by a grouping: a text's, its edited text's, and a row without a word that bears the rest
    parts = split.withColumns({
        "_most": F.coalesce(F.lit(SURE) / fewest, F.lit(1.0)), "_side": F.explode(F.array(*map(F.lit, range(3)))),
    }).select(
        *known, "_most", "_side", *[F.when(side == 2, F.col(c)).alias(c) for c in shown],
        F.when(side == 0, F.col("_words")).when(side == 1, F.col("_others")).alias("_words"),
    )
    found = parts.select(*known, "_most", *shown, "_side", F.explode_outer("_words").alias("_word"))
    found = found.filter(F.col("_word").isNotNull() | (side == 2))
    return found.groupBy(*known, "_most", *shown, F.when(side < 2, F.xxhash64("_word")).alias("h")).agg(
        F.count_if(side == 0).alias("n"), F.count_if(side == 1).alias("m")
    )


def edited_neighbours(docs: DataFrame, *, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of the text after an edit, with their likenesses.

    The edit replaces the last half of a text (floor of its code points) by the first as many
    code points, or all, of the next document in descending order of ``doc_id``; after the
    last comes the first. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next (to the next document's text).

    Rows of one id are ordered by a hash of the text; null ids come last; null texts are
    empty. Ids are cut into buckets at sampled quantiles, so no task orders the whole table.
    A lone row is its own neighbour. Other columns are ignored; an empty table gives an
    empty table.
    """
    spark = prepare(docs.sparkSession)
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / buckets for i in range(1, buckets)]
    found = docs.agg(F.percentile_approx("doc_id", cuts, 20 * buckets).alias("q")).first()["q"]
    splits = sorted(set(found or []), reverse=True)
    held = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn(
        "bucket", _bucket(F.col("doc_id"), splits)
    )
    # the greatest key comes first: id descending, nulls last, then the hash ascending
    key = F.struct("doc_id", F.bitwise_not(F.xxhash64("text")))
    heads = materialize(held.groupBy("bucket").agg(F.max_by(F.col("text"), key).alias("_v")), "text-heads")
    # what the next bucket begins with stands at the end of each, so neighbours need no join
    ends = _links(heads).select("bucket", F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.col("_v").alias("text"), F.lit(1).alias("_end"))
    both = held.withColumn("_end", F.lit(0)).unionByName(ends)
    # one task a bucket: a hash would put several into one task and none into another
    dealt = both.withColumn("bucket", F.col("bucket").cast("int")).repartitionById(len(splits) + 1, F.col("bucket"))
    in_order = Window.partitionBy("bucket").orderBy("_end", key.desc())
    placed = dealt.withColumns({"place": F.row_number().over(in_order), "_next": F.lead("text").over(in_order)})
    rows = placed.filter(F.col("_end") == 0)

    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("_next", F.lit(1), half))
    known, shown, kinds = ["bucket", "place"], ("doc_id", "n_chars", "edited_sha256"), {"n": "picks", "m": "edited"}
    texts = rows.select(
        "bucket", "place", "doc_id", n.cast("long").alias("n_chars"), F.col("text"), edited.alias("_edited")
    ).withColumn("edited_sha256", F.sha2(F.col("_edited").cast("binary"), 256))
    both_texts = (*shown, "text", "_edited")
    drawn = sample_terms(_side_terms(texts, known, both_texts), known, samples, kinds, both_texts, "_most")
    # texts stay with rows that are to be drawn again
    again = [F.when(~F.col("sure"), F.col(c)).alias(c) for c in ("text", "_edited")]
    drawn = materialize(drawn.select(*known, *shown, "picks", "edited", "sure", *again), "fingerprints")
    whole = sample_terms(_side_terms(drawn.filter(~F.col("sure")), known, shown), known, samples, kinds, shown)
    signed = drawn.filter("sure").select(whole.columns).unionByName(materialize(whole, "fingerprints-again"))
    return _next(signed, "picks", "_next").select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("picks")).alias("fingerprint"), as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("picks"), F.col("edited")).alias("near_edited"),
        likeness(F.col("picks"), F.col("_next")).alias("near_next"),
    )
