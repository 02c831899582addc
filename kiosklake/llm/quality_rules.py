"""Quality rules: a threshold table compiled into one projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from kiosklake.llm.common import SEPARATORS, let, words

# Frequent function words of the corpus languages.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his this are or at from an have which one you all "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er so dass sie wird "
    "de la le et les des en un une du dans qui que pour au sur pas plus par il est avec ce ne se on son cette "
    "el los las del y al una por con para su no lo como más pero sus le ya o este sí porque"
)
_SYMBOLS = "#*$%&|<>"
_WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A measure must lie in [low, high]; either bound may be absent."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Production thresholds. Measures are those of ``_measures``.
RULES = (
    Rule("too_long", "n_words", high=10_000_000),
    Rule("word_length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbols_per_word", high=0.3),
    Rule("stop_words", "stop_word_share", low=0.02),
    Rule("dup_lines", "dup_line_share", high=0.6),
    Rule("line_length", "words_per_line", low=1.5),
)


def _repeated_words(found: Column) -> Column:
    """Words inside windows of eight words that the text holds twice or more."""
    def covered(windows: Column) -> Column:
        in_order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twins(s: Column) -> Column:
            twin = lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])
            return F.sort_array(F.transform(
                F.filter(s, lambda x, k: F.coalesce(twin(x, k), F.get(s, k - 1)["h"] == x["h"], F.get(s, k + 1)["h"] == x["h"], F.lit(False))),
                lambda x: x["i"],
            ))

        width = lambda p: F.transform(p, lambda v, k: F.least(F.coalesce(F.get(p, k + 1) - v, F.lit(_WINDOW)), F.lit(_WINDOW)))
        return let(let(in_order, twins), lambda p: F.aggregate(width(p), F.lit(0), lambda a, x: a + x))

    def counted(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - _WINDOW),
            lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(_WINDOW)]),
        )
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))

    hashes = F.transform(found, lambda w: F.xxhash64(w))
    return F.when(F.size(found) < _WINDOW, F.lit(0)).otherwise(let(hashes, counted))


def _word_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SEPARATORS)) != "")


def counts(text: Column) -> Column:
    """The counts of a whole text as one struct; a null text counts as empty."""
    stop = sorted({form for w in STOP_WORDS.split() for form in (w, w[0].upper() + w[1:], w.upper())})
    whole = F.coalesce(text, F.lit(""))
    return let(whole, lambda t: let(words(t), lambda w: let(_word_lines(t), lambda lines: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.char_length(F.translate(t, SEPARATORS, "")).cast("bigint").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, _SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.size(lines).cast("bigint").alias("n_lines"),
        _repeated_words(w).cast("bigint").alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: x.isin(stop))).cast("bigint").alias("n_stop_words"),
    ))))


def _measures(m: Column) -> dict[str, Column]:
    n_words, lines = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["n_lines"], F.lit(1))
    return {
        "n_words": m["n_words"].cast("double"),
        "mean_word_chars": m["word_chars"] / n_words,
        "symbols_per_word": m["n_symbols"] / n_words,
        "stop_word_share": m["n_stop_words"] / n_words,
        "dup_line_share": m["n_dup_lines"] / lines,
        "words_per_line": m["n_words"] / lines,
    }


def _broken(rule: Rule, value: Column) -> Column:
    outside = F.lit(False)
    if rule.low is not None:
        outside = outside | (value < rule.low)
    if rule.high is not None:
        outside = outside | (value > rule.high)
    return F.when(outside, F.lit(rule.name))


def judge(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Counts and verdict of a text as one struct (see ``apply_rules``).

    One expression that works out the counts once: a filter on a field of it is one
    evaluation, wherever the optimizer moves the filter.
    """
    def verdict(m: Column) -> Column:
        values = _measures(m)
        failed = F.array_compact(F.array(*[_broken(r, values[r.measure]) for r in rules]))
        base = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
        shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return let(failed, lambda f: F.struct(
            *[m[c].alias(c) for c in shown], base.alias("base_failed"), f.alias("failed"),
            (~base & (F.size(f) == 0)).alias("kept"),
        ))

    return let(counts(text), verdict)


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Every row with its counts and verdict in one struct column ``quality``.

    Fields: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``failed`` (names of the broken rules, in table
    order) and ``kept``. The table becomes one projection: no shuffle, no user function.

    Null and empty texts have zero words and fail the base rule. Equal texts get equal
    verdicts; repeated rows and null ids stay as they are; other columns pass through (one
    named ``quality`` is replaced). An empty table gives an empty table.
    """
    return docs.withColumn("quality", judge(F.col(text), rules))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Only the rows that pass every rule, with the columns they came with."""
    return docs.filter(judge(F.col("text"), rules)["kept"])
