"""Text search over whole texts, and ordered string aggregation."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

# Words too common to search for.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
)


def tokens(text: Column) -> Column:
    """Lowercase words of a text, stopwords removed, repeats kept."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.filter(words, lambda w: (w != "") & ~F.array_contains(stop, w))


def search_words(terms: list[str]) -> list[str]:
    """Search terms cut as texts are: compounds into words, stopwords dropped, each once."""
    found = [w for term in terms for w in re.split(r"[\W_]+", term.lower()) if w and w not in STOPWORDS]
    return list(dict.fromkeys(found))


def may_have_all(text: Column, terms: list[str]) -> Column:
    """Cheap necessary condition for ``has_all``: every term occurs somewhere in the text."""
    lowered = F.lower(text)
    held = [lowered.contains(t.lower()) for t in terms]
    return reduce(lambda a, b: a & b, held, F.lit(True))


def has_all(words: Column, terms: list[str]) -> Column:
    """Does a token array hold every search term?"""
    wanted = [t.lower() for t in terms]
    return F.forall(F.array(*[F.lit(t) for t in wanted]).cast("array<string>"), lambda t: F.array_contains(words, t))


def term_frequency(words: Column, terms: list[str]) -> Column:
    """Share of a text's tokens that are search terms (0 for an empty text)."""
    wanted = F.array(*[F.lit(t.lower()) for t in terms]).cast("array<string>")
    hits = F.size(F.filter(words, lambda w: F.array_contains(wanted, w)))
    return F.when(F.size(words) > 0, hits.cast("double") / F.size(words)).otherwise(F.lit(0.0))


def join_sorted(values: Column, separator: str = ", ") -> Column:
    """Aggregate: distinct non-NULL values in order; NULL when there are none."""
    items = F.sort_array(F.collect_set(values))
    return F.when(F.size(items) > 0, F.array_join(items, separator))


def group_concat(values: Column, order: Column, separator: str = ", ") -> Column:
    """Aggregate: every non-NULL value in a given order; NULL when there are none."""
    pairs = F.sort_array(
        F.collect_list(F.when(values.isNotNull(), F.struct(order.alias("o"), values.alias("v"))))
    )
    return F.when(F.size(pairs) > 0, F.array_join(F.transform(pairs, lambda p: p["v"]), separator))
