"""Rule-based text scores.

Every score is a column expression over the words of the whole text, so scoring
needs no shuffle and no Python.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words of the simple sentiment rule.
POSITIVE = ["great", "excellent", "love", "perfect", "amazing"]
NEGATIVE = ["terrible", "awful", "broken", "waste", "disappointed"]


def words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def hits(tokens: Column, vocabulary: Sequence[str]) -> Column:
    """How many of the words belong to the vocabulary."""
    return F.size(F.filter(tokens, lambda w: w.isin(list(vocabulary)))).cast("bigint")


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _known(tokens: Column, *vocabularies: Sequence[str]) -> Column:
    """The words of interest, usually few: counted several times, searched once."""
    every = sorted({w for v in vocabularies for w in v})
    return F.filter(tokens, lambda w: w.isin(every))


def sentiment(tokens: Column, positive: Sequence[str] = POSITIVE, negative: Sequence[str] = NEGATIVE) -> Column:
    """(positive - negative) / (positive + negative), 0 without either."""

    def score(found: Column) -> Column:
        up, down = hits(found, positive), hits(found, negative)
        return F.coalesce(F.try_divide(up - down, up + down), F.lit(0.0))

    return _with(_known(tokens, positive, negative), score)


def classify(tokens: Column, labels: Mapping[str, Sequence[str]], otherwise: str) -> Column:
    """The label with most keyword hits; of equals the one listed first."""

    def best_label(found: Column) -> Column:
        counts = F.array(*[hits(found, v) for v in labels.values()])
        return _with(counts, lambda c: F.when(F.array_max(c) > 0, F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))))

    names = F.array(*[F.lit(n) for n in labels])
    return F.coalesce(_with(_known(tokens, *labels.values()), best_label), F.lit(otherwise))


def mentions(tokens: Column, vocabulary: Sequence[str]) -> Column:
    return F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in vocabulary]))
