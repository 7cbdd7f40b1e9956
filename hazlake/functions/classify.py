"""Keyword hits, hazard class and severity."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

from hazlake.taxonomy import DEFAULT, DISASTER_KEYWORDS, Taxonomy


def _has_any(corpus: Column, terms, word_boundary: bool = False) -> Column:
    if word_boundary:
        return corpus.rlike(r"\b(?:" + "|".join(re.escape(t) for t in terms) + r")\b")
    return reduce(lambda a, b: a | b, [corpus.contains(t) for t in terms])


def keyword_hits(text: Column, keywords=DISASTER_KEYWORDS) -> Column:
    """Phrases contained in the text, ignoring case, in list order."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(lowered.contains(k.lower()), F.array(F.lit(k))).otherwise(none) for k in keywords])


def corpus(keywords: Column, text: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """The lowercased string the term lists are searched in."""
    body = text if taxonomy.scan_chars is None else F.substring(text, 1, taxonomy.scan_chars)
    joined = F.coalesce(F.array_join(keywords, " "), F.lit(""))
    tail = F.when(F.length(text) > 0, F.concat(F.lit(" "), body)).otherwise("")
    return F.lower(F.concat(joined, tail))


def hazard_of(corpus_col: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """First class, in taxonomy order, with a term in the corpus; else null."""
    label = F.lit(None).cast("string")
    for name, terms in reversed(taxonomy.hazards):
        label = F.when(_has_any(corpus_col, terms, taxonomy.word_boundary), name).otherwise(label)
    return label


def severity_of(corpus_col: Column, taxonomy: Taxonomy = DEFAULT, condition: Column | None = None) -> Column:
    """CRITICAL, WARNING or INFO; a marked weather condition overrides the terms."""
    by_terms = (
        F.when(_has_any(corpus_col, taxonomy.critical, taxonomy.word_boundary), "CRITICAL")
        .when(_has_any(corpus_col, taxonomy.warning, taxonomy.word_boundary), "WARNING")
        .otherwise("INFO")
    )
    if condition is None:
        return by_terms
    return (
        F.when(condition.contains("CRITICAL"), "CRITICAL")
        .when(condition.contains("WARNING"), "WARNING")
        .otherwise(by_terms)
    )


def hazard_type(keywords: Column, text: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    return hazard_of(corpus(keywords, text, taxonomy), taxonomy)


def hazard_severity(
    keywords: Column, text: Column, taxonomy: Taxonomy = DEFAULT, condition: Column | None = None
) -> Column:
    return severity_of(corpus(keywords, text, taxonomy), taxonomy, condition)
