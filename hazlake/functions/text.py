"""Text cleaning, label confidence, tokens."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

# Cleaning patterns, applied in this order. (?U) makes \s Unicode-aware,
# so a no-break space ends a URL; the four separators \x1C-\x1F end one too.
URL_PATTERN = r"(?iU)(?:https?://|www\.)[^\s\x1C-\x1F]+"
TAG_PATTERN = r"<[^>]+>"
NON_ASCII_PATTERN = r"[^\x20-\x7E]"
CONTROL_PATTERN = r"[\p{Cc}\p{Cf}]"
SPACE_PATTERN = r"\s+"


def clean_text(text: Column, keep_unicode: bool = False) -> Column:
    """Drop URLs, tags and unprintable characters, squeeze spaces; empty becomes null."""
    drop = CONTROL_PATTERN if keep_unicode else NON_ASCII_PATTERN
    spaces = "(?U)" + SPACE_PATTERN if keep_unicode else SPACE_PATTERN
    out = text
    for pattern in (URL_PATTERN, TAG_PATTERN, drop, spaces):
        out = F.regexp_replace(out, pattern, " ")
    return F.nullif(F.trim(out), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for empty or null."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), ""))


def label_confidence(text: Column, keywords: Column) -> Column:
    """Words in the hit keywords over words in the text, at most 1, 4 places."""
    words = word_count(text)
    hit_words = F.aggregate(
        F.coalesce(keywords, F.array().cast("array<string>")), F.lit(0), lambda n, k: n + word_count(k)
    )
    share = F.round(hit_words.cast("double") / words, 4)
    return F.when((words > 0) & (hit_words > 0), F.least(F.lit(1.0), share)).otherwise(0.0)


def latin_fold() -> tuple[str, str]:
    """(accented, plain) letters: every Latin letter that is a base plus exactly one mark."""
    accented, plain = [], []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) == 2 and parts[0].isascii() and unicodedata.combining(parts[1]):
            accented.append(chr(code))
            plain.append(parts[0])
    return "".join(accented), "".join(plain)


def fold(text: Column) -> Column:
    """Lowercase and without accents, so that search ignores both."""
    accented, plain = latin_fold()
    bare = F.regexp_replace(text, r"[\u0300-\u036F]", "")
    # Most texts are plain ASCII, where letters have nothing to lose.
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.lower(F.translate(bare, accented, plain))
    )


def tokens(text: Column) -> Column:
    """Letter and digit runs of the folded text, in order; [] for null."""
    parts = F.split(fold(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(parts, "")


def token_line(text: Column) -> Column:
    """The tokens as one string, two blanks before, between and after them."""
    padded = F.concat(F.lit(" "), fold(F.coalesce(text, F.lit(""))), F.lit(" "))
    return F.regexp_replace(padded, r"[^\p{L}\p{N}]+", "  ")


def query_tokens(query: str) -> list[str]:
    """The same tokens for a query string the caller holds (driver side, one short string)."""
    accented, plain = latin_fold()
    bare = "".join(c for c in query if not "\u0300" <= c <= "\u036F")
    folded = bare.translate(str.maketrans(accented, plain)).lower()
    spaced = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in folded)
    return list(dict.fromkeys(spaced.split()))
