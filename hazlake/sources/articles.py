"""Article HTML to body text and lead image, with built-in string functions."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, functions as F

_SKIPPED = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
# A paragraph starts at its tag and runs to its end tag, the next paragraph, or the end of its container.
_PARAGRAPH_START = r"(?i)<p(?:\s[^>]*)?>"
_PARAGRAPH_REST = r"(?is)</(?:p|article|section|div|main|td|body|html)\s*>.*$"
_TAG = r"(?s)<[^>]*>"
_MARK, _NEXT = "\u0001", "\u0002"
# The names most pages use; they are tried before the whole list.
_COMMON = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "rsquo": "\u2019", "mdash": "\u2014", "copy": "\u00a9"}
_SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _char(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _numbered(digits: Column, base: int) -> Column:
    """The character of a numeric reference of any length; U+FFFD where there is none."""
    short = F.regexp_replace(digits, "^0+", "")
    # More than seven digits are beyond every character; their number is not looked at.
    code = F.when(F.length(short) > 7, F.lit(0)).otherwise(F.conv(F.concat(F.lit("0"), short), base, 10).cast("int"))
    none = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    # Codes of the C1 controls mean the characters of Windows-1252, where it has one.
    c1 = code.between(0x80, 0x9F) & ~code.isin(0x81, 0x8D, 0x8F, 0x90, 0x9D)
    windows = F.element_at(F.array(*[F.lit(bytes([k]).decode("cp1252", "replace")) for k in range(0x80, 0xA0)]), F.greatest(F.lit(1), code - 0x7F))
    return F.when(none, "\ufffd").when(c1, windows).otherwise(_char(code))


def _named() -> Column:
    """Character by name, of all references of HTML that end in a semicolon; one literal, which Spark reads once."""
    pairs = "\u0003".join(f"{name[:-1]}\u0004{char}" for name, char in html5.items() if name.endswith(";"))
    return F.str_to_map(F.lit(pairs), F.lit("\u0003"), F.lit("\u0004"))


def _named_char(name: Column) -> Column:
    common = [(F.lit(n), F.lit(c)) for n, c in _COMMON.items()]
    found = F.when(name == common[0][0], common[0][1])
    for own, char in common[1:]:
        found = found.when(name == own, char)
    return found.otherwise(F.try_element_at(_named(), name))


def decode_entities(text: Column) -> Column:
    """Numeric and named references, each decoded once; a text without an ampersand is left alone.

    The one-element array binds the text, so that what computes it is not run again for every use.
    """
    bound = F.transform(F.array(text), lambda t: F.when(t.contains("&"), _decoded(t)).otherwise(t))
    return F.get(bound, F.lit(0))


def _decoded(text: Column) -> Column:
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"), 1))

    def char(name: Column) -> Column:
        return (
            F.when(name.rlike("^#[xX]"), _numbered(F.regexp_replace(name, "^..", ""), 16))
            .when(name.startswith("#"), _numbered(F.regexp_replace(name, "^.", ""), 10))
            .otherwise(_named_char(name))
        )

    known = F.filter(F.transform(found, lambda n: F.struct(n.alias("n"), char(n).alias("c"))), lambda x: x["c"].isNotNull())
    # What gives an ampersand comes last, so that nothing is decoded twice.
    in_order = F.array_sort(F.transform(known, lambda x: F.struct((x["c"] == "&").alias("last"), x["n"].alias("n"), x["c"].alias("c"))))
    return F.aggregate(in_order, text, lambda acc, x: F.replace(acc, F.concat(F.lit("&"), x["n"], F.lit(";")), x["c"]))


def paragraph_texts(html: Column) -> Column:
    """Text of each paragraph: its strings, trimmed, joined by one blank.

    Scripts, styles and comments are dropped first: they may hold tags as text.
    An unclosed paragraph ends where the next begins.
    """
    body = F.regexp_replace(html, _SKIPPED, " ")

    def strings(paragraph: Column) -> Column:
        parts = F.transform(F.split(paragraph, _MARK), lambda s: F.btrim(s, F.lit(_SPACES)))
        return F.array_join(F.array_remove(parts, ""), " ")

    def marked(paragraph: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(paragraph, _PARAGRAPH_REST, ""), _TAG, _MARK)

    # References are decoded once a page: paragraphs are joined by a mark for it.
    opened = F.split(body, _PARAGRAPH_START)
    rest = F.transform(F.array(opened), lambda o: F.when(F.size(o) > 1, F.array_join(F.transform(F.slice(o, 2, F.size(o)), marked), _NEXT)))
    decoded = decode_entities(F.get(rest, F.lit(0)))
    return F.coalesce(F.transform(F.split(decoded, _NEXT), strings), F.array().cast("array<string>"))


def article_text(html: Column, max_chars: int | None = None) -> Column:
    """All paragraph texts joined by a blank, or the leading ``max_chars`` of it; '' for null."""
    joined = F.coalesce(F.array_join(paragraph_texts(html), " "), F.lit(""))
    return joined if max_chars is None else F.substring(joined, 1, max_chars)


def _meta(html: Column, attribute: str, value: str) -> Column:
    """``content`` of the first <meta> with attribute=value, attributes in any order."""
    tag = F.regexp_extract(html, rf"""(?is)(<meta\b[^>]*\b{attribute}\s*=\s*["']{value}["'][^>]*>)""", 1)
    return decode_entities(F.regexp_extract(tag, r"""(?is)\bcontent\s*=\s*["']([^"']*)["']""", 1))


def lead_image(html: Column) -> Column:
    """og:image, else twitter:image, if it starts with http; else null."""
    page = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    og, card = _meta(page, "property", "og:image"), _meta(page, "name", "twitter:image")
    return F.when(og.startswith("http"), og).when(card.startswith("http"), card)
