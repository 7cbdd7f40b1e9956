"""Media URL rules: relevance, type, local name, size gates."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

from hazlake import taxonomy as tx


_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def url_host(url: Column) -> Column:
    """Lowercased host without user, port or leading ``www.``; '' when there is none.

    Patterns rather than ``parse_url``: that refuses a URL with a blank or a
    stray character in its path, and such links are common on scraped pages.
    """
    authority = F.regexp_extract(url, _AUTHORITY, 1)
    host = F.regexp_extract(F.lower(authority), r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1)
    return F.regexp_replace(host, r"^www\.", "")


def url_path(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(url, _PATH, 1), r";[^/]*$", "")


def is_relevant_url(url: Column, domains=tx.MEDIA_DOMAINS, skip_terms=tx.SKIP_URL_TERMS) -> Column:
    """No furniture term anywhere, and the host is an allowed domain or below one."""
    skip = "(?i)" + "|".join(re.escape(t) for t in skip_terms)
    host = url_host(url)
    allowed = reduce(
        lambda a, b: a | b, [(host == d) | host.endswith("." + d) for d in domains]
    )
    return ~url.rlike(skip) & allowed


def url_extension(url: Column) -> Column:
    """Lowercased suffix of the last path segment, with its dot; '' when there is none."""
    name = F.regexp_extract(url_path(url), r"([^/]*)/*$", 1)
    # A leading dot alone names a hidden file, a trailing dot ends nothing.
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def media_type(url: Column, content_type: Column | None = None) -> Column:
    """image or video from the extension, else from the content type; else null."""
    extension = url_extension(url)
    kind = F.coalesce(content_type, F.lit("")) if content_type is not None else F.lit("")
    return (
        F.when(extension.isin(tx.IMAGE_EXTENSIONS) | kind.contains("image"), "image")
        .when(extension.isin(tx.VIDEO_EXTENSIONS) | kind.contains("video"), "video")
    )


def local_name(url: Column, kind: Column) -> Column:
    """``images/<md5><ext>`` or ``videos/<md5><ext>``."""
    extension = F.coalesce(
        F.nullif(url_extension(url), F.lit("")), F.when(kind == "image", ".jpg").otherwise(".mp4")
    )
    folder = F.when(kind == "image", "images/").otherwise("videos/")
    return F.concat(folder, F.md5(url.cast("binary")), extension)


def passes_size_gate(
    kind: Column, length: Column, width: Column, height: Column,
    max_bytes: int = tx.MAX_FILE_BYTES, min_width: int = tx.MIN_IMAGE_WIDTH, min_height: int = tx.MIN_IMAGE_HEIGHT,
) -> Column:
    """At most ``max_bytes`` (10 MB), and images of known size at least ``min_width`` x ``min_height`` (300 x 200)."""
    known = (F.coalesce(width, F.lit(0)) > 0) & (F.coalesce(height, F.lit(0)) > 0)
    small = (kind == "image") & known & ((width < min_width) | (height < min_height))
    return (length <= max_bytes) & ~small


def _bytes(content: Column, at: Column | int, n: int) -> Column:
    """``n`` bytes from ``at`` (from 1) as one hexadecimal text."""
    return F.hex(F.substring(content, at, n))


def _number(content: Column, at: Column | int, n: int, little: bool = False) -> Column:
    """An unsigned number of ``n`` bytes; null where the content ends before."""
    digits = _bytes(content, at, n)
    if little:
        digits = F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in reversed(range(n))])
    return F.when(F.length(digits) == 2 * n, F.conv(digits, 16, 10).cast("long"))


# Markers of JPEG frames that carry the size; those without a length; those after which no frame comes.
_JPEG_FRAMES = [0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF]
_JPEG_BARE = [0x01, *range(0xD0, 0xD9)]
_JPEG_LAST = [0xD9, 0xDA]
_JPEG_STEPS = 40


def _jpeg_frame(content: Column) -> Column:
    """Place of the frame header's marker; null if there is none. Segments are skipped by their lengths."""
    def step(at: Column, _: Column) -> Column:
        lead, mark = _number(content, at, 1), _number(content, at + 1, 1)
        after = (at + 2 + F.greatest(_number(content, at + 2, 2), F.lit(2))).cast("int")
        return (
            F.when(at.isNull() | (lead != 0xFF) | mark.isNull() | mark.isin(_JPEG_LAST), F.lit(None).cast("int"))
            .when(mark.isin(_JPEG_FRAMES), at)
            .when(mark == 0xFF, at + 1)
            .when(mark.isin(_JPEG_BARE), at + 2)
            .otherwise(after)
        )

    # A segment has 4 bytes at least. Most frames come among the first segments; only where they do not is the rest walked.
    first = F.aggregate(F.sequence(F.lit(1), F.lit(_JPEG_STEPS)), F.lit(3), step)
    found = _number(content, first + 1, 1).isin(_JPEG_FRAMES)
    rest = F.aggregate(F.sequence(F.lit(0), F.floor(F.length(content) / 2).cast("int")), first, step)
    return F.when(first.isNull() | found, first).otherwise(rest)


def image_size(content: Column) -> Column:
    """struct(width, height) from the header of PNG, GIF, JPEG and WebP content; null for any other or a cut header.

    No pixel is decoded.
    """
    def size(width: Column, height: Column) -> Column:
        known = (width > 0) & (height > 0)
        return F.when(known, F.struct(width.cast("int").alias("width"), height.cast("int").alias("height")))

    head, chunk = _bytes(content, 1, 12), _bytes(content, 13, 4)
    webp = head.startswith("52494646") & head.endswith("57454250")
    frame, bits = _jpeg_frame(content), _number(content, 22, 4, little=True)
    return (
        F.when(head.startswith("89504E470D0A1A0A") & (chunk == "49484452"), size(_number(content, 17, 4), _number(content, 21, 4)))
        .when(head.startswith("474946383761") | head.startswith("474946383961"), size(_number(content, 7, 2, True), _number(content, 9, 2, True)))
        .when(head.startswith("FFD8FF"), size(_number(content, frame + 7, 2), _number(content, frame + 5, 2)))
        .when(webp & (chunk == "56503858"), size(_number(content, 25, 3, True) + 1, _number(content, 28, 3, True) + 1))
        .when(webp & (chunk == "56503820"), size(_number(content, 27, 2, True) % 16384, _number(content, 29, 2, True) % 16384))
        .when(webp & (chunk == "5650384C"), size(bits % 16384 + 1, F.floor(bits / 16384) % 16384 + 1))
    )


def size_kb(length: Column) -> Column:
    return F.round(length / 1024, 2)
