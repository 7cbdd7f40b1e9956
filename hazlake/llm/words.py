"""Words and word shingles of many texts at once, as 64-bit hashes.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. All
work is on whole numpy arrays, a slice of about a megabyte of text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
#: Which bytes are inside a word: all but white space; letters; letters and digits. Bytes beyond ASCII count as letters.
WORD, LETTERS, ALPHANUMERIC = np.ones(256, dtype=bool), np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
for first, last in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    LETTERS[first:last] = ALPHANUMERIC[first:last] = True
ALPHANUMERIC[0x30:0x3A] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, dtype=np.uint64), _INVERSE: np.ones(1, dtype=np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    """base to the powers 0 .. n, modulo 2**64."""
    have = _powers[base]
    if len(have) <= n:
        have = np.full(max(n, SLICE_BYTES) + 1, base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(position of the first text, consecutive texts of about ``limit`` bytes together)."""
    texts = texts.cast(pa.large_binary())
    ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64))
    first, n = 0, len(texts)
    while first < n:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield first, texts.slice(first, last - first)
        first = last


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes one after the other, n + 1 offsets); a null has none."""
    texts = pa.compute.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return body, at - at[0]


def word_spans(body: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, n + 1 offsets into them by text) of the words."""
    inside = kind[body]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(body))]
    begins[cut] = inside[cut]
    stops[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _LOWER) -> np.ndarray:
    """Hash of every span of the bytes; ``values`` gives each byte's number, by default one for both cases."""
    n = len(body)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values[body] * _power(_BASE, n)[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * _power(_INVERSE, n)[starts])


def word_hashes(texts: pa.Array, kind: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, n + 1 offsets into them by text)."""
    body, offsets = joined_bytes(texts)
    if not len(body):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    starts, ends, by_text = word_spans(body, offsets, kind)
    return span_hashes(body, starts, ends), by_text


def shingle_hashes(words: np.ndarray, by_text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``size`` words, offsets by text).

    A text with fewer words has one shingle, its whole sequence; one without words has none.
    """
    factors = constants(size, 17)
    counts = np.diff(by_text)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_at = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(out_at[-1], dtype=np.uint64)
    enough = np.repeat(counts >= size, made)
    first = np.arange(out_at[-1]) - np.repeat(out_at[:-1], made) + np.repeat(by_text[:-1], made)
    whole = first[enough]
    run = np.zeros(len(whole), dtype=np.uint64)
    for j in range(size):
        run += words[whole + j] * factors[j]
    out[enough] = run
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        part = words[by_text[i] : by_text[i + 1]]
        out[out_at[i]] = (part * factors[: len(part)]).sum(dtype=np.uint64) + np.uint64(len(part))
    return mix(out), out_at


def minima(hashes: np.ndarray, by_text: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minwise hashes, one row per text that has a shingle and one column per factor, as 32-bit values."""
    have = by_text[:-1][np.diff(by_text) > 0]
    out = np.empty((len(have), len(factors)), dtype=np.uint32)
    if len(have):
        for j, factor in enumerate(factors):
            out[:, j] = np.minimum.reduceat(((hashes * factor) >> np.uint64(32)).astype(np.uint32), have)
    return out
