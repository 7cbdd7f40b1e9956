"""Token ids of many texts, as the tokenizers library gives them.

Texts are cut before every ASCII white space that follows anything else, and between a
letter and ASCII punctuation other than an apostrophe. Both vocabularies end a piece
there whatever comes before, so the ids of the parts, one after the other, are the ids
of the whole text. Parts repeat a lot: each distinct one is encoded by the library once
while it stays in a worker's cache, many per call, and the rest is array work. Words with white
space before them follow each other in a call as they do in a text, and the vocabulary shows
which id ends each; other parts have a special token between them.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa

from hazlake.llm.words import joined_bytes, slices

CACHE_PARTS = 400_000
SLICE_BYTES = 4 << 20
PARTS_A_CALL = 64


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file ``name`` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: What a byte is: ASCII white space, a letter, or punctuation other than an apostrophe.
_SPACE, _LETTER, _MARK = 1, 2, 4
_KIND = bytearray(256)
for _byte in range(0x7F):
    if _byte in b" \t\n\v\f\r":
        _KIND[_byte] = _SPACE
    elif chr(_byte).isalpha():
        _KIND[_byte] = _LETTER
    elif 0x20 < _byte and not chr(_byte).isalnum() and chr(_byte) != "'":
        _KIND[_byte] = _MARK


def _after_wide_space(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which positions follow a white-space character outside ASCII (UTF-8, two or three bytes)."""
    a, b, c = (body[np.maximum(at - k, 0)] for k in (3, 2, 1))
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    narrow = (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    three = ((a == 0xE2) & (narrow | ((b == 0x81) & (c == 0x9F)))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
    return two | three | ((a == 0xE3) & (b == 0x80) & (c == 0x80))


def parts(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(the parts of all texts, dictionary-encoded; n + 1 offsets into them by text)."""
    body, offsets = joined_bytes(texts)
    if not len(body):
        return pa.array([], pa.large_binary()).dictionary_encode(), np.zeros(len(texts) + 1, dtype=np.int64)
    data = body.tobytes()
    kind = np.frombuffer(data.translate(_KIND), dtype=np.uint8)
    space = kind == _SPACE
    cut = np.zeros(len(body), dtype=bool)
    cut[1:] = space[1:] & ~space[:-1]
    at = np.flatnonzero(cut)
    after = at[body[at - 1] >= 0x80]
    cut[after[_after_wide_space(body, after)]] = False
    if b"<|" not in data:  # a special token's string must stay whole
        ascii_letter, mark = kind == _LETTER, kind == _MARK
        letter = ascii_letter.copy()
        latin = body[1:] >= 0x80  # the second byte of a Latin letter, as in the two-byte characters from U+00C0
        latin &= (body[:-1] == 0xC3) & (body[1:] != 0x97) & (body[1:] != 0xB7)
        letter[1:] |= latin
        cut[1:] |= (letter[:-1] & mark[1:]) | (mark[:-1] & ascii_letter[1:])
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts, len(body)).astype(np.int64)
    units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(body)])
    return units.dictionary_encode(), np.searchsorted(starts, offsets)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start .. start + length - 1 of every run, one run after the other."""
    ends = np.cumsum(lengths)
    out = np.repeat(starts - (ends - lengths), lengths)
    out += np.arange(len(out))
    return out


class _Known:
    """Ids of distinct parts: ``slots`` numbers the parts, whose ids lie one after the other in ``pool``; ``met`` marks those seen again."""

    def __init__(self):
        self.slots: dict[bytes, int] = {}
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.starts, self.lengths = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
        self.met = np.zeros(1 << 14, dtype=bool)
        self.used = 0

    def add(self, units: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The numbers of the parts."""
        at, end = len(self.slots), self.used + len(ids)
        while len(self.pool) < end:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.starts) < at + len(units):
            self.starts, self.lengths, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths, self.met))
        self.pool[self.used : end] = ids
        self.starts[at : at + len(units)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[at : at + len(units)] = lengths
        self.slots.update(zip(units, range(at, at + len(units))))
        self.used = end
        return np.arange(at, at + len(units))

    def only_met(self) -> "_Known":
        """The parts that were seen again, all unmarked."""
        met, kept = self.met[: len(self.slots)], _Known()
        kept.add(list(compress(self.slots, met.tolist())), *self.ids(np.flatnonzero(met)))
        return kept

    def ids(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the parts one after the other, how many each has)."""
        lengths = self.lengths[slots]
        return self.pool[gather(self.starts[slots], lengths)], lengths


def _separator(library) -> tuple[str, int] | None:
    """(text, id) of a special token that splits whatever it stands between, and shares no end with another added token."""
    added = library.get_added_tokens_decoder()
    for number, token in added.items():
        text = token.content
        plain = token.special and not (token.normalized or token.lstrip or token.rstrip or token.single_word)
        shared = any(
            text.endswith(t.content[:k]) or text.startswith(t.content[-k:])
            for t in added.values() for k in range(1, len(t.content) + (t.content != text))
        )
        if plain and not shared:
            return text, number
    return None


def _ends(library) -> tuple[np.ndarray | None, np.ndarray | None]:
    """(whether an id ends a word, None) or (None, bytes an id stands for), as the vocabulary shows one of them; else two None."""
    from tokenizers import pre_tokenizers

    settings = json.loads(library.to_str())
    model, cutter = settings["model"], settings["pre_tokenizer"] or {}
    last = (cutter.get("pretokenizers") or [cutter])[-1]
    if model["type"] != "BPE" or last.get("type") != "ByteLevel" or last["add_prefix_space"] or model.get("continuing_subword_prefix"):
        return None, None
    vocab, suffix = library.get_vocab(with_added_tokens=True), model.get("end_of_word_suffix")
    table = np.zeros(max(vocab.values()) + 1, dtype=bool if suffix else np.int64)
    if suffix and all(byte + suffix in vocab for byte in pre_tokenizers.ByteLevel.alphabet()):
        for token, number in vocab.items():
            table[number] = token.endswith(suffix)
        return table, None
    if not suffix and last is cutter and settings["normalizer"] is None:
        for token, number in vocab.items():
            table[number] = len(token)  # a character of it is a byte of the text
        return None, table
    return None, None


#: One white space and letters: such a part is cut off from what it stands behind and before another such part.
_FOLLOWS = re.compile("[ \t\n\v\f\r][^\\W\\d_İ]+")


class Encoder:
    """Ids of texts. Parts seen lately stay known: when there are more than ``cache_parts``, those not seen again go."""

    def __init__(self, path: str, cache_parts: int = CACHE_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.cache_parts = Tokenizer.from_file(path), cache_parts
        self.new = _Known()
        self.between = _separator(self.library)
        self.closes, self.sizes = _ends(self.library)

    def _counts(self, ids: np.ndarray, texts: list[str]) -> np.ndarray | None:
        """How many ids each of some joined parts has; None if that does not show."""
        if self.closes is not None:
            # Each part has one word at least, so as many ends as parts are one in each.
            ends = np.flatnonzero(self.closes[ids]) + 1
            shown = len(ends) == len(texts) and ends[-1] == len(ids)
        else:
            at, of_parts = np.cumsum(self.sizes[ids]), np.cumsum([len(t.encode()) for t in texts])
            ends = np.searchsorted(at, of_parts) + 1
            shown = at[-1] == of_parts[-1] and (at[ends - 1] == of_parts).all()
        return np.diff(ends, prepend=0) if shown else None

    def _joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of parts one after the other, how many each has); the parts may follow each other."""
        calls = [texts[at : at + PARTS_A_CALL] for at in range(0, len(texts), PARTS_A_CALL)]
        found = [e.ids for e in self.library.encode_batch_fast(list(map("".join, calls)), add_special_tokens=False)]
        ids = np.array(list(chain.from_iterable(found)), dtype=np.uint32)
        counts = self._counts(ids, texts)
        if counts is not None:
            return ids, counts
        if len(calls) == 1:
            return self._by_library(texts)
        # Some part shows no end: only its call is made again.
        out = []
        for some, own in zip(calls, found):
            own = np.array(own, dtype=np.uint32)
            counts = self._counts(own, some)
            out.append((own, counts) if counts is not None else self._by_library(some))
        return np.concatenate([own for own, _ in out]), np.concatenate([counts for _, counts in out])

    def _by_library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the parts one after the other, how many each has)."""
        if self.between and not any(self.between[0] in t for t in texts):
            # The library splits at special tokens before all else, so parts between two of them are encoded one by one.
            mark, number = self.between
            calls = [mark.join(texts[at : at + PARTS_A_CALL]) + mark for at in range(0, len(texts), PARTS_A_CALL)]
            found = self.library.encode_batch_fast(calls, add_special_tokens=False)
            ids = np.array(list(chain.from_iterable(e.ids for e in found)), dtype=np.uint32)
            marks = ids == number
            ends = np.flatnonzero(marks)
            if len(ends) == len(texts):
                return ids[~marks], np.diff(ends, prepend=-1) - 1
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(lengths.sum())), lengths

    def _learn(self, units: list[bytes]) -> np.ndarray:
        """The numbers of parts that were not known, with their ids by the library."""
        slot = np.empty(len(units), dtype=np.int64)
        joins = self.closes is not None or self.sizes is not None
        for first in range(0, len(units), 20_000):
            texts = [u.decode() for u in units[first : first + 20_000]]
            follows = np.fromiter(map(bool, map(_FOLLOWS.fullmatch, texts)), dtype=bool, count=len(texts)) & joins
            for which, by in ((np.flatnonzero(follows), self._joined), (np.flatnonzero(~follows), self._by_library)):
                if len(which):
                    some = [units[first + i] for i in which.tolist()]
                    slot[first + which] = self.new.add(some, *by([texts[i] for i in which.tolist()]))
        return slot

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other as unsigned 32-bit integers, n + 1 offsets); null counts as empty."""
        found, offsets = [], [np.zeros(1, dtype=np.int64)]
        for _, some in slices(texts, SLICE_BYTES):
            coded, by_text = parts(some)
            units = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            if len(self.new.slots) > self.cache_parts:
                self.new = self.new.only_met()
            slot = np.fromiter(map(self.new.slots.get, units, repeat(-1)), dtype=np.int64, count=len(units))
            unknown = slot < 0
            self.new.met[slot[~unknown]] = True
            slot[unknown] = self._learn(list(compress(units, unknown.tolist())))
            ids, lengths = self.new.ids(slot[coded.indices.to_numpy(zero_copy_only=False)] if len(units) else slot)
            found.append(ids)
            offsets.append(np.concatenate([[0], np.cumsum(lengths)])[by_text][1:] + offsets[-1][-1])
        return (np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)), np.concatenate(offsets)


@lru_cache(maxsize=2)
def encoder(path: str, cache_parts: int = CACHE_PARTS) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return Encoder(path, cache_parts)
