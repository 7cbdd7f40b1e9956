"""Word-pair language model in Elias-Fano tries, one per shard, and the scores of texts under it.

P(w | h) = (c(h w) + MU P(w)) / (c(h) + MU) with P(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)): every pair is smoothed by the
words, the words by an unseen one, and the probabilities after any h sum to 1. Counts come from all training texts.

The trie is keyed by the predicted word, its children by the word before it. Its two levels and the monotone pointers
from words to their children are Elias-Fano coded; children are found by successor search within their word's
range. Smoothed values are stored as 16-bit codes of log10(c(h w) + MU P(w)). The other factor of a pair, 1 / (c(h) + MU), only
needs the count of h, which its own shard has as a word; so a text's score is a sum of what shards find on their own. Tries are
built from pair counts, summed in every task before they are sent; then texts go to the shards once, to be scored. Levels lie in one buffer per shard that is read in place; ``Trie.open`` maps one from a file.

A shard holds about ``SHARD_TOKENS`` training tokens; a word with more than half of that is spread over several by the word
before it. Such words are at most twice as many as shards and known to all. A pair is never spread, so a shard with a frequent
pair holds many more tokens, though few counts; what is looked up in it is dealt by chunk of texts to several groups, each of
which gets the shard's trie. Tasks send shards packed blocks: each
distinct word once, then small numbers.

Defined cases: a null or empty text is the end token alone; a null doc_id counts as an empty one for the split; repeated rows are
scored (and learnt from) one by one; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import mmap
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hazlake.llm.eliasfano import Sequence, encode
from hazlake.llm.words import mix, slices, word_hashes
from hazlake.session import stage

MU = 200.0
SHARD_TOKENS = 1_000_000
CHUNK_BYTES = 2 << 20
HELD_OUT_ONE_IN = 10

END, START = np.uint64(1), np.uint64(2)
_CODES = 65_535
_CONTEXT_BITS = 40


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % HELD_OUT_ONE_IN == 0


def _sent(words: np.ndarray) -> np.ndarray:
    """Words as they are sent and looked up; what stands for the end and the start is no word's."""
    return np.where(words <= START, words + START, words)


def _tokens(batch: pa.RecordBatch, training: bool) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, token offsets, words with ends, words before them) of some texts at a time."""
    doc_ids = batch.column("doc_id").to_pylist()
    texts = batch.column("text")
    if training:
        own = [i for i, d in enumerate(doc_ids) if not held_out(d)]
        doc_ids, texts = [doc_ids[i] for i in own], texts.take(pa.array(own, pa.int64()))
    for first, some in slices(texts, CHUNK_BYTES):
        hashed = [word_hashes(part) for _, part in slices(some)]  # hashing needs many times a slice's bytes
        words = np.concatenate([w for w, _ in hashed])
        n = len(some)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(at) for _, at in hashed]) + 1)])
        tokens = np.full(offsets[-1], END, dtype=np.uint64)
        is_word = np.ones(len(tokens), dtype=bool)
        is_word[offsets[1:] - 1] = False
        tokens[is_word] = _sent(words)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[offsets[:-1]] = START
        yield doc_ids[first : first + n], offsets, tokens, before


# -- blocks that tasks send to shards ---------------------------------------------


def _packed(**arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers, byte plane by byte plane, compressed."""
    parts = [struct.pack("<B", len(arrays))]
    for array in arrays.values():
        width = max(1, -(-int(array.max()).bit_length() // 8)) if len(array) else 1
        planes = array.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
        parts.append(struct.pack("<QB", len(array), width) + planes.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpacked(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 1
    for _ in range(data[0]):
        n, width = struct.unpack_from("<QB", data, at)
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 9).reshape(width, n).T
        out.append(wide.view("<u8").ravel())
        at += 9 + n * width
    return out


def _context(before: np.ndarray) -> np.ndarray:
    """The part of a word that the trie's second level keeps of it."""
    return before >> np.uint64(64 - _CONTEXT_BITS)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(differences of the ascending distinct values, number of each value)."""
    distinct, number = np.unique(values, return_inverse=True)
    return np.diff(distinct, prepend=np.uint64(0)), number


class Shards:
    """Which shard a pair belongs to; ``hot``: {word: count} of the words that are spread."""

    def __init__(self, n: int, tokens: int, hot: dict[int, int]):
        self.n = n
        self.words = np.array(sorted(hot), dtype=np.uint64)
        self.counts = np.array([hot[w] for w in self.words.tolist()], dtype=np.int64)
        share = self.counts / max(tokens, 1)
        self.spread = np.minimum(n, np.ceil(2 * n * share)).astype(np.uint64)

    def count(self, words: np.ndarray) -> np.ndarray:
        """Training count of spread words, -1 of others."""
        if not len(self.words):
            return np.full(len(words), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.counts[at], -1)

    def of(self, words: np.ndarray, before: np.ndarray) -> np.ndarray:
        shard = mix(words)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            spread = np.where(self.words[at] == words, self.spread[at], np.uint64(1))
            shard = shard + mix(before ^ np.uint64(0xA5A5A5A5)) % spread
        return (shard % np.uint64(self.n)).astype(np.int64)


# -- the model -----------------------------------------------------------------------


class Trie:
    """One shard: words, pointers, children, counts and codes, read in place from a buffer."""

    HEAD = struct.Struct("<4sQdd")

    def __init__(self, buffer):
        magic, n_words, self.low, self.step = self.HEAD.unpack_from(buffer, 0)
        if magic != b"EFN1":
            raise ValueError("not a shard of this format")
        self.words = Sequence(buffer, self.HEAD.size)
        self.pointers = Sequence(buffer, self.words.end)
        self.children = Sequence(buffer, self.pointers.end)
        self.counts = np.frombuffer(buffer, "<i8", n_words, self.children.end)
        self.codes = np.frombuffer(buffer, "<u2", self.children.n, self.children.end + 8 * n_words)

    @classmethod
    def open(cls, path: str) -> "Trie":
        """The trie in a file, mapped."""
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    @classmethod
    def to_bytes(cls, words: np.ndarray, counts: np.ndarray, parent: np.ndarray, context: np.ndarray, often: np.ndarray, unit: float, mu: float) -> bytes:
        """From ascending words with their counts, and pairs (number of the word, context, count); ``unit``: probability of a count of 1."""
        key, number = np.unique((parent.astype(np.uint64) << np.uint64(_CONTEXT_BITS)) | context, return_inverse=True)
        often = np.bincount(number, weights=often, minlength=len(key))
        owner = (key >> np.uint64(_CONTEXT_BITS)).astype(np.int64)
        value = np.log10(often + mu * unit * (counts[owner] + 0.1))
        low = float(value.min()) if len(value) else 0.0
        step = max((float(value.max()) - low) / _CODES, 1e-9) if len(value) else 1.0
        codes = np.rint((value - low) / step).astype("<u2")
        pointers = np.searchsorted(owner, np.arange(len(words) + 1))
        levels = encode(words) + encode(pointers) + encode(key)
        return cls.HEAD.pack(b"EFN1", len(words), low, step) + levels + counts.astype("<i8").tobytes() + codes.tobytes()

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, training count) of words; a count of 0 where a word is unknown."""
        at, known = self.words.successor(words)
        at = np.where(known, at, 0)
        return at, np.where(known, self.counts[at], 0) if len(self.counts) else np.zeros(len(words), dtype=np.int64)

    def seen(self, number: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether the pair was seen, log10(c + MU P) where it was), for known words by number."""
        key = (number.astype(np.uint64) << np.uint64(_CONTEXT_BITS)) | context
        at, found = self.children.successor(key)
        # The successor lies within the word's range of children, or the pair was not seen.
        index = np.minimum(at, self.children.n - 1)
        inside = found & (at >= self.pointers.values(number).astype(np.int64)) & (at < self.pointers.values(number + 1).astype(np.int64))
        return inside, self.low + self.codes[index] * self.step


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, tokens, _ in _tokens(batch, True):
            words, counts = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])


class Vocabulary:
    """What all tasks need to know of a corpus: training tokens, types and texts, and how words are spread."""

    def __init__(self, shards: Shards, tokens: int, types: int, texts: int, mu: float):
        self.shards, self.tokens, self.texts, self.mu = shards, tokens, texts, mu
        #: Base probability that one count is worth.
        self.unit = 1.0 / (tokens + 0.1 * (types + 1))

    def trie(self, words: np.ndarray, contexts: np.ndarray, often: np.ndarray) -> bytes:
        """The shard of these training pairs."""
        distinct, parent = np.unique(words, return_inverse=True)
        counts = np.bincount(parent, weights=often, minlength=len(distinct)).astype(np.int64)
        spread = self.shards.count(distinct)
        return Trie.to_bytes(distinct, np.where(spread >= 0, spread, counts), parent, contexts, often, self.unit, self.mu)

    def look_up(self, trie: Trie | None, block: bytes) -> bytes:
        """Per text of a block with tokens of this shard: tokens, known tokens, base score and score."""
        w, word, h, context, document = _unpacked(block)
        words, word, document = np.cumsum(w), word.astype(np.int64), np.cumsum(document).astype(np.int64)
        context = np.cumsum(h)[context.astype(np.int64)]
        number, count = trie.find(words) if trie else (np.zeros(len(words), np.int64), np.zeros(len(words), np.int64))
        here = count > 0
        spread = self.shards.count(words)
        count = np.where(spread >= 0, spread, count)
        base = np.log10((count + 0.1) * self.unit)
        value = np.log10(self.mu) + base[word]
        known = np.flatnonzero(here[word])
        if len(known):
            hit, stored = trie.seen(number[word[known]], context[known])
            value[known[hit]] = stored[hit]
        # As the word before the next one, a word divides by its count; the end stands before nothing.
        value -= np.where(words == END, 0.0, np.log10(count + self.mu))[word]
        rows, place = np.unique(document, return_inverse=True)
        sums = b"".join(np.bincount(place, weights=x).astype("<f8").tobytes() for x in (base[word], value))
        head = _packed(rows=rows, n=np.bincount(place), known=np.bincount(place, weights=(count > 0)[word]).astype(np.int64))
        return struct.pack("<II", len(head), len(rows)) + head + sums


class Model:
    """A trained model: ``table`` (shard, trie, tokens) in the shared folder, and the vocabulary."""

    def __init__(self, table: DataFrame, vocabulary: Vocabulary):
        self.table, self.vocabulary = table, vocabulary

    def parts(self) -> dict[int, int]:
        """Among how many groups the tokens of a shard are dealt; only shards with more than twice the mean, so less than half of all."""
        v = self.vocabulary
        large = self.table.filter(F.col("tokens") * v.shards.n > 2 * v.tokens).select("shard", "tokens")
        return {r["shard"]: 1 + r["tokens"] * v.shards.n // (2 * v.tokens) for r in large.collect()}


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def vocabulary(docs: DataFrame, mu: float = MU, shard_tokens: int = SHARD_TOKENS) -> Vocabulary:
    """Count the words of the training documents."""
    counts = stage(_rows(docs).mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    texts = F.coalesce(F.sum(F.when(F.col("word") == int(END), F.col("n"))), F.lit(0))
    tokens, types, texts = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), texts).first()
    n = 1 + tokens // shard_tokens
    # At most 2 n words have more than a share of 1 / (2 n).
    hot = {} if n == 1 else {r["word"] % (1 << 64): r["n"] for r in counts.filter(F.col("n") * (2 * n) > tokens).collect()}
    return Vocabulary(Shards(n, tokens, hot), tokens, types, texts, mu)


def _edges(shard: np.ndarray) -> list[tuple[int, int]]:
    edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
    return list(zip(edges, edges[1:])) if len(shard) else []


def train(docs: DataFrame, mu: float = MU, shard_tokens: int = SHARD_TOKENS) -> Model:
    """Learn from the documents of (doc_id, text) that are not held out."""
    known = vocabulary(docs, mu, shard_tokens)

    def pairs(batches):
        for batch in batches:
            for _, _, tokens, before in _tokens(batch, True):
                shard, context = known.shards.of(tokens, before), _context(before)
                order = np.lexsort((context, tokens, shard))
                shard, tokens, context = shard[order], tokens[order], context[order]
                at = np.flatnonzero(np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (context[1:] != context[:-1])]))
                often = np.diff(np.append(at, len(tokens)))
                shard, tokens, context = shard[at], tokens[at], context[at]
                ids, blocks = [], []
                for a, b in _edges(shard):
                    w, word = _numbered(tokens[a:b])
                    h, number = _numbered(context[a:b])
                    ids.append(int(shard[a]))
                    blocks.append(_packed(w=w, word=np.diff(word, prepend=0), h=h, context=number, often=often[a:b]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blocks, pa.binary())], ["shard", "block"])

    def build(group: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for block in group["block"]:
            w, word, h, context, often = _unpacked(block)
            parts.append((np.cumsum(w)[np.cumsum(word).astype(np.int64)], np.cumsum(h)[context.astype(np.int64)], often))
        words, contexts, often = (np.concatenate(x) for x in zip(*parts))
        del parts
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "trie": [known.trie(words, contexts, often)], "tokens": [int(often.sum())]})

    table = _rows(docs).mapInArrow(pairs, "shard long, block binary").groupBy("shard").applyInPandas(build, "shard long, trie binary, tokens long")
    return Model(stage(table, "tries"), known)


def _sent_blocks(docs: DataFrame, known: Vocabulary, parts: dict[int, int]) -> DataFrame:
    """(shard, part, chunk, block): the tokens of some texts, shard by shard, and under a shard below 0 whose they are."""
    def texts(batches):
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for doc_ids, offsets, tokens, before in _tokens(batch, False):
                shard, context = known.shards.of(tokens, before), _context(before)
                document = np.repeat(np.arange(len(doc_ids)), np.diff(offsets))
                order = np.argsort(shard, kind="stable")
                shard, tokens, context, document = shard[order], tokens[order], context[order], document[order]
                ids, blocks = [], []
                for a, b in _edges(shard):
                    w, word = _numbered(tokens[a:b])
                    h, which = _numbered(context[a:b])
                    ids.append(int(shard[a]))
                    blocks.append(_packed(w=w, word=word, h=h, context=which, document=np.diff(document[a:b], prepend=0)))
                ids.append(-1 - (task * 7919 + number) % known.shards.n)
                blocks.append(_packed(
                    ids=np.array([(d or 0) % (1 << 64) for d in doc_ids], dtype=np.uint64), given=np.array([d is not None for d in doc_ids], dtype=np.uint64),
                ))
                chunk = (task << 32) + number
                number += 1
                dealt = int(mix(np.array([chunk], dtype=np.uint64))[0] >> np.uint64(1))
                part = [dealt % parts.get(i, 1) for i in ids]
                columns = [pa.array(ids, pa.int64()), pa.array(part, pa.int64()), pa.array([chunk] * len(ids), pa.int64()), pa.array(blocks, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "part", "chunk", "block"])

    return _rows(docs).mapInArrow(texts, "shard long, part long, chunk long, block binary")


_FOUND = "chunk long, shard long, block binary"


def _looked_up(blocks: pd.DataFrame, trie: Trie | None, known: Vocabulary) -> pd.DataFrame:
    found = [b if s < 0 else known.look_up(trie, b) for s, b in zip(blocks["shard"], blocks["block"])]
    return pd.DataFrame({"chunk": blocks["chunk"], "shard": blocks["shard"], "block": found})


def _summed(found: DataFrame, known: Vocabulary) -> DataFrame:
    """One row per text, from what the shards found of its chunk."""
    tokens, from_start = known.tokens, float(np.log10(known.texts + known.mu))  # every text begins after the start once

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        ids, given = _unpacked(group.loc[group["shard"] < 0, "block"].iloc[0])
        doc_ids = [i if k else None for i, k in zip(ids.view(np.int64).tolist(), given.tolist())]
        n = len(doc_ids)
        total, seen, base, value = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        # In the order of shards, so that sums come out alike every time.
        for block in group[group["shard"] >= 0].sort_values("shard")["block"]:
            head, n_rows = struct.unpack_from("<II", block)
            rows, count, good = (x.astype(np.int64) for x in _unpacked(block[8 : 8 + head]))
            sums = np.frombuffer(block, "<f8", 2 * n_rows, 8 + head)
            total[rows] += count
            seen[rows] += good
            base[rows] += sums[:n_rows]
            value[rows] += sums[n_rows:]
        return pd.DataFrame({
            "doc_id": pd.array(doc_ids, dtype="Int64"), "held_out": [held_out(d) for d in doc_ids], "n_tokens": total, "n_known": seen,
            "train_tokens": tokens, "base_score": base, "score": value - from_start,
        })

    columns = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return found.groupBy("chunk").applyInPandas(gather, columns)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of (doc_id, text)."""
    known, parts = model.vocabulary, model.parts()

    def look_up(blocks: pd.DataFrame, tries: pd.DataFrame) -> pd.DataFrame:
        return _looked_up(blocks, Trie(tries["trie"].iloc[0]) if len(tries) else None, known)

    last = F.when(F.col("tokens") * known.shards.n > 2 * known.tokens, F.expr(f"tokens * {known.shards.n} div {2 * max(known.tokens, 1)}")).otherwise(F.lit(0))
    tries = model.table.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("part"), "trie")
    found = _sent_blocks(docs, known, parts).groupBy("shard", "part").cogroup(tries.groupBy("shard", "part")).applyInPandas(look_up, _FOUND)
    return _summed(found, known)


def train_and_score(docs: DataFrame, mu: float = MU, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``score(docs, train(docs))``."""
    return score(docs, train(docs, mu, shard_tokens))
