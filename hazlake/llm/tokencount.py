"""Token counts by a finite-state transducer compiled from a byte-level BPE vocabulary.

Inside a piece (a run that the vocabulary's pre-tokenizer gives) the last token of every
prefix is the one suffix that the pair rule allows after the last token of what stands
before it. How a prefix goes on therefore depends only on its longest suffix that begins
some token and on the last tokens and counts at the positions inside that suffix. These
are the transducer's states; a transition reads one byte and emits by how much the count
changes. Transitions are compiled when a text first needs them and kept.

A long text is cut into chunks, each a row of its own. A chunk's state map does not need
the state it starts in: what stands before its first sure boundary (white space after
something else) waits for the chunk before, the middle is counted, and the rest waits for the
chunk after. Maps compose associatively, so the maps of a text are scanned pairwise.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted one
by one; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hazlake.llm.tokens import SLICE_BYTES, parts
from hazlake.llm.words import slices
from hazlake.session import stage

CHUNK_CHARS = 1 << 16
KEPT_TRANSITIONS = 1_000_000
KEPT_PARTS = 500_000
LIMIT = 1024

# White space outside ASCII.
_WIDE = "\x85\xa0  -     　"
_BOUNDARY = re.compile(f"(?<=[^ \t-\r{_WIDE}])(?=[ \t-\r])")

START = -1


class Transducer:
    """Counts tokens of pieces byte by byte."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        model = library.model
        if model.continuing_subword_prefix or model.end_of_word_suffix or model.byte_fallback:
            raise ValueError("a byte-level vocabulary without prefixes and suffixes is needed")
        self.model, self.before, self.normal = model, library.pre_tokenizer, library.normalizer
        self.added = [t.content for t in library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.token = {t: i for t, i in library.get_vocab(with_added_tokens=False).items()}
        self.text = {i: t for t, i in self.token.items()}
        self.begins = {t[:k] for t in self.token for k in range(len(t) + 1)}
        self.allowed: dict[tuple[int, int], bool] = {}
        self.parts: dict[bytes, int] = {}
        self._forget()

    def _forget(self) -> None:
        """Back to the start state alone."""
        # A state: (suffix that begins a token, last token at each position in it, count there less the count at its end).
        start = ("", (START,), (0,))
        self.states, self.ids = [start], {start: 0}
        self.moves: dict[tuple[int, str], tuple[int, int]] = {}

    def may_follow(self, last: int, token: int) -> bool:
        """Do the two tokens' bytes, encoded together, give just these two?"""
        key = (last, token)
        if key not in self.allowed:
            want = [token] if last == START else [last, token]
            joined = "".join(self.text[i] for i in want)
            self.allowed[key] = [t.id for t in self.model.tokenize(joined)] == want
        return self.allowed[key]

    def _compile(self, state: int, byte: str) -> tuple[int, int]:
        suffix, lasts, counts = self.states[state]
        read = suffix + byte
        for at in range(len(read)):
            token = self.token.get(read[at:])
            # Positions before the state's suffix cannot start a token that ends here.
            if token is not None and self.may_follow(lasts[at], token):
                emitted = counts[at] + 1
                break
        else:
            raise ValueError("a byte is missing from the vocabulary")
        keep = next(k for k in range(len(read) + 1) if read[k:] in self.begins)
        counts = tuple(c - emitted for c in counts[keep:]) + (0,)
        new = (read[keep:], lasts[keep:] + (token,), counts)
        if new not in self.ids:
            self.ids[new] = len(self.states)
            self.states.append(new)
        self.moves[state, byte] = move = (self.ids[new], emitted)
        return move

    def piece(self, piece: str) -> int:
        """Tokens of one piece, given as the vocabulary's byte characters."""
        if len(self.moves) > KEPT_TRANSITIONS:
            self._forget()
        state = total = 0
        for byte in piece:
            move = self.moves.get((state, byte)) or self._compile(state, byte)
            state = move[0]
            total += move[1]
        return total

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        text = self.normal.normalize_str(text) if self.normal else text
        return sum(self.piece(p) for p, _ in self.before.pre_tokenize_str(text))

    def count(self, text: str) -> int:
        """Tokens of a text; a special string is one."""
        if self.special is None or not any(s in text for s in self.added):
            return self.plain(text)
        return len(self.special.findall(text)) + sum(self.plain(s) for s in self.special.split(text) if s)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        out = []
        for _, some in slices(texts, SLICE_BYTES):
            coded, by_text = parts(some)
            units = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            if len(self.parts) > KEPT_PARTS:
                self.parts.clear()
            for unit in units:
                if unit not in self.parts:
                    self.parts[unit] = self.count(unit.decode())
            each = np.fromiter(map(self.parts.__getitem__, units), dtype=np.int64, count=len(units))
            each = each[coded.indices.to_numpy(zero_copy_only=False)] if len(units) else each
            total = np.concatenate([[0], np.cumsum(each)])
            out.append(np.diff(total[by_text]))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


@lru_cache(maxsize=1)
def transducer(path: str) -> Transducer:
    return Transducer(path)


@dataclass(frozen=True)
class StateMap:
    """What a chunk does to any state: ``sealed`` chunks hold a sure boundary, others wait as a whole in ``head``."""

    sealed: bool
    head: str
    middle: int
    tail: str

    def then(self, other: "StateMap", count) -> "StateMap":
        if not self.sealed:
            return StateMap(other.sealed, self.head + other.head, other.middle, other.tail)
        if not other.sealed:
            return StateMap(True, self.head, self.middle, self.tail + other.head)
        return StateMap(True, self.head, self.middle + count(self.tail + other.head) + other.middle, other.tail)


def scanned(maps: list[StateMap], count) -> int:
    """Tokens of the chunks together, by pairwise composition."""
    while len(maps) > 1:
        maps = [a.then(b, count) for a, b in zip(maps[::2], maps[1::2])] + maps[len(maps) & ~1 :]
    whole = maps[0]
    return count(whole.head) + whole.middle + count(whole.tail)


def _split(text: str) -> tuple[bool, str, str, str]:
    """(has a boundary, before the first one, between, from the last one)."""
    cuts = [m.start() for m in _BOUNDARY.finditer(text)]
    if not cuts:
        return False, text, "", ""
    return True, text[: cuts[0]], text[cuts[0] : cuts[-1]], text[cuts[-1] :]


_MAPS = "doc_id long, key long, chunk int, chunks int, n_bytes long, sealed boolean, head string, middle long, tail string"


def _map_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    machine = transducer(path)
    for batch in batches:
        texts, chunks = batch.column("text"), batch.column("chunks").to_numpy()
        n = len(texts)
        sealed, heads, tails = [True] * n, [""] * n, [""] * n
        middles = texts
        if (chunks > 1).any():
            held = texts.to_pylist()
            for i in np.flatnonzero(chunks > 1).tolist():
                sealed[i], heads[i], held[i], tails[i] = _split(held[i])
            middles = pa.array(held, pa.large_string())
        columns = [batch.column(c) for c in ("doc_id", "key", "chunk", "chunks", "n_bytes")]
        columns += [pa.array(sealed), pa.array(heads), pa.array(machine.counts(middles)), pa.array(tails)]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _MAPS.split(", ")])


def token_counts(docs: DataFrame, path: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"),
        F.greatest(F.lit(1), F.ceil(F.length("text") / chunk_chars)).cast("int").alias("chunks"),
    )
    chunks = rows.select(
        "*", F.when(F.col("chunks") > 1, F.xxhash64("text")).otherwise(F.lit(0)).alias("key"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    ).withColumn("text", F.when(F.col("chunks") > 1, F.substring("text", F.col("chunk") * chunk_chars + 1, F.lit(chunk_chars))).otherwise(F.col("text")))
    chunks = chunks.select("doc_id", "key", "chunk", "chunks", "n_bytes", "text")
    maps = stage(chunks.mapInArrow(lambda batches: _map_batches(batches, path), _MAPS), "maps")

    def compose(group: pd.DataFrame) -> pd.DataFrame:
        count = transducer(path).count
        copies = int((group["chunk"] == 0).sum())  # repeated rows of one text
        group = group.drop_duplicates("chunk").sort_values("chunk")
        in_order = [StateMap(*m) for m in zip(group["sealed"], group["head"], group["middle"].map(int), group["tail"])]
        first = group.iloc[0]
        row = {"doc_id": first["doc_id"], "n_bytes": first["n_bytes"], "n_tokens": scanned(in_order, count)}
        return pd.DataFrame([row] * copies)

    result = "doc_id long, n_bytes long, n_tokens long"
    short = maps.filter("chunks = 1").select("doc_id", "n_bytes", F.col("middle").alias("n_tokens"))
    return short.unionByName(maps.filter("chunks > 1").groupBy("doc_id", "key").applyInPandas(compose, result))
