"""Token ids in files compressed by a grammar of frequent pairs (Re-Pair), readable at any point.

Documents are sorted by id over all tasks and cut into shards of about a million ids. In a
shard frequent pairs of neighbouring symbols become nonterminals, most frequent ones first, a
group of similar frequency per round, until pairs that occur often enough to pay for their rules
would shorten the shard by less than a hundredth. A shard holds its rules, the length each symbol expands to, and every document's symbols, so any
span of ids is found by lengths alone and only its symbols are expanded.

A shard is one row (part, block, n_docs, n_ids, grammar) of a Parquet folder, so that Spark
commits files whole and a lost executor costs a rerun of its tasks.

Defined cases: a null or empty text is the end id alone; repeated rows are written once each, side
by side; an empty table gives no shard; other columns of the input are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hazlake.llm.tokens import encoder, gather
from hazlake.session import arrow_batches

SHARD_IDS = 1 << 20
BATCH_BYTES = 8 << 20
LEAST_PAIRS = 8
LEAST_GAIN = 0.01
TABLE_BITS = 18
MAGIC = b"RPS1"


@dataclass
class Grammar:
    """``base``: ids of the first symbols; ``rules``: pairs of earlier symbols; ``rounds``: rules made per round."""

    base: np.ndarray
    rules: np.ndarray
    rounds: np.ndarray
    symbols: np.ndarray
    starts: np.ndarray  # of the documents in ``symbols``, and the end
    lengths: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.lengths = np.ones(len(self.base) + len(self.rules), dtype=np.int64)
        at = len(self.base)
        for made in self.rounds.tolist():
            of = self.rules[at - len(self.base) : at - len(self.base) + made]
            self.lengths[at : at + made] = self.lengths[of[:, 0]] + self.lengths[of[:, 1]]
            at += made

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that symbols stand for."""
        if not hasattr(self, "_pool"):
            # Expansions of all symbols, one after the other; those of a round only need earlier ones.
            pool, begins, at = [self.base.astype(np.uint32)], np.zeros(len(self.lengths), dtype=np.int64), len(self.base)
            begins[:] = np.cumsum(self.lengths) - self.lengths
            for made in self.rounds.tolist():
                both = self.rules[at - len(self.base) : at - len(self.base) + made].ravel()
                so_far = np.concatenate(pool)
                pool = [so_far, so_far[gather(begins[both], self.lengths[both])]]
                at += made
            self._pool, self._begins = np.concatenate(pool), begins
        return self._pool[gather(self._begins[symbols], self.lengths[symbols])]

    def span(self, document: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of a document; expands only the symbols that hold them."""
        own = self.symbols[self.starts[document] : self.starts[document + 1]]
        ends = np.cumsum(self.lengths[own])
        first = int(np.searchsorted(ends, start, side="right"))
        last = int(np.searchsorted(ends, stop, side="left")) + 1
        skipped = int(ends[first - 1]) if first else 0
        return self.expand(own[first:last])[start - skipped : stop - skipped]

    def to_bytes(self) -> bytes:
        counts = (len(self.base), len(self.rules), len(self.rounds), len(self.symbols), len(self.starts))
        wide = self.symbols.astype("<u4").view(np.uint8).reshape(-1, 4)
        width = 4 if len(self.lengths) > 1 << 24 else 3
        arrays = (self.base, self.rules, self.rounds, self.starts)
        body = b"".join([a.astype("<u4").tobytes() for a in arrays] + [wide[:, :width].tobytes()])
        return MAGIC + struct.pack("<6I", *counts, width) + body

    @classmethod
    def from_bytes(cls, data: bytes) -> "Grammar":
        if data[:4] != MAGIC:
            raise ValueError("not a shard of this format")
        *counts, width = struct.unpack_from("<6I", data, 4)
        n_base, n_rules, n_rounds, n_symbols, n_starts = counts
        at, arrays = 28, []
        for n in (n_base, 2 * n_rules, n_rounds, n_starts):
            arrays.append(np.frombuffer(data, "<u4", n, at).astype(np.int64))
            at += 4 * n
        wide = np.zeros((n_symbols, 4), dtype=np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, n_symbols * width, at).reshape(-1, width)
        base, rules, rounds, starts = arrays
        return cls(base, rules.reshape(-1, 2), rounds, wide.view("<u4").ravel().astype(np.int64), starts)


def _renumbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct ids, number of each id), by a table as large as the largest id."""
    seen = np.bincount(ids) > 0 if len(ids) else np.zeros(0, dtype=bool)
    return np.flatnonzero(seen), (np.cumsum(seen, dtype=np.uint32) - np.uint32(1))[ids]


def _pair_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct keys, how often each occurs); sorts ``keys`` in place."""
    keys.sort()
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else np.zeros(1, int)
    return keys[edges[:-1]], np.diff(edges)


def compress(ids: np.ndarray, offsets: np.ndarray, least: int = LEAST_PAIRS) -> Grammar:
    """The grammar of documents given one after the other with n + 1 offsets; no rule spans two of them."""
    base, symbols = _renumbered(ids)
    opens = np.zeros(len(symbols) + 1, dtype=bool)
    opens[offsets] = True
    opens = opens[:-1]
    rules, rounds, known, ceiling = [], [], len(base), None
    factor, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - TABLE_BITS)
    while len(symbols) > 1:
        keys = symbols[:-1].astype(np.uint64)
        keys <<= np.uint64(32)
        keys |= symbols[1:]
        place = keys * factor
        place >>= shift
        place = place.view(np.int64)
        inside = ~opens[1:]
        if ceiling is None:
            found, counts = _pair_counts(keys[inside])
        else:
            # A place of the hash that holds too few keys has no pair frequent enough; those keys are not sorted. What is
            # frequent enough is known before the counts unless all are below the ceiling.
            held = np.bincount(place, minlength=1 << TABLE_BITS)
            found, counts = _pair_counts(keys[np.flatnonzero((held >= max(least, ceiling // 8))[place] & inside)])
            if ceiling // 8 > least and (not len(counts) or counts.max() < ceiling):
                found, counts = _pair_counts(keys[np.flatnonzero((held >= least)[place] & inside)])
        if not len(counts) or counts.max() < least:
            break
        ceiling = int(counts.max()) if ceiling is None else min(ceiling, int(counts.max()))
        threshold = max(least, ceiling // 8)
        chosen = np.flatnonzero(counts >= threshold)
        chosen = chosen[np.argsort(counts[chosen], kind="stable")]  # rarest first: a frequent pair keeps its table place
        pairs = found[chosen]
        table = np.full(1 << TABLE_BITS, -1, dtype=np.int32)
        table[((pairs * factor) >> shift).astype(np.int64)] = np.arange(len(pairs), dtype=np.int32)
        # One place more at both ends, for the neighbours of the first and the last.
        padded = np.full(len(keys) + 2, -1, dtype=np.int32)
        rank = padded[1:-1]
        rank[:] = table[place]
        at = np.flatnonzero(rank >= 0)
        own = rank[at]
        meant = (pairs[own] == keys[at]) & ~opens[at + 1]
        rank[at[np.flatnonzero(~meant)]] = -1
        # A place is replaced if its pair is more frequent than those that overlap it; of equal ones in a row, every other.
        meant = np.flatnonzero(meant)
        at, own = at[meant], own[meant]
        beside = np.concatenate([[False], (at[1:] == at[:-1] + 1) & (own[1:] == own[:-1]), [False]])
        run = np.flatnonzero(~beside[:-1])
        odd = (at - at[run][np.cumsum(~beside[:-1]) - 1]) & 1 if len(at) else at
        left, right = padded[at], padded[at + 2]
        taken = np.flatnonzero((odd == 0) & (beside[:-1] | (own > left)) & (beside[1:] | (own > right)))
        at, own = at[taken], own[taken]
        used = np.bincount(own, minlength=len(pairs))
        paying = np.flatnonzero(used >= least)
        ceiling, last = threshold, threshold == least and used[paying].sum() < LEAST_GAIN * len(symbols)
        if last:
            break
        if not len(paying):
            continue
        paying = paying[::-1]
        name = np.full(len(pairs), -1, dtype=np.int64)
        name[paying] = known + np.arange(len(paying))
        own = name[own]
        taken = np.flatnonzero(own >= 0)
        at = at[taken]
        symbols[at] = own[taken]
        stay = np.ones(len(symbols), dtype=bool)
        stay[at + 1] = False
        stay = np.flatnonzero(stay)
        symbols, opens = symbols[stay], opens[stay]
        rules.append(np.stack([pairs[paying] >> np.uint64(32), pairs[paying] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.int64))
        rounds.append(len(paying))
        known += len(paying)
    # A document without ids begins where the next one does.
    begins = np.append(np.flatnonzero(opens), len(symbols))
    starts = begins[np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])]
    made = np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64)
    return Grammar(base.astype(np.int64), made, np.array(rounds, dtype=np.int64), symbols.astype(np.int64), starts.astype(np.int64))


_SHARDS = "part int, block int, n_ids long, doc_ids array<long>, grammar binary"


def _shard_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int, shard_ids: int) -> Iterator[pa.RecordBatch]:
    encode, part, block = encoder(path).encode, TaskContext.get().partitionId(), 0

    def shard(doc_ids, ids, lengths):
        nonlocal block
        ids, offsets = np.concatenate(ids), np.concatenate([[0], np.cumsum(lengths)])
        row = [[part], [block], [len(ids)], [doc_ids], [compress(ids, offsets).to_bytes()]]
        block += 1
        types = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["part", "block", "n_ids", "doc_ids", "grammar"])

    doc_ids, held, lengths, n = [], [], [], 0
    for batch in batches:
        ids, offsets = encode(batch.column("text"))
        for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            own = np.append(ids[offsets[i] : offsets[i + 1]], np.uint32(end_id))
            if n and n + len(own) > shard_ids:
                yield shard(doc_ids, held, lengths)
                doc_ids, held, lengths, n = [], [], [], 0
            doc_ids.append(doc_id)
            held.append(own)
            lengths.append(len(own))
            n += len(own)
    if doc_ids:
        yield shard(doc_ids, held, lengths)


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int = 2, shard_ids: int = SHARD_IDS) -> None:
    """Write the ids of (doc_id, text) in ascending doc_id order as grammar shards under ``folder``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("tie", F.xxhash64("text"))
    in_order = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    shards = in_order.mapInArrow(lambda batches: _shard_batches(batches, path, end_id, shard_ids), _SHARDS)
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        shards.write.parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards with ``start``, the number of ids before each."""
    shards = spark.read.parquet(folder)
    sizes = shards.select("part", "block", "n_ids")
    # Parts are tasks of the writing job, so their totals are few rows; blocks are counted within their part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("part").agg(F.sum("n_ids").alias("total"))
    totals = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(totals, "part")
    return firsts.select("part", "block", (F.col("base") + F.col("inside")).alias("first"))


_DOCUMENTS = "part int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long"


def _document_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            grammar = Grammar.from_bytes(row["grammar"])
            lengths = np.concatenate([[0], np.cumsum(grammar.lengths[grammar.symbols])])
            at = lengths[grammar.starts]
            data = grammar.expand(grammar.symbols).astype("<u4").tobytes()
            crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            n = len(crcs)
            columns = [[row["part"]] * n, [row["block"]] * n, row["doc_ids"], at[:-1], np.diff(at), crcs]
            types = (pa.int32(), pa.int32(), *[pa.int64()] * 4)
            names = [c.split()[0] for c in _DOCUMENTS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards."""
    rows = spark.read.parquet(folder).select("part", "block", "doc_ids", "grammar").mapInArrow(_document_batches, _DOCUMENTS)
    joined = rows.join(read_shards(spark, folder), ["part", "block"])
    return joined.select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
