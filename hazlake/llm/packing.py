"""Packing token pieces into sequences by minimum bin slack.

A document's ids and one end id are cut into pieces of at most ``capacity`` tokens. Where
pieces go depends on their lengths alone, so the plan is made from the count of every
length: at most ``capacity`` rows, however many documents there are. Per bin, the longest
length left is set first and a subset-sum over the lengths left, held as a bit set, finds
the combination that leaves the least slack; it is taken as often as the counts allow and
removed. Pieces then take the plan's places by their rank within their length. Ranks are
counted in blocks, so a length that a third of all pieces share spreads over many tasks.

Defined cases: a null or empty text is the end id alone; repeated rows are packed once each;
an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hazlake.llm.tokens import encoder, gather
from hazlake.llm.words import slices
from hazlake.session import arrow_batches, stage

CAPACITY = 4096
BLOCK_ROWS = 500
SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
CACHE_PARTS = 250_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


def _cut(ids: np.ndarray, offsets: np.ndarray, end_id: int, capacity: int):
    """(ids with the end ids, and per piece: row, number, start in its document, position, length)."""
    n = np.diff(offsets) + 1
    at = np.concatenate([[0], np.cumsum(n)])
    ends = np.zeros(at[-1], dtype=bool)
    ends[at[1:] - 1] = True
    whole = np.full(at[-1], end_id, dtype="<u4")
    whole[~ends] = ids
    pieces = -(-n // capacity)
    row = np.repeat(np.arange(len(n)), pieces)
    number = gather(np.zeros(len(n), dtype=np.int64), pieces)
    start = number * capacity
    return whole, row, number, start, at[:-1][row] + start, np.minimum(n[row] - start, capacity)


def _piece_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, keep_ids: bool):
    encode = encoder(path, CACHE_PARTS).encode
    # Arrays over ids are many times as large as the texts: they are made for a few texts at a time.
    for batch in (whole.slice(first, len(some)) for whole in batches for first, some in slices(whole.column("text"), SLICE_BYTES)):
        whole, row, number, start, at, length = _cut(*encode(batch.column("text")), end_id, capacity)
        data = memoryview(whole).cast("B")
        spans = [data[4 * a : 4 * (a + n)] for a, n in zip(at.tolist(), length.tolist())]
        columns = [
            batch.column("doc_id").take(pa.array(row)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length),
            pa.array([zlib.crc32(s) for s in spans], pa.int64()),
        ]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if keep_ids:
            columns, names = [*columns, pa.array(spans, pa.binary())], [*names, "ids"]
        yield pa.RecordBatch.from_arrays(columns, names)
        del columns
        pa.default_memory_pool().release_unused()


def pieces_of(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece of (doc_id, text); ``keep_ids`` adds the ids as little-endian 32-bit integers."""
    schema = PIECES + (", ids binary" if keep_ids else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _piece_batches(batches, path, end_id, capacity, keep_ids), schema)


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """[(length, how many)] with the largest sum up to ``room``; ``counts`` in descending order of length."""
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for length, count in counts.items():
        left, part = min(count, room // length), 1
        while left > 0 and not reach >> room & 1:
            part = min(part, left)
            steps.append((length, part, reach))
            reach |= reach << part * length & mask
            left, part = left - part, part * 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, part, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + part
            total -= part * length
    return list(taken.items())


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(number of bins, [(length, how many in each of them)])], every piece in one place."""
    left = {length: n for length, n in sorted(counts.items(), reverse=True) if n}
    bins = []
    while left:
        first = next(iter(left))
        left[first] -= 1
        combination = {first: 1}
        for length, n in fullest(left, capacity - first):
            combination[length] = combination.get(length, 0) + n
        left[first] += 1
        times = min(left[length] // n for length, n in combination.items())
        bins.append((times, list(combination.items())))
        for length, n in combination.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return bins


def _places(bins, capacity: int) -> tuple[np.ndarray, ...]:
    """Per run of places for one length, by (length, first rank): key, first sequence, how many in a bin, first offset."""
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for times, combination in bins:
        offset = 0
        for length, n in combination:
            rank = used.get(length, 0)
            runs.append((length, rank, sequence, n, offset))
            used[length] = rank + n * times
            offset += n * length
        sequence += times
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)
    return (table[:, 0] << 48) + table[:, 1], table[:, 1], table[:, 2], table[:, 3], table[:, 4]


def _ranked(pieces: DataFrame, counts: dict[int, int], capacity: int) -> DataFrame:
    """Add ``rank``, from 0 within a length; block by block, so that no length is one task."""
    blocks = [-(-counts.get(length, 1) // BLOCK_ROWS) for length in range(1, capacity + 1)]
    # One constant array, looked up by position; a join on the length would bring its rows together.
    by_length = F.split(F.lit(",".join(map(str, blocks))), ",").cast("array<bigint>")
    pieces = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.element_at(by_length, F.col("length").cast("int"))))
    sizes = pieces.groupBy("length", "block").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("length", "block", F.coalesce(before, F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32"))
    return pieces.withColumn("rank", within - 1).join(firsts, ["length", "block"]).withColumn("rank", F.col("rank") + F.col("first"))


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of (doc_id, text) with its sequence and its offset there."""
    # Whole batches lie in memory on both sides of a Python worker, beside a heap that earlier stages have filled.
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        pieces = stage(pieces_of(docs, path, end_id, capacity), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    keys, ranks, sequences, each, offsets = _places(plan(counts, capacity), capacity)

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            bin_, slot = np.divmod(rank - ranks[run], each[run])
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequences[run] + bin_), pa.array(offsets[run] + slot * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = _ranked(pieces, counts, capacity)
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long")).mapInArrow(place, PLACED)


def sequences(docs: DataFrame, placed: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids): the packed sequences as little-endian 32-bit ids; needs distinct doc_ids."""
    ids = pieces_of(docs, path, end_id, capacity, keep_ids=True).select("doc_id", "piece", "ids")
    rows = placed.select("doc_id", "piece", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined: Column = F.aggregate(in_order, F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return rows.groupBy("sequence_id").agg(joined.alias("ids"))
