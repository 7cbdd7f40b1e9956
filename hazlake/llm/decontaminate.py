"""Documents that hold benchmark items: MinHash containment search, partitioned by size, verified exactly.

An item is contained in a document if at least 80 % of its distinct five-word shingles are in the
document's. A sketch of a long document says nothing about a short item, so both sides are
partitioned by size: items by the power of two their shingle count rounds up to, documents into
windows of twice that size, one starting at every multiple of it. An item's passage lies within a
window of its class, where its share is large: at a containment of 0.8 and the least item of a class
the 64 minwise hashes miss all with a probability below 2 in a million. Items of fewer than five shingles, below the
least class, need all of them at 80 %: they are looked up exactly, by their least shingle. Minima of larger windows are
minima of smaller ones, so all classes cost one pass. Every match of a minimum is checked against the
whole document's shingles.

The benchmark is the query set; it goes to the tasks in blocks of at most ``BLOCK_BYTES`` of text,
as measured before, and every block is searched in all documents.

Defined cases: a text without words holds nothing and is held by nothing; one of fewer than five words has
one shingle, its whole sequence, so an item of one to four words is found as a whole document and not inside a longer one; repeated rows and equal items give a row each; empty tables give no
rows; other columns are not read, and ``clean_documents`` returns them as they came.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hazlake.llm.words import constants, minima, shingle_hashes, slices, word_hashes

SHINGLE = 5
PERCENT = 80
HASHES = 64
BLOCK_BYTES = 16 << 20
LEAST_CLASS = 8
LEAST_SKETCHED = 5


class Index:
    """The items of one block: their shingle sets, and their minwise hashes by size class."""

    def __init__(self, item_ids: list, texts: list):
        by_set: dict[bytes, int] = {}
        self.sets, self.ids = [], []
        hashes, at = shingle_hashes(*word_hashes(pa.array(texts, pa.large_string())), SHINGLE)
        for i, item_id in enumerate(item_ids):
            own = np.unique(hashes[at[i] : at[i + 1]])
            if len(own):
                k = by_set.setdefault(own.tobytes(), len(self.sets))
                if k == len(self.sets):
                    self.sets.append(own)
                    self.ids.append([])
                self.ids[k].append(item_id)
        sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.factors = constants(HASHES, 29)
        #: The least shingles of items too small for a class, in order, their items, and marks of the low bits.
        small = np.flatnonzero(sizes < LEAST_SKETCHED)
        least = np.array([self.sets[i][0] for i in small.tolist()], dtype=np.uint64)
        order = np.argsort(least, kind="stable")
        bits = max(16, int(len(small)).bit_length() + 6)
        marks = np.zeros(1 << bits, dtype=bool)
        marks[least & np.uint64((1 << bits) - 1)] = True
        self.small = (np.uint64((1 << bits) - 1), least[order], small[order], marks)
        signatures = minima(np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64), offsets, self.factors)
        classes = np.maximum(LEAST_CLASS, 2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
        #: By class: [for each hash: values in order, items in that order, marks of the values' low bits].
        self.classes = {}
        for c in np.unique(classes[sizes >= LEAST_SKETCHED]).tolist():
            items = np.flatnonzero((classes == c) & (sizes >= LEAST_SKETCHED))
            bits = max(16, int(len(items)).bit_length() + 6)
            columns = []
            for j in range(HASHES):
                order = np.argsort(signatures[items, j], kind="stable")
                values = signatures[items[order], j]
                marks = np.zeros(1 << bits, dtype=bool)
                marks[values & np.uint32((1 << bits) - 1)] = True
                columns.append((values, items[order], marks))
            self.classes[c] = (np.uint32((1 << bits) - 1), columns)

    def _candidates(self, hashes: np.ndarray, by_text: np.ndarray) -> set[tuple[int, int]]:
        """(text, item set) for every minimum of a window that is an item's, and every shingle that is a small item's least."""
        found: set[tuple[int, int]] = set()
        mask, values, items, marks = self.small
        if len(values) and len(hashes):
            at = np.flatnonzero(marks[hashes & mask])
            first, last = (np.searchsorted(values, hashes[at], side=side) for side in ("left", "right"))
            text = np.searchsorted(by_text, at, side="right") - 1
            for k in np.flatnonzero(last > first).tolist():
                found.update((int(text[k]), i) for i in items[first[k] : last[k]].tolist())
        if not self.classes or not len(hashes):
            return found
        size, largest = min(self.classes), max(self.classes)
        blocks = -(-np.diff(by_text) // size)
        text = np.repeat(np.arange(len(blocks)), blocks)
        number = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = by_text[:-1][text] + number * size
        least = minima(hashes, np.append(starts, len(hashes)), self.factors)
        while True:
            beside = np.flatnonzero(text[1:] == text[:-1])
            if size in self.classes:
                windows = least.copy()
                windows[beside] = np.minimum(least[beside], least[beside + 1])
                mask, columns = self.classes[size]
                for j, (values, items, marks) in enumerate(columns):
                    own = windows[:, j]
                    at = np.flatnonzero(marks[own & mask])
                    first, last = (np.searchsorted(values, own[at], side=side) for side in ("left", "right"))
                    for k in np.flatnonzero(last > first).tolist():
                        found.update((int(text[at[k]]), i) for i in items[first[k] : last[k]].tolist())
            if size >= largest:
                return found
            even = np.flatnonzero(number % 2 == 0)
            joined = least[even]
            has = np.flatnonzero(np.append(text[1:] == text[:-1], False)[even])
            joined[has] = np.minimum(joined[has], least[even[has] + 1])
            least, text, number, size = joined, text[even], number[even] // 2, size * 2

    def search(self, texts: pa.Array) -> Iterator[tuple[int, int, int]]:
        """(position of the text, item set, shared shingles) of all that pass the exact test."""
        for first, some in slices(texts):
            hashes, by_text = shingle_hashes(*word_hashes(some), SHINGLE)
            last, own = -1, None
            for text, item in sorted(self._candidates(hashes, by_text)):
                if text != last:
                    last, own = text, np.unique(hashes[by_text[text] : by_text[text + 1]])
                held = self.sets[item]
                shared = int((own[np.minimum(np.searchsorted(own, held), len(own) - 1)] == held).sum())
                if 100 * shared >= PERCENT * len(held):
                    yield first + text, item, shared


def _blocks(items: DataFrame) -> Iterator[Index]:
    """Indexes of the benchmark's rows, block by block; a block's size is measured before it is fetched."""
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = 1 + size // BLOCK_BYTES
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        rows = part.collect()
        yield Index([r["item_id"] for r in rows], [r["text"] for r in rows])


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of (doc_id, text) against (item_id, text)."""
    spark = docs.sparkSession
    item_type = items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {item_type}, n_item long, n_shared long"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    result = None
    for index in _blocks(items):
        shared_index = spark.sparkContext.broadcast(index)

        def search(batches, held=shared_index):
            index = held.value
            for batch in batches:
                at, item_ids, sizes, shared = [], [], [], []
                for text, item, n in index.search(batch.column("text")):
                    for item_id in index.ids[item]:
                        at.append(text), item_ids.append(item_id), sizes.append(len(index.sets[item])), shared.append(n)
                if at:
                    doc_ids = batch.column("doc_id").take(pa.array(at))
                    columns = [doc_ids, pa.array(item_ids), pa.array(sizes, pa.int64()), pa.array(shared, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "n_item", "n_shared"])

        found = rows.mapInArrow(search, schema)
        result = found if result is None else result.unionByName(found)
    return result.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item; one pass over them per block of items, nothing shuffled."""
    spark = docs.sparkSession
    for index in _blocks(items):
        shared_index = spark.sparkContext.broadcast(index)

        def keep(batches, held=shared_index):
            for batch in batches:
                clean = np.ones(len(batch), dtype=bool)
                clean[[i for i, _, _ in held.value.search(batch.column(text))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
