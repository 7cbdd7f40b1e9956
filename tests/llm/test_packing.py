"""Packing against the definition, piece by piece."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazlake.llm import packing
from hazlake.llm.tokens import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"


def check_placed(rows, capacity):
    """Gapless from 0 and within the capacity, whatever the order."""
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def test_fullest_is_the_best_subset():
    rng = random.Random(5)
    for _ in range(300):
        counts = {n: rng.randint(1, 2) for n in sorted(rng.sample(range(1, 30), rng.randint(1, 4)), reverse=True)}
        room = rng.randint(0, 60)
        items = [n for n, c in counts.items() for _ in range(c)]
        best = max(s for k in range(len(items) + 1) for c in itertools.combinations(items, k) if (s := sum(c)) <= room)
        taken = dict(packing.fullest(counts, room))
        assert sum(n * c for n, c in taken.items()) == best
        assert all(c <= counts[n] for n, c in taken.items())


def test_plan_places_everything_and_wastes_little():
    rng = random.Random(1)
    counts = {}
    for _ in range(20_000):
        n = min(4096, int(rng.lognormvariate(6, 1)) + 1)
        counts[n] = counts.get(n, 0) + 1
    bins = packing.plan(counts)
    placed = {}
    for times, combination in bins:
        assert sum(n * c for n, c in combination) <= 4096
        for n, c in combination:
            placed[n] = placed.get(n, 0) + c * times
    assert placed == counts
    least = -(-sum(n * c for n, c in counts.items()) // 4096)
    assert sum(t for t, _ in bins) <= least + 1


def test_pack_equals_the_library(spark):
    from tokenizers import Tokenizer

    rng = random.Random(3)
    words = ["the", "Of", "ander", "schön", "año,", "x1", "<|endoftext|>", "don't", " ", "\n"]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 7, 60, 900]))) for _ in range(60)] + [None, "", " ", texts_long()]
    texts += texts[:5]
    rows = list(enumerate(texts))
    got = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(3), PATH, capacity=256).collect()
    library = Tokenizer.from_file(PATH)
    want = set()
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 256)):
            part = ids[start : start + 256]
            want.add((doc_id, piece, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    bins = check_placed(got, 256)
    assert bins <= -(-sum(w[3] for w in want) // 256) + 1


def texts_long():
    return "thing of sch " * 20_000


def test_blocks_rank_like_one(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ROWS", 10)
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("the of and").alias("text"), F.lit(1).alias("rank"))
    got = packing.pack(docs, PATH, capacity=9).collect()
    assert len(got) == 200 and check_placed(got, 9) == 100


def test_repeated_ids_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "the"), (1, "the"), (None, "of"), (None, None)], SCHEMA)
    got = packing.pack(docs, PATH).collect()
    assert len(got) == 4 and check_placed(got, 4096) == 1
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "thing of " * i) for i in range(30)], SCHEMA)
    placed = packing.pack(docs, PATH, capacity=16)
    held = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(docs, placed, PATH, capacity=16).collect()}
    for r in placed.collect():
        part = held[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert zlib.crc32(part) == r["ids_crc32"]


@pytest.mark.parametrize("text", ["", "a", "a b\tc\n d", "x  y", "é, ü!é 3.5e '' 'S"])
def test_parts_join_to_the_text(text):
    import pyarrow as pa

    from hazlake.llm.tokens import parts

    coded, at = parts(pa.array([text, None, text]))
    units = coded.to_pylist()
    assert b"".join(units[at[0] : at[1]]) == text.encode() == b"".join(units[at[2] : at[3]])


def test_arrays_are_made_for_a_few_texts_at_a_time(monkeypatch):
    import pyarrow as pa

    texts = ["", None, "some words here", "x " * 6000, "one more", None]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(6)), "text": pa.array(texts, pa.string())})
    whole = [r for b in packing._piece_batches(iter([batch]), PATH, 1, 4096, True) for r in b.to_pylist()]
    monkeypatch.setattr(packing, "SLICE_BYTES", 16)
    parts = list(packing._piece_batches(iter([batch]), PATH, 1, 4096, True))
    assert len(parts) > 2 and [r for b in parts for r in b.to_pylist()] == whole
    assert [r["doc_id"] for r in whole] == [0, 1, 2, 3, 3, 4, 5]


def test_a_worker_holds_little_beside_its_texts():
    import tracemalloc

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "text": pa.array(["word, other " * 800] * 400, pa.string())})
    list(packing._piece_batches(iter([batch.slice(0, 2)]), PATH, 1, 4096, False))
    tracemalloc.start()
    assert sum(b.num_rows for b in packing._piece_batches(iter([batch]), PATH, 1, 4096, False)) == 400
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * batch.nbytes


def test_texts_go_to_workers_in_small_batches(spark, monkeypatch):
    import pyarrow as pa

    from hazlake import session

    def sizes(df):
        def size(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

        return max(r["n"] for r in df.coalesce(1).mapInArrow(size, "n long").collect())

    docs = spark.range(200).selectExpr("id AS doc_id", "repeat('the of ', 200) AS text")
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(key)
    monkeypatch.setattr(packing, "BATCH_BYTES", 20_000)
    monkeypatch.setattr(packing, "stage", lambda df, name: seen.append(sizes(docs)) or session.stage(df, name))
    assert packing.pack(docs, PATH).count() == 200
    assert seen[0] < 40_000 < sizes(docs)
    assert spark.conf.get(key) == before


def test_words_go_to_the_library_once_and_without_marks(monkeypatch):
    import pyarrow as pa

    class Heard:
        def __init__(self, library):
            self.library, self.texts = library, []

        def encode_batch_fast(self, texts, **options):
            self.texts += texts
            return self.library.encode_batch_fast(texts, **options)

    monkeypatch.setattr(packing, "CACHE_PARTS", 90)
    monkeypatch.setattr(packing, "SLICE_BYTES", 1000)
    encoder = packing.encoder(PATH, 90)
    library = encoder.library
    monkeypatch.setattr(encoder, "library", Heard(library))
    often = " ".join(f"{a}{b}x" for a in "abcdefgh" for b in "abcdefgh")
    texts = [f" {often} y{chr(97 + i)}z é{chr(97 + i)}" for i in range(26)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(26)), "text": texts})
    got = [r for b in packing._piece_batches(iter([batch]), PATH, 1, 4096, False) for r in b.to_pylist()]
    heard = encoder.library.texts
    assert sum(t.count(" aax") for t in heard) == 1 and not any("<|" in t for t in heard)
    for row, text in zip(got, texts, strict=True):
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        assert (row["length"], row["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
