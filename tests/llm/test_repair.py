"""Exact round trips through the grammar files."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazlake.llm import repair
from hazlake.llm.tokens import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def offsets_of(lengths):
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


@pytest.mark.parametrize("seed", range(6))
def test_round_trip_and_spans(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 300, 40)
    ids = rng.integers(0, [2, 5, 50, 3, 50_000, 2][seed], lengths.sum()).astype(np.uint32)
    offsets = offsets_of(lengths)
    grammar = repair.Grammar.from_bytes(repair.compress(ids, offsets, least=2).to_bytes())
    assert (grammar.expand(grammar.symbols) == ids).all()
    for d in range(40):
        own = ids[offsets[d] : offsets[d + 1]]
        for _ in range(5):
            a, b = sorted(rng.integers(0, len(own) + 1, 2))
            assert (grammar.span(d, a, b) == own[a:b]).all()


def test_rules_are_made_and_stay_inside_documents():
    ids = np.array([1, 2] * 400, dtype=np.uint32)
    whole = repair.compress(ids, np.array([0, 800]))
    assert len(whole.symbols) < 100 and len(whole.rules) > 1
    single = repair.compress(ids, np.arange(801))
    assert len(single.rules) == 0 and len(single.symbols) == 800


def test_expansion_lengths_hold():
    ids = np.random.default_rng(0).integers(0, 4, 5000).astype(np.uint32)
    grammar = repair.compress(ids, np.array([0, 5000]))
    for symbol in range(len(grammar.lengths)):
        assert len(grammar.expand(np.array([symbol]))) == grammar.lengths[symbol]


def want_of(rows):
    from tokenizers import Tokenizer

    library, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_ids", [repair.SHARD_IDS, 300])
def test_files_hold_the_library_ids(spark, tmp_path, shard_ids):
    rng = random.Random(9)
    words = ["the", " Of", "ander", " schön", "año,", "<|endoftext|>", "\n", "12"]
    rows = [(i * 7 - 50, "".join(rng.choices(words, k=rng.choice([0, 3, 200])))) for i in range(80)] + [(None, None), (1000, "the of " * 9000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("a clash")).repartition(3)
    repair.write_ids(docs, f"{tmp_path}/ids", PATH, shard_ids=shard_ids)
    got = sorted(map(tuple, repair.read_documents(spark, f"{tmp_path}/ids").collect()), key=lambda r: r[1])
    assert got == want_of(rows)


def test_repeated_rows_and_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "the")] * 3 + [(2, "of")], "doc_id long, text string")
    repair.write_ids(docs, f"{tmp_path}/some", PATH)
    got = sorted(map(tuple, repair.read_documents(spark, f"{tmp_path}/some").collect()), key=lambda r: r[1])
    assert got == want_of([(1, "the")] * 3 + [(2, "of")])
    repair.write_ids(docs.limit(0), f"{tmp_path}/none", PATH)
    assert repair.read_documents(spark, f"{tmp_path}/none").count() == 0


class Counted:
    """A library that counts the texts it is given."""

    def __init__(self, library):
        self.library, self.texts = library, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.library.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_the_library_gets_many_parts_in_a_text(name):
    import pyarrow as pa

    from hazlake.llm.tokens import Encoder

    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeßéÀ'.,;19<|> ́", k=rng.randint(1, 9))) for _ in range(3000)]
    plain = " ".join(w for w in words if "<|" not in w)
    texts = [plain, None, "", "\n \t", " ".join(words), "a<|endoftext|>b <|startoftext|> c <|endoftext", "|> d <|"]
    encoder = Encoder(tokenizer_path(name))
    library = encoder.library
    encoder.library = Counted(library)
    for some in ([plain], texts, [t for t in texts if t]):
        ids, offsets = encoder.encode(pa.array(some, pa.string()))
        for i, text in enumerate(some):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids
        if some == [plain]:
            assert encoder.library.texts < len(encoder.new.slots) / 20


def test_rare_pairs_are_not_sorted_every_round(monkeypatch):
    # Most pairs are too rare to be replaced early.
    rng, sizes = np.random.default_rng(2), []
    ids = np.minimum(rng.zipf(1.3, 60_000), 5_000).astype(np.uint32)
    counted = repair._pair_counts
    monkeypatch.setattr(repair, "_pair_counts", lambda keys: sizes.append(len(keys)) or counted(keys))
    grammar = repair.Grammar.from_bytes(repair.compress(ids, np.array([0, 25_000, 60_000])).to_bytes())
    assert (grammar.expand(grammar.symbols) == ids).all()
    assert sizes[0] == 59_998 and len(sizes) > 2 and sizes[1] < sizes[0] / 2


def test_the_most_frequent_pair_may_be_far_below_the_last_threshold():
    # One pair 4,000 times, then nothing above 20: less than an eighth of the 500 that were enough in the first round.
    ids = np.concatenate([np.tile([1, 2], 4_000), np.tile(np.arange(10, 50), 20)]).astype(np.uint32)
    grammar = repair.compress(ids, np.arange(0, len(ids) + 1, 2))
    assert (grammar.expand(grammar.symbols) == ids).all()
    assert len(grammar.symbols) == len(ids) // 2 and len(grammar.rules) == 21
