"""Counts against the library, and chunked texts against whole ones."""

import random

import pytest
from pyspark.sql import functions as F

from hazlake.llm import tokencount
from hazlake.llm.tokens import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
ODD = list("ab ZÉé\t\n\r\x0b\x1c\x85\xa0 　'sts!?.12٣ßΣ́語😀") + ["<|endoftext|>", "<|", "'re", " the", "  ", "thing", "ción"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def n_ids(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_every_document_counts_as_in_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r["doc_id"]: (len(r["text"].encode()), n_ids(library, r["text"])) for r in docs.collect()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in tokencount.token_counts(docs, PATH).collect()}
    assert got == want


def test_odd_texts_whole_and_in_chunks(spark, library):
    rng = random.Random(2)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 60))) for _ in range(400)] + [None, "", "x" * 500, " " * 90, "語" * 70]
    rows = list(enumerate(texts))
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_bytes", F.lit("a clash"))
    want = sorted((i, len((t or "").encode()), n_ids(library, t)) for i, t in rows)
    for chunk in (tokencount.CHUNK_CHARS, 7):
        assert sorted(map(tuple, tokencount.token_counts(docs, PATH, chunk).collect())) == want


def test_words_of_any_letters_count_as_in_the_library(library):
    machine = tokencount.Transducer(PATH)
    rng = random.Random(4)
    for _ in range(3000):
        word = "".join(rng.choices("etaoinshrdlucmfwyp", k=rng.randint(1, 30)))
        assert machine.count(word) == n_ids(library, word)


def test_maps_compose_in_any_grouping(library):
    text = "Of the thing. 'tis <|endoftext|> été  \n\n sch " * 4
    def count(s):
        return n_ids(library, s)

    for size in (1, 2, 3, 5, 40):
        maps = []
        for i in range(0, len(text), size):
            sealed, head, middle, tail = tokencount._split(text[i : i + size])
            maps.append(tokencount.StateMap(sealed, head, count(middle), tail))
        left = maps[0]
        for m in maps[1:]:
            left = left.then(m, count)
        assert tokencount.scanned(maps, count) == count(left.head) + left.middle + count(left.tail) == count(text)


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(tokencount, "KEPT_TRANSITIONS", 5)
    machine = tokencount.Transducer(PATH)
    assert [machine.count(w) for w in ["thing other", "éclair", "thing other"]] == [n_ids(library, w) for w in ["thing other", "éclair", "thing other"]]


def test_no_rows(spark):
    assert tokencount.token_counts(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
