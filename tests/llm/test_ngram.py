"""Scores against the formula computed directly."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from hazlake.llm import eliasfano, ngram

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("top", [1, 50, 10**6, 2**40, 2**64 - 1])
def test_successor(top):
    rng = random.Random(top)
    for n in (0, 1, 2, 300):
        values = sorted(rng.randint(0, top) for _ in range(n))
        sequence = eliasfano.Sequence(b"ab" + eliasfano.encode(np.array(values, dtype=np.uint64)), 2)
        assert sequence.values(np.arange(n)).tolist() == values
        wanted = [rng.randint(0, top) for _ in range(200)] + values + [0, top, max(values, default=0)]
        at, equal = sequence.successor(np.array(wanted, dtype=np.uint64))
        for w, a, e in zip(wanted, at.tolist(), equal.tolist()):
            assert a == sum(v < w for v in values) and e == (w in values)


def words_of(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "").split(" ") if (text or "").strip() else []


def tokens_of(text):
    return [w for w in words_of(text) if w] + [None]


def brute(rows, mu=ngram.MU):
    learnt = [tokens_of(t) for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 10]
    single, pair = Counter(w for t in learnt for w in t), Counter(p for t in learnt for p in zip(["<s>"] + t, t))
    before = Counter(w for t in learnt for w in ["<s>"] + t[:-1])
    n, v = sum(single.values()), len(single)
    out = {}
    for k, (d, text) in enumerate(rows):
        t = tokens_of(text)
        p = [(single[w] + 0.1) / (n + 0.1 * (v + 1)) for w in t]
        full = [(pair[h, w] + mu * q) / (before[h] + mu) for h, w, q in zip(["<s>"] + t, t, p)]
        key = (d, zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0, len(t), sum(single[w] > 0 for w in t), n)
        out.setdefault(key, []).append((sum(map(math.log10, p)), sum(map(math.log10, full))))
    return {k: sorted(v) for k, v in out.items()}


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(400)] + ["The", "the", "É"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 80])))) for i in range(200)]
    return rows + [(300, None), (None, "the w1"), (7, rows[7][1]), (301, "never seen words"), (-5, " the  the ")]


def same(got, want):
    found = {}
    for r in got:
        found.setdefault(tuple(r)[:5], []).append((r["base_score"], r["score"]))
    assert found.keys() == want.keys()
    for key, scores in want.items():
        for (b, s), (base, score) in zip(scores, sorted(found[key])):
            assert base == pytest.approx(b, rel=1e-9) and score == pytest.approx(s, abs=1e-4 * key[2] + 1e-9)


@pytest.mark.parametrize("shard_tokens", [ngram.SHARD_TOKENS, 500])
def test_scores_follow_the_formula(spark, shard_tokens):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS score", "1 AS shard").repartition(3)
    model = ngram.train(docs, shard_tokens=shard_tokens)
    shards = model.vocabulary.shards
    assert (shards.n > 5) == (shard_tokens == 500)
    assert shard_tokens != 500 or len(shards.words) > 2
    want = brute(rows)
    same(ngram.score(docs, model).collect(), want)
    same(ngram.train_and_score(docs, shard_tokens=shard_tokens).collect(), want)


def test_probabilities_sum_to_one():
    words = np.arange(10, 20, dtype=np.uint64)
    rng = np.random.default_rng(0)
    parent, context, often = rng.integers(0, 10, 80), np.full(80, 3, dtype=np.uint64), rng.integers(1, 5, 80)
    counts = np.bincount(parent, weights=often, minlength=10).astype(np.int64) + 2
    unit = 1 / (counts.sum() + 0.1 * 11)
    trie = ngram.Trie(ngram.Trie.to_bytes(words, counts, parent, context, often, unit, 50.0))
    number, count = trie.find(words)
    seen, value = trie.seen(number, np.full(10, 3, dtype=np.uint64))
    numerators = np.where(seen, 10**value, 50.0 * unit * (count + 0.1))
    assert (numerators.sum() + 50.0 * unit * 0.1) / (often.sum() + 50.0) == pytest.approx(1, abs=1e-3)


def test_a_trie_is_read_from_a_mapped_file(tmp_path):
    data = ngram.Trie.to_bytes(np.array([5, 9], np.uint64), np.array([3, 1]), np.array([0, 0, 1]), np.array([1, 2, 1], np.uint64), np.array([2, 1, 1]), 0.1, 1.0)
    (tmp_path / "t").write_bytes(data)
    trie = ngram.Trie.open(str(tmp_path / "t"))
    assert trie.find(np.array([5, 6, 9, 99], np.uint64))[1].tolist() == [3, 0, 1, 0]
    assert trie.seen(np.array([0, 0, 1, 1]), np.array([2, 7, 1, 2], np.uint64))[0].tolist() == [True, False, True, False]


def test_no_rows_and_nothing_learnt(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ngram.score(none, ngram.train(none)).count() == 0 and ngram.train_and_score(none).count() == 0
    rows = [(next(i for i in range(100) if ngram.held_out(i)), "a b")]
    docs = spark.createDataFrame(rows, SCHEMA)
    same(ngram.score(docs, ngram.train(docs)).collect(), brute(rows))
    same(ngram.train_and_score(docs).collect(), brute(rows))


def test_held_out_documents_score_better_than_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = ngram.train_and_score(docs).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.1 * sum(r["n_tokens"] for r in rows)


def test_a_frequent_pair_is_no_single_group(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("of the" if rng.random() < 0.5 else f"w{rng.randrange(3000)}" for _ in range(150))) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(40).localCheckpoint()
    model = ngram.train(docs, shard_tokens=2000)
    known, sent = model.vocabulary, Counter()
    for r in ngram._sent_blocks(docs, known, model.parts()).filter("shard >= 0").collect():
        sent[r["shard"], r["part"]] += len(ngram._unpacked(r["block"])[1])
    whole = Counter()
    for (shard, _), n in sent.items():
        whole[shard] += n
    assert max(whole.values()) > 20_000  # a third of all tokens are one pair's
    assert max(sent.values()) < 12_000
    same(ngram.train_and_score(docs, shard_tokens=2000).collect(), brute(rows))
