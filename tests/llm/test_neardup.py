"""Near-duplicate components against every pair compared."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazlake.llm import neardup

SCHEMA = "doc_id long, text string"


def shingles(text, size):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size):
    """{(doc_id, n, component)} by comparing all pairs."""
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    least = {i: i for i, _ in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if both and 100 * both >= 80 * len(a | b) and root(i) != root(j):
                x, y = sorted((root(i), root(j)))
                least[y] = x
    return sorted([(i, len(s), root(i)) for i, s in sets])


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def cases(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, k = [], 0
    shared = rng.choices(vocabulary, k=40)
    for _ in range(40):
        body = rng.choices(vocabulary, k=rng.choice([3, 8, 60, 150, 400]))
        if rng.random() < 0.4:
            body += shared
        for _ in range(rng.choice([1, 1, 2, 6, 15])):
            copy = edited(rng, body, rng.choice([0, 0, 1, 2, 4, 6, 9])) if len(body) > 8 else body
            rows.append((k, " ".join(copy) if rng.random() < 0.8 else " ".join(copy).upper()))
            k += 1
    rows += [(k, ""), (k + 1, None), (k + 2, "  \n"), (k + 3, "one"), (k + 4, "ONE"), (k + 5, "x " * 3000)]
    rng.shuffle(rows)
    return rows


def found(spark, rows, size):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("name", F.lit("a clash")).withColumn("id", F.lit(1)).repartition(3)
    return neardup.near_duplicates(docs, size)


@pytest.mark.parametrize("size", [4, 5])
def test_components_equal_all_pairs(spark, size):
    rows = cases()
    got = found(spark, rows, size).collect()
    want = brute(rows, size)
    assert sorted(tuple(r)[:3] for r in got) == want
    assert len({c for _, _, c in want}) < len(want) - 50
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_deep_nodes_and_blocks_equal_all_pairs(spark, monkeypatch):
    rng = random.Random(6)
    body = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, body, rng.choice([0, 2, 3, 4, 5, 6])))) for i in range(90)]
    rows += [(100 + i, " ".join(rng.choices(body, k=50))) for i in range(30)]
    monkeypatch.setattr(neardup, "LEAF", 12)
    monkeypatch.setattr(neardup, "DEPTH", 3)
    monkeypatch.setattr(neardup, "GROUP_SHINGLES", 800)
    got = sorted(tuple(r)[:3] for r in found(spark, rows, 4).collect())
    assert got == brute(rows, 4)


def test_linked_is_exact():
    rng = np.random.default_rng(2)
    for _ in range(60):
        centre = rng.integers(0, 40, 30)
        sets = [np.unique(np.where(rng.random(30) < 0.1, rng.integers(0, 60, 30), centre)).astype(np.uint64) for _ in range(12)]
        label = np.arange(12)
        for i in range(12):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    label[label == label[i]] = label[j]
        got = neardup.linked(sets)
        assert (np.equal.outer(got, got) == np.equal.outer(label, label)).all()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i + 1, i) for i in range(1, 60)] + [(1000 + i, 999) for i in range(50)] + [(5000, 60), (5000, 3000)]
    got = dict(map(tuple, neardup.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {i: 1 for i in [*range(2, 61), 3000, 5000]} | {1000 + i: 999 for i in range(50)}


def test_nulls_repeats_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text), (7, text), (5, text), (None, text), (None, None), (9, text + " w30")]
    got = sorted(map(tuple, found(spark, rows, 5).collect()), key=repr)
    assert got == sorted([(7, 26, 5, False)] * 2 + [(5, 26, 5, True), (None, 26, None, True), (None, 0, None, True), (9, 27, 5, False)], key=repr)
    assert found(spark, rows, 5).limit(0).count() == 0
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_document_of_each_group_stays(spark):
    rows = cases(8)
    rows += rows[:4]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("more", F.lit("m"))
    left = neardup.without_near_duplicates(docs)
    assert left.columns == ["doc_id", "text", "more"]
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({c for _, _, c in brute(list(dict(rows).items()), 5)})


def test_several_texts_of_one_doc_id(spark):
    """A text that is a copy of an earlier document does not take another text of its doc_id with it."""
    rng = random.Random(4)
    a, b, c = ([f"{x}{rng.randrange(10**6)}" for _ in range(60)] for x in "abc")
    rows = [(1, a), (5, a), (5, b), (5, c), (8, edited(rng, b, 1)), (9, edited(rng, c, 1)), (9, edited(rng, b, 1)), (3, c + ["end"])]
    rows = [(i, " ".join(t)) for i, t in rows] + [(12, ""), (12, None), (12, "")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("_set", F.lit("a clash"))
    got = sorted((tuple(r)[:3:2] for r in neardup.near_duplicates(docs).filter("n_shingles > 0").collect()))
    assert got == sorted([(1, 1), (5, 1), (5, 5), (5, 3), (8, 5), (9, 3), (9, 5), (3, 3)])
    left = neardup.without_near_duplicates(docs)
    assert left.columns == docs.columns
    want = [(1, " ".join(a)), (3, " ".join(c + ["end"])), (5, " ".join(b))]
    assert sorted((r["doc_id"], r["text"]) for r in left.filter("text <> ''").collect()) == want
    assert left.filter("doc_id = 12").count() == 2


def test_dense_nodes_keep_their_pairs(spark, monkeypatch):
    """Pairs at 0.8 inside nodes that no level makes small meet in a leaf, as a comparison of all classes would have them."""
    monkeypatch.setattr(neardup, "LEAF", 2)
    rng, n = np.random.default_rng(8), 4000
    a = rng.integers(0, 1 << 32, (n, neardup.TOKENS), dtype=np.uint32)
    b = np.where(rng.random(a.shape) < 0.8, a, rng.integers(0, 1 << 32, a.shape, dtype=np.uint32))
    # With a third class, equal in its tokens to the first, a node that holds a pair is larger than a leaf.
    rows = [(3 * i + k, x[i].tobytes()) for i in range(n) for k, x in enumerate((a, b, a))]
    classes = spark.createDataFrame(rows, "id long, tokens binary")
    met = neardup._leaves(classes, spark).filter("id % 3 < 2").select("node", F.expr("id div 3").alias("pair"), "id").distinct()
    assert met.groupBy("node", "pair").count().filter("count = 2").select("pair").distinct().count() == n
