"""Containment search against every pair compared."""

import random

import numpy as np
from pyspark.sql import functions as F

from hazlake.llm import decontaminate
from hazlake.llm.checks import QUERIES, SQL
from tests.compare import differences


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        own = shingles(text)
        for item_id, item in items:
            held = shingles(item)
            if held and 100 * len(held & own) >= 80 * len(held):
                out.append((doc_id, item_id, len(held), len(held & own)))
    return sorted(out)


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("a clash"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("a clash"))
    return sorted(tuple(r)[:4] for r in decontaminate.contaminated(d, i).collect())


def cases():
    rng = random.Random(8)
    words = ["w%d" % i for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([2, 4, 5, 9, 14, 30, 59, 130, 700])))) for i in range(60)]
    items += [(100, items[3][1]), (101, None), (102, ""), (103, " ".join(["again"] * 20))]
    docs = []
    for d in range(150):
        body = rng.choices(words, k=rng.choice([0, 3, 50, 3000]))
        for _ in range(rng.choice([0, 1, 2])):
            passage = rng.choice(items)[1] or ""
            passage = passage.upper().split() if rng.random() < 0.3 else passage.split()
            if rng.random() < 0.6 and len(passage) > 12:  # edits around the threshold
                for _ in range(rng.choice([1, 1, 2])):
                    passage[rng.randrange(len(passage))] = "edited"
            at = rng.randint(0, len(body))
            body[at:at] = passage
        docs.append((d, " ".join(body)))
    docs += [(500, None), (501, ""), (502, items[0][1]), (503, "again " * 40), (502, items[0][1])]
    return docs, items


def test_equals_every_pair_compared(spark):
    docs, items = cases()
    want = brute(docs, items)
    assert len(want) > 60 and found(spark, docs, items) == want


def test_blocks_give_the_same(spark, monkeypatch):
    docs, items = cases()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 4000)
    assert found(spark, docs, items) == brute(docs, items)


def test_least_items_at_the_threshold_are_found(spark):
    rng = random.Random(0)
    items, docs = [], []
    for i in range(200):
        passage = [f"i{i}x{k}" for k in range(29)]  # 25 shingles; one edit at the edge leaves at least 20
        items.append((i, " ".join(passage)))
        passage[rng.choice([0, 1, 2, 3, 4, 24, 25, 26])] = "edited"
        body = [f"d{i}x{k}" for k in range(rng.randint(0, 4000))]
        at = rng.randint(0, len(body))
        docs.append((i, " ".join(body[:at] + passage + body[at:])))
    assert [r[:2] for r in found(spark, docs, items)] == [(i, i) for i in range(200)]


def test_clean_documents_keeps_the_rest_as_it_is(spark):
    docs, items = cases()
    bad = {r[0] for r in brute(docs, items)}
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("more", F.array(F.lit(1.5)))
    i = spark.createDataFrame(items, "item_id long, text string")
    clean = decontaminate.clean_documents(d, i)
    assert clean.columns == ["doc_id", "text", "more"]
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _ in docs if i not in bad)
    assert decontaminate.clean_documents(d, i.limit(0)).count() == len(docs)
    assert decontaminate.contaminated(d.limit(0), i).count() == 0


def test_index_of_no_items_finds_nothing():
    import pyarrow as pa

    assert list(decontaminate.Index([], []).search(pa.array(["the of and to in", None]))) == []
    assert np.array(decontaminate.Index([1], ["a b"]).sets[0]).shape == (1,)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES["op5_containment_search"](spark, folder), SQL["op5_containment_search"], folder) is None


def test_shortest_items_inside_long_documents_are_found(spark):
    rng = random.Random(5)
    items = [(i, " ".join(f"i{i}x{k}" for k in range(5 + i % 4))) for i in range(4000)]  # one to four shingles
    docs, want = [], []
    for d in range(200):
        body = [f"d{d}x{k}" for k in range(400)]
        for i in range(20 * d, 20 * d + 20):
            at = rng.choice([0, rng.randint(0, len(body))])
            words = items[i][1].split()
            if rng.random() < 0.1:  # any edit leaves less than 80 %
                words[rng.randrange(len(words))] = "edited"
            body[at:at] = words
        docs.append((d, " ".join(body)))
    # What is put in later may part what was put in before.
    for d, text in docs:
        own = shingles(text)
        want += [(d, i, n, n) for i in range(20 * d, 20 * d + 20) if len(held := shingles(items[i][1])) == (n := len(held & own))]
    assert len(want) > 3000 and found(spark, docs, items) == sorted(want)
