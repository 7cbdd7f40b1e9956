"""Source divergence against plain counting of every term of every group."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hazlake.llm import divergence
from hazlake.llm.checks import QUERIES, SQL
from tests.compare import differences

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        groups[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= divergence.LEAST_DOCS]
        own = {s: c for (l, s), c in groups.items() if l == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(c) for s, c in own.items()}
        q = shares(sum(own.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in own:
            values = [(t, sum(f(p[s][w], p[t][w]) for w in kept)) for t in own if t != s]
            ranked = sorted(values, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, s, "pair", t, v, i + 1) for i, (t, v) in enumerate(ranked)]
            values = [(w, f(p[s][w], q[w])) for w in kept if own[s][w] and p[s][w] > q[w]]
            ranked = sorted(values, key=lambda x: (-x[1], x[0].encode()))[: divergence.TOP]
            out += [(lang, s, "term", w, v, i + 1) for i, (w, v) in enumerate(ranked)]
    return sorted(out)


def audited(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"part": F.lit("a clash"), "digest": F.lit(1), "term": F.lit(2)})
    return sorted(tuple(r) for r in divergence.audit(df, **options).collect())


def cases():
    rng = random.Random(4)
    words = [w + x for w in "flood Rain STORM über été naïve 水 snow".split() for x in ("", "a", "B", "c-d", "7e", "ſ")]
    rows = []
    for i in range(150):
        lang, source = rng.choice(["en", "de", None, "fr"]), rng.choice(["a", "b", "b", "b", "c", None, ""])
        pool = words[hash_of(lang, source) % 20 :]
        rows.append((i, " ".join(rng.choices(pool, k=rng.choice([0, 1, 5, 60]))), lang, source))
    rows += [(200, None, "en", "silent"), (201, "12 !?", "xx", "s"), (202, "", "xx", "t"), (203, "word " * 20_000, "en", "long")]
    rows += [(204, "only two", "yy", "s"), (205, "only two", "yy", "t"), rows[0], rows[0]]
    return rows


def hash_of(lang, source):
    return sum(map(ord, (lang or "") + (source or "")))


@pytest.mark.parametrize("bits", [64, 4])
def test_equals_plain_counts(spark, monkeypatch, bits):
    """With four bits nearly every digest is shared by several terms."""
    monkeypatch.setattr(divergence, "TOP", 12)
    want = brute(cases())
    assert len(want) > 150 and audited(spark, cases(), bits=bits) == want


def test_small_steps_give_the_same():
    """A task that hands on its counts often, and pairs in small steps."""
    import numpy as np
    import pyarrow as pa

    rows = cases()
    counter = divergence.Counter(64, 3)
    held, divergence.HELD_ROWS = divergence.HELD_ROWS, 10
    try:
        groups = np.arange(len(rows)) % 3
        counter.groups = {("l", str(i)): i for i in range(3)}
        batches = [b for i in range(len(rows)) for b in counter.add(pa.array([rows[i][1]], pa.string()), groups[i : i + 1])]
        batches += list(counter.counts())
    finally:
        divergence.HELD_ROWS = held
    n, docs, terms = Counter(), Counter(), {}
    for b in batches:
        for r in b.to_pylist():
            if r["lang"] is None:
                terms |= dict(zip(r["digests"], r["terms"]))
                continue
            source, counts, held = (np.frombuffer(r[k], np.uint32).tolist() for k in ("source", "n", "docs"))
            for s, d, c, h in zip(source, np.frombuffer(r["digest"], np.int64).tolist(), counts, held):
                n[r["sources"][s], d] += c
                docs[r["sources"][s], d] += h
    want, want_docs = Counter(), Counter()
    for i, (_, text, *_rest) in enumerate(rows):
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        own = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        want.update((str(i % 3), t) for t in own)
        want_docs.update((str(i % 3), t) for t in set(own))
    assert {(s, terms[d]): c for (s, d), c in n.items()} == want
    assert {(s, terms[d]): c for (s, d), c in docs.items()} == want_docs


def test_pairs_in_small_steps(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOME_PAIRS", 3)
    monkeypatch.setattr(divergence, "HELD_PAIRS", 2)
    import pyarrow as pa

    own = [[{"source": s, "p": p, "p0": p0} for s, p, p0 in row] for row in ([("a", 50, 3), ("b", 20, 4), ("c", 9, 2)], [("b", 7, 4), ("a", 90, 3)])]
    batch = pa.RecordBatch.from_pydict({"lang": ["l", "l"], "own": own})
    got = Counter()
    for b in divergence._shares([batch, batch]):
        for r in b.to_pylist():
            got[r["source"], r["item"]] += r["value"]
    want = Counter()
    f = lambda a, b: (a - b) ** 2 // b
    for row in own * 2:
        for x in row:
            for y in row:
                if x is not y:
                    want[x["source"], y["source"]] += f(x["p"], y["p"]) - f(x["p0"], y["p"]) - f(x["p"], y["p0"]) + f(x["p0"], y["p0"])
    assert got == want


def test_empty_table(spark):
    assert audited(spark, []) == []


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES["op11_late_terms"](spark, folder), SQL["op11_late_terms"], folder) is None
