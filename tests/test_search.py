"""Ranked search against a plain BM25."""

import math
import random
import unicodedata

import pytest

from hazlake.operators import search
from hazlake.schemas import LAKE

WORDS = "flood floods Flood rain heavy alert Éclair naïve covid 19 river the the of over dam loc".split()


def fold(word):
    parts = unicodedata.normalize("NFD", word.lower())
    return "".join(c for c in parts if not unicodedata.combining(c))


def tokens(text):
    spaced = "".join(c if c.isalnum() else " " for c in fold(text or ""))
    return spaced.split()


def records(n=120, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = None if i % 17 == 0 else rng.choice([" ", "-", ", "]).join(rng.choice(WORDS) for _ in range(rng.randrange(1, 30)))
        keywords = rng.sample(["Assam flood", "heavy rain", "IMD warning"], rng.randrange(3))
        row = {f: None for f in LAKE.fieldNames()}
        row.update(
            lake_id=f"id{i:03d}", text=text, keywords_hit=keywords, media_urls=[], date_partition="2024-01-01",
            hazard_type=rng.choice([None, "FLOOD"]), location_name=rng.choice([None, "loc 3", "River Dam"]),
        )
        out.append(row)
    return out


def columns(row):
    return {
        "text": tokens(row["text"]), "keywords_hit": tokens(" ".join(row["keywords_hit"])),
        "hazard_type": tokens(row["hazard_type"]), "location_name": tokens(row["location_name"]),
    }


def count(cols, words, prefix=False, only=tuple(search.INDEXED)):
    n = 0
    for name in only:
        toks = cols[name]
        for i in range(len(toks) - len(words) + 1):
            part = toks[i:i + len(words)]
            last = part[-1].startswith(words[-1]) if prefix else part[-1] == words[-1]
            n += part[:-1] == words[:-1] and last
    return n


def ranked(rows, units, keep, limit=None):
    """units: list of (words, prefix, columns, scored)."""
    docs = [(r["lake_id"], columns(r)) for r in rows]
    lens = [sum(len(t) for t in c.values()) for _, c in docs]
    avg = sum(lens) / len(lens)
    freqs = [[count(c, w, p, o) for w, p, o, _ in units] for _, c in docs]
    hits = [sum(f[i] > 0 for f in freqs) for i in range(len(units))]
    out = []
    for (lake_id, _), length, f in zip(docs, lens, freqs):
        if not keep(f):
            continue
        score = 0.0
        for i, (_, _, _, scored) in enumerate(units):
            idf = math.log((len(docs) - hits[i] + 0.5) / (hits[i] + 0.5))
            idf = idf if idf > 0 else 1e-6
            if scored:
                score -= idf * f[i] * 2.2 / (f[i] + 1.2 * (0.25 + 0.75 * length / avg))
        out.append((score, lake_id))
    return sorted(out)[:limit]


ALL = tuple(search.INDEXED)
CASES = [
    ("flood rain", [(["flood"], False, ALL, True), (["rain"], False, ALL, True)], lambda f: f[0] and f[1]),
    ("covid-19", [(["covid"], False, ALL, True), (["19"], False, ALL, True)], lambda f: f[0] and f[1]),
    ("ECLAIR", [(["eclair"], False, ALL, True)], lambda f: f[0]),
    (search.Match(phrases=("the the",)), [(["the", "the"], False, ALL, True)], lambda f: f[0]),
    (search.Match(prefixes=("flo",)), [(["flo"], True, ALL, True)], lambda f: f[0]),
    (search.Match(phrases=("heavy rain",), none_of=("dam",)), [(["heavy", "rain"], False, ALL, True), (["dam"], False, ALL, False)], lambda f: f[0] and not f[1]),
    (search.Match(any_of=("naive", "over dam")), [(["naive"], False, ALL, True), (["over", "dam"], False, ALL, True)], lambda f: f[0] or f[1]),
    (search.Match("river", columns=("location_name",)), [(["river"], False, ("location_name",), True)], lambda f: f[0]),
]


@pytest.fixture(scope="module")
def lake(spark):
    rows = records()
    return rows, spark.createDataFrame([tuple(r[f] for f in LAKE.fieldNames()) for r in rows], LAKE).cache()


@pytest.mark.parametrize("case", range(len(CASES)))
def test_scan_search(lake, case):
    rows, df = lake
    match, units, keep = CASES[case]
    want = ranked(rows, units, keep)
    got = [(r["score"], r["lake_id"]) for r in search.search(df, match, None).select("score", "lake_id").collect()]
    assert want and [g[1] for g in got] == [w[1] for w in want]
    assert all(abs(g[0] - w[0]) < 1e-9 for g, w in zip(got, want))


def test_index_search_equals_scan(lake):
    _, df = lake
    posts, stats = search.postings(df), search.corpus_stats(df)
    scan = [(r["lake_id"], round(r["score"], 9)) for r in search.search(df, "flood the", 10).collect()]
    found = search.fetch(search.search_postings(posts, stats, "flood the", 10), df)
    assert scan == [(r["lake_id"], round(r["score"], 9)) for r in found.collect()] and len(scan) == 10


def test_no_words_no_rows(lake):
    _, df = lake
    assert search.search(df, "?!").count() == 0
    assert search.search_postings(search.postings(df), search.corpus_stats(df), "").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_index_and_scan_agree_on_any_match(spark, seed):
    rng = random.Random(seed)
    df = spark.createDataFrame(records(), LAKE)
    posts, stats = search.postings(df), search.corpus_stats(df)

    def some(most, words=2):
        return tuple(" ".join(rng.choices(WORDS, k=rng.randint(1, words))) for _ in range(rng.randint(0, most)))

    match = search.Match(
        " ".join(some(2, 1)), some(1), tuple(p[:-1] for p in some(1) if len(p) > 3), some(2), some(1),
        tuple(rng.sample(search.INDEXED, rng.randint(1, 4))),
    )
    want = [(r["lake_id"], round(r["score"], 9)) for r in search.search(df, match, None).collect()]
    got = [(r["lake_id"], round(r["score"], 9)) for r in search.search_postings(posts, stats, match, None).collect()]
    assert got == want
