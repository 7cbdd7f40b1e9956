"""Hard negatives against every pair scored."""

import math
import random

import numpy as np
import pytest

from hazlake.llm import hardneg
from hazlake.llm.checks import QUERIES, SQL
from pyspark.sql import functions as F
from tests.compare import differences

SCHEMA = "id long, label int, vector array<float>, rank string"


def brute(rows):
    best = {}
    for id_, label, vector, _ in rows:
        if id_ is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in vector]
        if id_ not in best or (label, v) < best[id_]:
            best[id_] = (label, v)

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for a, (label, v) in best.items():
        if a % 100:
            continue
        all_ = sorted(((-score(v, w), i, l) for i, (l, w) in best.items() if i != a))
        for s, p, _ in [x for x in all_ if x[2] == label][: hardneg.POSITIVES]:
            fits = [(n, -t) for t, n, l in all_ if l != label and 80 * -s <= 100 * -t <= 100 * -s][: hardneg.NEGATIVES]
            out += [(a, p, k + 1, n, -s, t) for k, (n, t) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in hardneg.mine(df, F.col("id") % 100 == 0).collect())


def made(n, size, seed, centres=4):
    """Vectors about a few centres, with copies, ties and rows that take no part."""
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, size))
    v = middle[rng.integers(0, centres, n)] + 0.7 * rng.standard_normal((n, size))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[n // 3 : n // 2] = v[0]
    rows = [(i, int(rng.integers(0, 3)), [float(np.float32(x)) for x in v[i]], "clash") for i in range(n)]
    rows += [(None, 1, rows[0][2], ""), (n, None, rows[0][2], ""), (n + 1, 1, None, ""), (n + 2, 1, [None, 1.0], ""), (n + 3, 1, [float("nan")], "")]
    rows += [(n + 4, 1, [float("inf")] * size, ""), (n + 5, 2, [], ""), (n + 6, 0, [1.0], ""), rows[0], (100, 2, rows[5][2], ""), rows[7]]
    return rows


@pytest.mark.parametrize("size", [3, 64, 100])
def test_equals_every_pair_scored(spark, monkeypatch, size):
    monkeypatch.setattr(hardneg, "ROWS", 150)
    monkeypatch.setattr(hardneg, "ANCHORS", 3)
    rows = made(900, size, size)
    want = brute(rows)
    assert len(want) > 50 and mined(spark, rows) == want


def test_intervals_hold_and_are_narrow():
    rng = np.random.default_rng(5)
    for size in (64, 128):
        v = np.floor(rng.standard_normal((800, size)) * 256 / np.sqrt(size)).astype(np.int64)
        v[:3] = 0
        turn = hardneg.rotation(size)
        low, high = hardneg.intervals(v[:100], *hardneg.encode(v, turn), turn)
        exact = v[:100] @ v.T
        assert (low <= exact).all() and (exact <= high).all()
        assert np.median((high - low)[3:, 3:]) < 0.6 * 256 * 256


def test_few_rows_survive():
    rng = np.random.default_rng(6)
    v = rng.standard_normal((4000, 64))
    v = np.floor(256 * v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.int64)
    turn = hardneg.rotation(64)
    low, high = hardneg.intervals(v[:50], *hardneg.encode(v, turn), turn)
    eligible = np.ones_like(low, dtype=bool)
    bound = hardneg._reached(v[:50], v, (low + high) / 2, eligible, 5)
    exact = np.sort(v[:50] @ v.T, axis=1)
    assert (bound <= exact[:, -5]).all() and (high >= bound[:, None]).mean() < 0.1


def test_small_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0], ""), (2, 1, [1.0], "")]) == []
    assert mined(spark, [(100, 1, [1.0], "")]) == []
    rng = random.Random(1)
    few = [(i, i % 2, [rng.random()], "") for i in range(98, 103)]
    assert mined(spark, few) == brute(few)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES["op12_one_bit_negatives"](spark, folder), SQL["op12_one_bit_negatives"], folder) is None
