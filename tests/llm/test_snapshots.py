"""Collapsed conversations against every pair compared."""

import random

import pytest

from hazlake.llm import snapshots
from hazlake.llm.checks import QUERIES, SQL
from tests.compare import differences

SCHEMA = "conv_id long, turn long, role string, text string"


def log(seed=4):
    rng = random.Random(seed)
    rows, k = [], 0
    for _ in range(25):
        turns = [(t, rng.choice(["user", "assistant", None]), rng.choice(["", "hi", "x y", None, f"t{rng.random()}"])) for t in range(rng.randint(1, 9))]
        for _ in range(rng.randint(1, 5)):
            cut = turns[: rng.randint(1, len(turns))]
            if rng.random() < 0.2:
                cut = cut[:-1] + [(cut[-1][0], "user", "another end")]
            rows += [(k, *t) for t in cut]
            k += 1
    rows += rows[:15]  # repeated
    rows += [(900, 0, "user", "a"), (900, 0, "user", "b"), (901, 0, "user", "b"), (901, 0, "user", "a"), (901, 1, "user", "c")]  # ties
    rows += [(902, 5, "user", "gap"), (903, 5, "user", "gap"), (903, 3000, "user", "far"), (None, 0, "user", "a"), (904, None, "user", "a")]
    rng.shuffle(rows)
    return rows


def brute(rows):
    whole = {}
    for conv, turn, role, text in rows:
        if conv is not None and turn is not None:
            whole.setdefault(conv, set()).add((turn, role or "", text or ""))
    whole = {c: sorted(t) for c, t in whole.items()}
    out = []
    for c, turns in whole.items():
        equal = [d for d, other in whole.items() if other == turns]
        longer = any(other[-1][0] > turns[-1][0] and [t for t in other if t[0] <= turns[-1][0]] == turns for other in whole.values())
        if not longer and c == min(equal):
            out.append((c, len(equal), len(turns), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, r, t in turns)))
    return sorted(out)


@pytest.mark.parametrize("block", [snapshots.BLOCK_TURNS, 2])
def test_equals_every_pair_compared(spark, block):
    rows = log()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS a", "2 AS block").repartition(3)
    want = brute(rows)
    assert len(want) < 70 and sorted(map(tuple, snapshots.rendered(docs, block).collect())) == want


def test_one_long_conversation_and_its_snapshot(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(5000)] + [(2, t, "user", f"t{t}") for t in range(3000)]
    got = snapshots.rendered(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["conv_id"], r["n_turns"]) for r in got] == [(1, 5000)]


def test_no_rows(spark):
    assert snapshots.rendered(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES["op1_snapshot_collapse"](spark, folder), SQL["op1_snapshot_collapse"], folder) is None
