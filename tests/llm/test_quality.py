"""Measures and verdicts against a plain version; the registered query against its SQL."""

import random
import re

import pytest
from pyspark.sql import functions as F

from hazlake.llm import quality
from hazlake.llm.checks import QUERIES, SQL
from tests.compare import differences

SCHEMA = "doc_id long, text string"
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    runs = {}
    for i in range(len(words) - 7):
        runs.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {k for at in runs.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    n = len(words)
    measures = (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
    return (*measures, n < 20 or 100 * len(covered) > 30 * n)


def texts():
    rng = random.Random(7)
    vocabulary = ["the", "of", "É", "thing", "*x*", "#", "12", "sch", "x" * 30]
    out = [None, "", " \t\n\x0b\x0c\r", "one", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 30, "a\nb\na\n\n \na", "\x1cword\x85x\xa0y"]
    for _ in range(60):
        body = rng.choices(vocabulary, k=rng.randint(0, 80))
        if rng.random() < 0.5 and len(body) > 12:
            body += body[2:12]
        out.append("".join(w + rng.choice([" ", "  ", "\n", "\t"]) for w in body))
    return out + [" ".join(f"w{i}" for i in range(30_000)), "the " * 20_000]


def test_measures_equal_a_plain_version(spark):
    rows = list(enumerate(texts()))
    rows += rows[:4]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((r["doc_id"], *[r[n] for n in NAMES]) for r in quality.judged(docs).collect())
    assert got == sorted((i, *brute(t)) for i, t in rows)


CLEAN = "This is a plain text of some length that the rules keep because it has words of all sorts and no marks in it at all for once."


@pytest.mark.parametrize(
    "text, broken",
    [
        (CLEAN, []),
        (" ".join(f"{w}***" for w in CLEAN.split()), ["symbols", "stop_words"]),
        (" ".join(f"{i}{i}" for i in range(40)), ["stop_words", "letters"]),
        (" ".join(f"longlonglonglonglong{i} the" * 1 for i in range(30)).replace(" the", "the"), ["word_length", "stop_words"]),
        (CLEAN + "\n" + "\n".join(["the same"] * 9), ["repeated_lines"]),
        ("\n".join(f"- the point{i} of it" for i in range(12)), ["bullets"]),
        ("\n".join(f"the text {i} goes on..." for i in range(12)), ["ellipses"]),
        (" ".join(f"the{i} the{i} the{i} of" for i in range(12)), ["stutter"]),
    ],
)
def test_rules(spark, text, broken):
    row = quality.judged(spark.createDataFrame([(1, text)], SCHEMA)).first()
    assert row["broken"] == broken and row["kept"] == (not broken)


RUSSIAN = "это обычный русский текст о том как люди живут в большом городе и что они делают каждый день когда идут утром на работу или домой вечером"
POLISH = "zwykły polski tekst opowiada o tym jak ludzie żyją w dużym mieście i co robią każdego dnia kiedy idą rano do pracy lub wracają wieczorem"


@pytest.mark.parametrize(
    "text, tag, broken",
    [
        (RUSSIAN, None, []),
        (RUSSIAN, "en", []),
        (RUSSIAN + " " + POLISH.replace("a", "o"), "ru", []),
        (POLISH, "pl", []),
        (POLISH, "PL_pl", []),
        (POLISH, None, ["stop_words"]),
        (POLISH, "", ["stop_words"]),
        (POLISH, "en-GB", ["stop_words"]),
        (CLEAN, "pl", []),
    ],
)
def test_stop_words_speak_for_listed_languages_only(spark, text, tag, broken):
    docs = spark.createDataFrame([(1, text, tag)], SCHEMA + ", tag string")
    assert quality.judged(docs, language="tag").first()["broken"] == broken
    assert quality.kept_documents(docs, language="tag").count() == (not broken)


def test_rules_are_a_table(spark):
    own = (quality.Rule("short", "n_words", "n_lines", most=3),)
    docs = spark.createDataFrame([(1, CLEAN), (2, "\n".join(["a b", "c d"] * 10)), (3, None)], SCHEMA)
    assert {r["doc_id"]: r["broken"] for r in quality.judged(docs, rules=own).collect()} == {1: ["short"], 2: [], 3: []}


def test_kept_documents_come_as_they_were(spark):
    docs = spark.createDataFrame([(1, CLEAN), (1, CLEAN), (2, "short"), (3, None)], SCHEMA).withColumns({"kept": F.lit(False), "n_words": F.array(F.lit("x"))})
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, CLEAN, False, ["x"])] * 2
    assert quality.kept_documents(docs.limit(0)).count() == 0


def test_the_plan_has_no_python_and_no_shuffle(spark, capsys):
    QUERIES["op4_quality_rules"](spark, "/root/testdata/sf0.001").explain("formatted")
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES["op4_quality_rules"](spark, folder), SQL["op4_quality_rules"], folder) is None
