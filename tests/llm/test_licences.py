"""Licence scan against plain comparison of every run of words."""

import random
import re

import pytest
from pyspark.sql import functions as F

from hazlake.llm import licences
from hazlake.llm.checks import QUERIES
from hazlake.llm.licence_texts import PHRASES, TEMPLATES


def words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_places(text):
    own = words(text)
    out = []
    for label, phrase in PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(own) - len(p) + 1) if own[i : i + len(p)] == p]
    return sorted(out)


def brute_statistics(own, sequences):
    """Longest run ending at every word that some sequence has, by trying all."""
    runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    out = []
    for i in range(len(own)):
        best = 0
        while best <= i and tuple(own[i - best : i + 1]) in runs:
            best += 1
        out.append(best)
    return out


def found(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("labels", F.lit("a clash"))
    return [r.asDict() for r in licences.scan(docs, **options).orderBy("doc_id").collect()]


FILL = "the of and software any to or of license under this be that with lorem ipsum dolor wörk 42".split()


def texts():
    rng = random.Random(3)
    out = [None, "", "!!! ---", "MIT LICENSE", "mit-license mit license", "the cc\nby, Cc By by-cc by", "GNU General Public License" * 2, "x" * 50_000]
    for label, template in TEMPLATES:
        body = rng.choices(FILL, k=rng.randint(0, 40))
        at = rng.randint(0, len(body))
        out.append(" ".join(body[:at]) + " \n" + template.upper() + " \n" + " ".join(body[at:]))
    out += [" ".join(rng.choices(FILL, k=n)) for n in (5, 50, 500, 5000)]
    return out + out[8:10]


def test_places_equal_plain_search(spark):
    for text, row in zip(texts(), found(spark, texts())):
        want = brute_places(text)
        assert row["n_words"] == len(words(text)) and row["n_base"] == len(want)
        assert (row["first_word"], row["last_word"]) == ((want[0][0], want[-1][0]) if want else (None, None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in want}))


def test_statistics_equal_every_run_tried(monkeypatch):
    rng = random.Random(1)
    for symbols in (2, 3, 8):
        sequences = [[rng.randrange(symbols) for _ in range(rng.randint(1, 12))] for _ in range(6)]
        automaton = licences.Automaton(sequences, symbols)
        own = [rng.randrange(symbols) for _ in range(300)]
        import numpy as np

        for piece in (4096, 7):
            monkeypatch.setattr(licences, "PIECE", piece)
            states, lengths = automaton.statistics(np.array(own), np.array([0, 150]), np.array([150, 300]), 12)
            assert lengths.tolist() == brute_statistics(own[:150], sequences) + brute_statistics(own[150:], sequences)
            for i, (state, length) in enumerate(zip(states.tolist(), lengths.tolist())):
                run = own[i + 1 - length : i + 1]
                want = sorted((k, j) for k, s in enumerate(sequences) for j in range(length, len(s) + 1) if s[j - length : j] == run)
                assert length == 0 or automaton.ends[state] == want


def test_every_template_is_found_whole(spark):
    rows = found(spark, texts())
    for row, (label, template) in zip(rows[8:], TEMPLATES):
        assert label in row["labels"].split(",") and row["score"] == 1.0
        assert any(s["label"] == label and s["covered"] >= 0.99 for s in row["spans"])
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))


def test_edited_templates_are_chained_and_clean_texts_are_not(spark):
    rng = random.Random(9)
    changed = []
    long = [(label, t) for label, t in TEMPLATES if len(words(t)) > 40]
    for label, template in long:
        own = words(template)
        for at in sorted(rng.sample(range(len(own)), len(own) // 25), reverse=True):
            own[at : at + rng.choice([0, 1])] = rng.choices(FILL, k=rng.choice([1, 2, 5]))
        changed.append(" ".join(rng.choices(FILL, k=30) + own))
    clean = [" ".join(rng.choices(FILL, k=400)) for _ in range(20)]
    clean += [" ".join(words(t)[: len(words(t)) // 2]) for _, t in long]
    rows = found(spark, changed + clean)
    for row, (label, _) in zip(rows, long):
        assert label in row["labels"].split(","), (label, row)
        assert 0.75 <= row["score"] <= 1
    assert all(set(filter(None, r["labels"].split(","))) <= {l for l in r["base_labels"].split(",")} for r in rows[len(changed) :])


def test_repeated_template_gives_several_spans(spark):
    text = " ".join([TEMPLATES[0][1], "word " * 50, TEMPLATES[0][1]])
    [row] = found(spark, [text])
    assert [s["first_word"] for s in row["spans"] if s["template"] == 0] == [0, 55]
    assert row["n_base"] == 2


def test_empty_table_and_own_texts(spark):
    assert found(spark, []) == []
    [row] = found(spark, ["one two three four"], phrases=[("p", "two")], templates=[("t", "One, two. THREE four five"), ("s", "four")])
    assert (row["base_labels"], row["labels"], row["first_word"], row["score"]) == ("p", "p,s,t", 1, 1.0)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query_equals_plain_search(spark, folder):
    want = {r["doc_id"]: brute_places(r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op13_licence_automaton"](spark, folder).collect()
    assert len(got) == len(want)
    for row in got:
        places = want[row["doc_id"]]
        assert (row["n_base"], row["base_labels"]) == (len(places), ",".join(sorted({label for _, label in places})))
