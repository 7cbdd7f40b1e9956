"""The pipeline against a plain version of every stage."""

import duckdb
import pytest

import corpus_pipeline
from hazlake.llm.checks import OP4_SQL
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_neardup import brute as components
from tests.llm.test_packing import check_placed


@pytest.fixture(scope="module", params=["sf0.001"])
def folder(request):
    return f"/root/testdata/{request.param}"


def plain_stages(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({OP4_SQL}) WHERE kept").fetchall()}
    rows = [r for r in con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall() if r[0] in good]
    yield rows
    firsts = {c for _, _, c in components(rows, 5)}
    rows = [r for r in rows if r[0] in firsts]
    yield rows
    items = con.execute(f"SELECT item_id, text FROM '{folder}/benchmark.parquet'").fetchall()
    bad = {r[0] for r in contaminated(rows, items)}
    yield [r for r in rows if r[0] not in bad]


def test_stages_equal_plain_ones(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for (name, step), want in zip(corpus_pipeline.STAGES, plain_stages(folder)):
        docs = step(spark, docs, folder)
        assert docs.columns == columns
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == sorted(want), name


def test_run_packs_what_is_left(spark, folder):
    from tokenizers import Tokenizer

    from hazlake.llm.tokens import tokenizer_path

    *_, last = plain_stages(folder)
    library = Tokenizer.from_file(tokenizer_path(corpus_pipeline.TOKENIZER))
    lengths = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in last}
    got = corpus_pipeline.run(spark, folder).collect()
    placed = {}
    for r in got:
        placed[r["doc_id"]] = placed.get(r["doc_id"], 0) + r["length"]
    assert placed == lengths
    assert check_placed(got, 4096) <= -(-sum(lengths.values()) // 4096) + 1
