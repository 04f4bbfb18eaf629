import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.check_oracles import compare
from vicinal.llm import queries
from vicinal.llm.simhash import fingerprint
from .conftest import DATA, frame, least_reachable, needs_data


@needs_data
@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    text, _, ok = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), DATA)
    assert ok, text


@needs_data
def test_stages(spark):
    from vicinal.llm import mixing, pieces, secrets, toxicity

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        before, rows = rows, corpus_pipeline.cut(stage(spark, rows, DATA), "test")
        if name == corpus_pipeline.STAGES[-1][0]:
            break
        assert rows.columns == docs.columns and rows.count() > 0
        old, new = before.collect(), rows.collect()
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.score(before, toxicity.train(before, labels)).collect() if r.score >= 0.5}
            assert sorted(new) == sorted(r for r in old if r.doc_id not in bad)
        elif name.startswith("simhash"):
            old.sort(key=lambda r: r.doc_id)
            fps = [fingerprint(r.text.encode()) & (1 << 64) - 1 for r in old]
            root = least_reachable(len(old), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
            assert sorted(new) == sorted(r for i, r in enumerate(old) if root[i] == i)
        elif name == "secret scan":
            assert {r.doc_id: r.text for r in new} == {r.doc_id: secrets.redacted(r.text) for r in old}
        else:
            copies = {r.doc_id: r.copies for r in mixing.mixed(before).collect()}
            assert sorted(new) == sorted(r for r in old for _ in range(copies[r.doc_id]))
    sent = {(r.doc_id, r.text) for r in before.collect()}
    assert {(r.doc_id, r.text) for r in rows.collect()} == sent and rows.count() == before.count()
    assert pieces.Decoder(pieces.load()).decode(__import__("numpy").array(rows.first().ids)) == rows.first().text


@needs_data
def test_stages_stand_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and repeated rows, an extra column: no stage fails, and documents without cause stay."""
    spark.read.parquet(f"{DATA}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    odd = [(1, None, None, None, None, "e"), (2, "", "en", "s", 0, "e"), (3, "some plain words here", "en", "s", 21, "e"), (3, "some plain words here", "en", "s", 21, "e"),
           (None, "other words stand here", "en", None, 22, None), (5, "word " * 40_000, "en", "s", 200_000, "e")]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("*", "'x' as ids")
    rows = docs.unionByName(frame(spark, odd, "doc_id long, text string, lang string, source string, n_chars long, ids string").selectExpr("doc_id + 100000 as doc_id", "text", "lang", "source", "n_chars", "ids"))
    for name, stage in corpus_pipeline.STAGES:
        rows = corpus_pipeline.cut(stage(spark, rows, str(tmp_path)), "test")
        if name == "simhash near-dedup":
            ids = [r.doc_id for r in rows.collect()]
            assert ids.count(100003) == 1 and 100005 in ids and None in ids and 100001 in ids and 100002 not in ids
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
    assert empty.collect() == []
