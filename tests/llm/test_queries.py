"""Registered queries against their SQL, and the pipeline against the same steps in plain Python."""

import os

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_counts import alnum, classes_of, hits_of
from test_texts import bare

import corpus_pipeline
from tillflow.llm import language, queries

SF_DIR = os.environ.get("TILLFLOW_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, name):
    got = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select(*columns).collect())


def test_pipeline(spark):
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    items = con.execute(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    docs = [(i, t) for i, t in docs if t and any(c.isalpha() for c in t)]
    best = {}
    for i, t in docs:
        best[bare(t)] = min(best.get(bare(t), (1, 0)), (-len(t), i))
    docs = [(i, t) for i, t in docs if best[bare(t)][1] == i]
    smallest = {i: c for i, _, c in classes_of(docs, 5, 80)}
    docs = [(i, t) for i, t in docs if smallest[i] == i]
    gone = {i for i, n, hit, _ in hits_of(docs, items, 13) if hit and 20 * hit >= n}
    docs = [(i, t) for i, t in docs if str(i) not in gone]
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    got = {r.doc_id: (r.n_tokens, r.ids) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == {i: (len(ids), ids) for i, t in docs for ids in [library.encode(t)]}
    assert len(alnum(docs[0][1])) > 0


def test_stages_keep_the_columns(spark, documents, edge_rows):
    docs = documents(edge_rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        assert stage(spark, documents([]), SF_DIR).collect() == []
        if name == "language_id":
            assert {2, 3, 4, 9}.isdisjoint({r.doc_id for r in kept.collect()})


def test_documents_without_labels_stay(spark, documents, edge_rows):
    docs = documents(edge_rows)
    held_out = language.remainder(F.col("doc_id"), 4) == 2
    want = {1, 5, 6, 7, 8, 10, None}
    for lang in (F.lit(None).cast("string"), F.when(held_out, F.col("lang"))):
        kept = corpus_pipeline.language_id(spark, docs.withColumn("lang", lang), SF_DIR).collect()
        assert {r.doc_id for r in kept} == want and len(kept) == 9


def test_every_sql_has_a_query():
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
