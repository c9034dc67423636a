"""Queries against their SQL, and the pipeline against brute force."""

import duckdb
import pytest
import test_chosen_path
import test_decontaminate
import test_word_bpe

import corpus_pipeline
from wattmill.llm import common, queries, surrogates

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "conversations")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    found = queries.queries()[name](spark, SF_DIR)
    result = con.execute(queries.oracle_sql()[name])
    columns = sorted(d[0] for d in result.description)
    assert sorted(found.columns) == columns
    order = [d[0] for d in result.description]
    want = sorted(str(tuple(row[order.index(c)] for c in columns)) for row in result.fetchall())
    assert sorted(str(tuple(r[c] for c in columns)) for r in found.collect()) == want


def test_names_of_the_queries():
    assert [n.split("_")[0] for n in queries.queries()][:10] == [f"op{i}" for i in range(1, 11)]


def test_pipeline_equals_brute_force(spark, texts):
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    rows = sorted(texts.items())
    names, _ = test_chosen_path.brute_force(rows)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    firsts = [(d, t) for (d, t), name in zip(rows, names, strict=True) if d == name]
    clean = [(d, t) for d, t in firsts if not test_decontaminate.brute_force(t, items)[4]]
    assert sorted(found) == [d for d, _ in clean]
    for d, t in clean:
        if not surrogates.find(t):
            assert found[d].n_tokens == len(test_word_bpe.expected(t)[0])


def test_stages_return_the_columns_of_documents(spark, frame):
    docs = frame([(1, "the house and the garden were quiet that morning")] * 2, "kept", "language", "first")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns


def test_stages_take_nulls_repeated_rows_and_empty_tables(spark, frame, odd):
    plain = [(100 + i, f"the house and the garden were quiet that morning when they walked along the river {i}") for i in range(30)]
    docs = frame([*odd, *plain])
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF_DIR).collect()
        ids = {r.doc_id for r in found}
        assert len(found) <= len(odd) + len(plain), name
        if name in ("language", "near_duplicates", "benchmark"):
            assert len(ids & set(range(100, 130))) == (1 if name == "near_duplicates" else 30), name
        else:
            assert len(found) == len(odd) + len(plain), name
        assert stage(spark, frame([]), SF_DIR).collect() == [], name


def test_stages_do_not_depend_on_how_rows_are_batched(spark, sample, monkeypatch):
    def kept():
        # each stage asks for its batches when it is called
        return [sorted((r.doc_id, r.text) for r in stage(spark, sample, SF_DIR).collect()) for _, stage in corpus_pipeline.STAGES[:4]]

    want = kept()
    with monkeypatch.context() as small:
        small.setattr(common, "BATCH_BYTES", 20_000)
        assert kept() == want
    common.ship(spark)
