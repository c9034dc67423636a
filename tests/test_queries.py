"""Every registered query against its SQL counterpart on the smallest tables."""

import datetime as dt

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from wattmill.plans import catalog, oracle
from wattmill.sources import landing, star

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The same tables as folders of part files."""
    base = tmp_path_factory.mktemp("tables")
    for t in TABLES.split():
        spark.read.parquet(f"{SF_DIR}/{t}.parquet").repartition(3).write.parquet(str(base / f"{t}.parquet"))
    return str(base)


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: v.isoformat() if isinstance(v, dt.datetime) else repr(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_contract_is_complete():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, folders, name):
    df = catalog.queries()[name](spark, folders)
    result = duck.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.collect(), df.columns) == plain(result.fetchall(), columns)


@pytest.mark.parametrize("name", ["scd1_stream", "stats_ingest_stream", "chunk_gaps", "turn_pairs", "l1"])
def test_tables_may_be_single_files(spark, folders, name):
    query = catalog.queries()[name]
    one, many = query(spark, SF_DIR), query(spark, folders)
    assert plain(many.collect(), many.columns) == plain(one.collect(), one.columns)


def test_more_than_a_thousand_chunks(spark):
    codes = spark.range(36_000).selectExpr("'F' || id AS facility_code")
    grid = landing.chunk_grid(codes, ["1d"])
    assert grid.select("chunk").distinct().count() == 1200
    path = "/landing/facility_data/interval=1d/chunk=1000/fetched_at=2024-01-05T010203Z/part-000.json"
    raw = spark.createDataFrame([("{}", path, dt.datetime(2024, 1, 5))], "raw_json string, source_file string, ingested_at timestamp")
    gaps = landing.coverage_gaps(raw, grid)
    assert gaps.count() == 1199 and gaps.where("chunk = '1000'").isEmpty()
    names = spark.range(1).select(*[landing.chunk_name(star.F.lit(n)).alias(str(n)) for n in (0, 7, 42, 999, 1000, 12345)]).first()
    assert list(names) == ["000", "007", "042", "999", "1000", "12345"]
