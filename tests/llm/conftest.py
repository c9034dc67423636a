import pytest
from pyspark.sql import types as T

from wattmill.llm.common import ship

COLUMNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text) pairs or (doc_id, text, lang, source) rows, with extra columns on demand."""

    def make(rows, *extra):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "src1")), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, COLUMNS).repartition(3)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(sample):
    return {r.doc_id: r.text for r in sample.collect()}


ODD = [
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "Same words here, and the same words there."),
    (4, "Same words here, and the same words there."),
    (5, "é ü 漢字 \U0001f600 <|endoftext|> ΣΑΣ don't 12.5"),
    (6, "á ́x  y\x1cz"),
    (7, "word " * 30_000),
]


@pytest.fixture(scope="session")
def odd():
    return ODD
