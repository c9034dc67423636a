"""The training-data pipeline: STAGES applied one after another to ``documents``.

Every stage works on all rows its predecessor kept; its result is written as Parquet into the cluster's shared folder and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``; the last returns the encoded
documents.

Every stage takes nulls in any column, empty and very long texts, repeated rows and columns of any further name, and gives an empty table for
an empty one; what it does with them stands with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattmill.llm.chosen_path import one_of_each
from wattmill.llm.common import documents, saved, ship
from wattmill.llm.decontaminate import clean_documents
from wattmill.llm.language_id import identify
from wattmill.llm.surrogates import surrogate_texts
from wattmill.llm.word_bpe import encode

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, null texts among them, and those whose language stays unknown or undecided.

    Repeated rows are judged alike. Where no document declares a language, none is known and all go.
    """
    ship(spark)
    found = identify(docs)
    return found.where(found[found.columns[-1]]).select(*docs.columns)


def one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each class of near duplicates: the least doc_id, nulls last, ties by the text's hash.

    Repeated rows are one class, so one of them stays. Texts without words have no near duplicates and all stay.
    """
    ship(spark)
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more repeats the benchmark. Null and empty texts have no words and stay; repeated rows go or stay alike."""
    ship(spark)
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and secrets by surrogates, the same in all rows; drops nothing. Null texts stay null."""
    ship(spark)
    return surrogate_texts(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and digests of every row that is left; a null text is empty."""
    ship(spark)
    return encode(docs, digests=True)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_duplicates", one_copy),
    ("benchmark", decontaminate),
    ("personal_data", hide_personal_data),
    ("tokens", tokens),
]

# trained models, joins by chance and tokenizer files are beyond SQL: tests compare with brute force instead
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
