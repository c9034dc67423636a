"""The registered queries of the subpackage; thin calls of the operators with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.llm import oracle
from wattmill.llm.adaptive_quality import adaptive_quality
from wattmill.llm.chosen_path import near_duplicates
from wattmill.llm.common import documents, ship
from wattmill.llm.decontaminate import contamination
from wattmill.llm.interleave import interleave
from wattmill.llm.interpolation import scores
from wattmill.llm.language_id import identify, pages_as_documents
from wattmill.llm.merkle import proofs
from wattmill.llm.prefix_trie import shared_prefixes
from wattmill.llm.quality_classifier import quality_scores
from wattmill.llm.rans import token_files
from wattmill.llm.surrogates import surrogate_texts
from wattmill.llm.unit_dedup import unit_dedup
from wattmill.llm.word_bpe import encode

Query = Callable[[SparkSession, str], DataFrame]


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    return surrogate_texts(docs, counts="n_entities")


def op2_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(documents(spark, sf_dir))


def op3_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir))


def op5_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(documents(spark, sf_dir)).drop("source")


def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links", "n_copies")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(documents(spark, sf_dir))
    return found.select("doc_id", F.col("lang").alias("declared"), "language", "text_language", "posterior", "kept")


def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pages_as_documents(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    found = identify(pages, host="host", suffix="suffix", key="page_id")
    return found.select("page_id", F.col("lang").alias("declared"), "language", "text_language", "posterior", "kept")


def op8_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir), digests=True)


def op9_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = unit_dedup(documents(spark, sf_dir))
    spans = F.array_join(F.transform("removed", lambda x: F.concat_ws("-", x.start, x.stop)), ",")
    return found.withColumn("removed", spans)


def op10_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return adaptive_quality(documents(spark, sf_dir)).select(*columns)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_prefixes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proofs(documents(spark, sf_dir))


def op13_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = (
    op1_surrogates,
    op2_deleted_interpolation,
    op3_wu_manber,
    op4_rans,
    op5_interleave,
    op6_chosen_path,
    op7_language_id,
    op8_word_bpe,
    op9_unit_dedup,
    op10_adaptive_quality,
    op11_prefix_trie,
    op12_merkle_proofs,
    op13_fourier_quality,
    language_of_pages,
)


def queries() -> dict[str, Query]:
    return {fn.__name__: _shipped(fn) for fn in QUERIES}


def _shipped(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    return run


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
