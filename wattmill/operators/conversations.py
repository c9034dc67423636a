"""Usage and clean-up tables over question-and-answer conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Field names of the messages.
MESSAGES = """
    id STRING, conversation_id STRING, space_id STRING, status STRING, content STRING, created_timestamp BIGINT,
    last_updated_timestamp BIGINT, error STRUCT<error: STRING, type: STRING>,
    attachments ARRAY<STRUCT<
        attachment_id: STRING,
        query: STRUCT<
            query: STRING, description: STRING, title: STRING, instruction_id: STRING, instruction_title: STRING,
            statement_id: STRING, query_result_metadata: STRUCT<row_count: BIGINT, is_truncated: BOOLEAN>>,
        text: STRUCT<content: STRING>,
        suggested_questions: STRUCT<questions: ARRAY<STRING>>>>
"""


def _first(part: str) -> Column:
    """That part of the first attachment which has it."""
    return F.get(F.filter("attachments", lambda a: a[part].isNotNull()), F.lit(0))[part]


def conversation_usage(messages: DataFrame) -> DataFrame:
    """One row per message: question, SQL, whether a trusted asset gave it, latency and status.

    A message carries its own answer, so this is a projection: no pairing, no shuffle.
    """
    query = _first("query")
    spent = F.col("last_updated_timestamp") - F.col("created_timestamp")
    return messages.select(
        "conversation_id",
        F.col("id").alias("message_id"),
        F.col("content").alias("question"),
        query["query"].alias("sql"),
        F.coalesce(query["instruction_id"] != "", F.lit(False)).alias("trusted"),
        spent.alias("latency_ms"),
        "status",
    )


def message_details(messages: DataFrame) -> DataFrame:
    """One row per message: what came with the answer. A projection like the usage, to be joined on ``message_id`` where needed.

    ``trusted_asset`` is the title of the curated asset that answered, its id where it has no title.
    """
    query, result = _first("query"), _first("query")["query_result_metadata"]
    curated = query["instruction_id"] != ""
    return messages.select(
        "space_id",
        "conversation_id",
        F.col("id").alias("message_id"),
        query["description"].alias("description"),
        F.when(curated, F.coalesce(query["instruction_title"], query["instruction_id"])).alias("trusted_asset"),
        query["statement_id"].alias("statement_id"),
        result["row_count"].alias("row_count"),
        result["is_truncated"].alias("is_truncated"),
        _first("text")["content"].alias("text"),
        F.size(F.coalesce(_first("suggested_questions")["questions"], F.array().cast("array<string>"))).alias("suggestions"),
        F.col("error.type").alias("error_type"),
        F.col("error.error").alias("error"),
    )


def usage_summary(usage: DataFrame) -> DataFrame:
    return usage.groupBy("status", "trusted").agg(
        F.count(F.lit(1)).alias("questions"),
        F.count("sql").alias("with_sql"),
        F.avg("latency_ms").alias("avg_latency_ms"),
    )


def pair_turns(turns: DataFrame, block: int = 1024) -> DataFrame:
    """User turns of a turn-by-turn log with the next turn if the assistant took it, else NULL.

    Turn numbers may have gaps. Conversations are cut into blocks of turn numbers, so that an endless one is
    spread over many tasks: a window finds the next turn within a block, and the first turn of the next block
    that has any comes from a row per block. Turns of equal number follow role and text.
    """
    said = F.struct("turn", "role", "text")
    cut = turns.select("conv_id", F.floor(F.col("turn") / block).alias("block"), "turn", "role", "text")
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    of_conversation = Window.partitionBy("conv_id").orderBy("block")
    heads = cut.groupBy("conv_id", "block").agg(F.min(said).alias("head"))
    beyond = heads.select("conv_id", "block", F.lead("head").over(of_conversation).alias("beyond"))
    followed = cut.withColumn("within", F.lead(said).over(in_block))
    both = followed.join(beyond.alias("b"), followed.conv_id.eqNullSafe(F.col("b.conv_id")) & followed.block.eqNullSafe(F.col("b.block")), "left")
    after = F.coalesce("within", "beyond")
    return both.where(followed.role == "user").select(
        followed.conv_id, "turn", F.col("text").alias("question"), F.when(after["role"] == "assistant", after["text"]).alias("answer")
    )


def split_stale(conversations: DataFrame, as_of, hours: int = 24) -> tuple[DataFrame, DataFrame]:
    """(to delete, to keep): conversations untouched for ``hours`` before ``as_of``, and the rest.

    ``conversations`` has ``conversation_id`` and the times ``created`` and ``last_updated``. One
    without any time counts as old.
    """
    marked = mark_stale(conversations, as_of, hours)
    return marked.where("stale").drop("stale"), marked.where("NOT stale").drop("stale")


def mark_stale(conversations: DataFrame, as_of, hours: int = 24) -> DataFrame:
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    cutoff = now - F.make_interval(hours=F.lit(hours))
    touched = F.coalesce("last_updated", "created")
    return conversations.withColumn("stale", F.coalesce(touched < cutoff, F.lit(True)))
