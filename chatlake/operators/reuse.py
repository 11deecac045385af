"""Pending texts and the reuse of vectors by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake import constants as K
from chatlake.functions import jsonx
from chatlake.functions.text import content_hash


def pending_messages(messages: DataFrame, stored: DataFrame, key: str, content: str, source_type: str, canonical: bool = False, limit: int | None = None) -> DataFrame:
    """(source_uuid, source_type, content): messages with content and without a vector. The limit takes the smallest ids."""
    rows = messages.filter(F.col(content).isNotNull() & (F.col(content) != ""))
    if canonical:
        rows = rows.filter("is_canonical")
    rows = rows.join(stored.select(F.col("source_uuid").alias(key)), key, "left_anti").select(F.col(key).alias("source_uuid"), F.lit(source_type).alias("source_type"), F.col(content).alias("content"))
    return rows.orderBy("source_uuid").limit(limit) if limit else rows


def pending_records(raw: DataFrame, stored: DataFrame, limit: int | None = None, max_chars: int = K.MAX_RECORD_CHARS) -> DataFrame:
    """The same for session-log records: user and assistant records with an id, below the size limit and without images."""
    rows = raw.filter(F.col("record_type").isin("user", "assistant") & F.col("record_uuid").isNotNull()).filter(F.length(F.coalesce(jsonx.compact(F.col("data")), F.col("data"))) < max_chars).filter(~jsonx.has_image(F.col("data")))
    rows = rows.join(stored.select(F.col("source_uuid").alias("record_uuid")), "record_uuid", "left_anti")
    rows = rows.select(F.col("record_uuid").alias("source_uuid"), F.lit("code").alias("source_type"), jsonx.content_for_vector(F.col("data")).alias("content"))
    return rows.orderBy("source_uuid").limit(limit) if limit else rows


def reuse_by_hash(pending: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reused, rest).

    reused: (source_uuid, source_type, content_hash, embedding, model), for pending texts whose hash has a stored vector;
    of several stored rows that of the smallest id. rest: the pending rows that still need a model. Vectors are shuffled
    once per hash, not per stored row.
    """
    hashed = pending.withColumn("content_hash", content_hash(F.col("content")))
    known = stored.filter(F.col("embedding").isNotNull() & F.col("content_hash").isNotNull()).groupBy("content_hash").agg(F.min_by(F.struct("embedding", "model"), "source_uuid").alias("k"))
    hit = hashed.join(known, "content_hash")
    reused = hit.select("source_uuid", "source_type", "content_hash", "k.embedding", "k.model")
    return reused, hashed.join(known.select("content_hash"), "content_hash", "left_anti")


def first_by_hash(df: DataFrame, key: str, text: str) -> DataFrame:
    """(content_hash, first_id, n): each distinct text with its smallest id and the number of rows."""
    return df.groupBy(content_hash(F.col(text)).alias("content_hash")).agg(F.min(key).alias("first_id"), F.count("*").alias("n"))


def stored_contents(stored: DataFrame, agent: DataFrame, web: DataFrame) -> DataFrame:
    """(source_uuid, content) of stored vectors (source_uuid, source_type): the text of the message each belongs to, the
    agent's (uuid, content) for `code`, the web's for `web`, null where there is none. Ids are made unique first."""
    side = lambda df, kind: df.groupBy(F.col("uuid").alias("source_uuid")).agg(F.min("content").alias(f"{kind}_content")).withColumn("source_type", F.lit(kind))
    on = ["source_uuid", "source_type"]
    j = stored.select(*on).join(side(agent, "code"), on, "left").join(side(web, "web"), on, "left")
    return j.select("source_uuid", F.coalesce("code_content", "web_content").alias("content"))
