"""Topics of conversations: loading, segmentation, summaries, vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake import constants as K
from chatlake.functions import ids, jsonx, text
from chatlake.models import embedder as E
from chatlake.models import summarizer as S
from chatlake.operators import segment
from chatlake.runtime import cut


def web_sequence(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """(conversation_id, uuid, role, content, embedding, pos) of web messages with content, by time."""
    m = messages.filter("conversation_uuid is not null and content is not null and content <> ''").select(F.col("conversation_uuid").alias("conversation_id"), "uuid", F.col("sender").alias("role"), "content", "created_at")
    m = m.join(stored.select(F.col("source_uuid").alias("uuid"), "embedding"), "uuid", "left")
    return segment.numbered(m, "conversation_id", ["created_at", "uuid"], ["uuid"])


def agent_messages_with_text(raw: DataFrame) -> DataFrame:
    """User and assistant records with a message or a content that is not empty."""
    said = raw.filter(F.col("record_type").isin("user", "assistant") & (jsonx.has_path(F.col("data"), "message") | jsonx.has_path(F.col("data"), "content")))
    return said.filter(jsonx.content_for_topic(F.col("data")) != "")


def reembed_topics(table: DataFrame, model: E.Embedder) -> DataFrame:
    """The topics with new vectors of their summaries; without a summary they keep what they have."""
    return E.reembed(table, table.filter("topic_summary is not null").select("topic_id", F.col("topic_summary").alias("content")), model, "topic_id", "content")


def agent_sequence(raw: DataFrame, stored: DataFrame) -> DataFrame:
    """The same for user and assistant records of session logs; records without text take no place."""
    r = raw.filter(F.col("record_type").isin("user", "assistant") & (jsonx.has_path(F.col("data"), "message") | jsonx.has_path(F.col("data"), "content")))
    m = r.select("conversation_id", F.col("record_uuid").alias("uuid"), F.col("record_type").alias("role"), jsonx.content_for_topic(F.col("data")).alias("content"), "record_ts", "line_number").filter(~text.is_blank(F.col("content")))
    m = m.join(stored.select(F.col("source_uuid").alias("uuid"), "embedding"), "uuid", "left")
    return segment.numbered(m, "conversation_id", ["record_ts", "line_number", "uuid"], ["conversation_id", "line_number"])


def build_topics(messages: DataFrame, source_type: str, model: E.Embedder | None = None, summaries: S.Summarizer | None = None, threshold: float = K.SIMILARITY_THRESHOLD) -> DataFrame:
    """Rows of the topics table. A chunk without a vector is dropped; one without a summary keeps an empty one."""
    model, summaries = model or E.HashingEmbedder(), summaries or S.FirstLine()
    chunks = segment.segment(messages, threshold=threshold)
    chunks = cut(chunks.withColumn("topic_id", ids.topic_id(F.col("conversation_id"), F.col("start_msg_idx"), F.col("end_msg_idx"))), "chunks")
    short = chunks.select("topic_id", text.truncate(F.col("chunk_text"), K.CHUNK_VECTOR_CHARS, "").alias("t"))
    vecs = E.embed_texts(short, model, "topic_id", "t").filter("embedding is not null")
    named = S.summarize(chunks, summaries, ["topic_id"], "chunk_text")
    out = chunks.join(vecs, "topic_id").join(named, "topic_id", "left")
    return out.select(
        "topic_id", "conversation_id", F.lit(source_type).alias("source_type"), "start_msg_idx", "end_msg_idx", "start_msg_uuid", "end_msg_uuid", F.coalesce("topic_summary", F.lit("")).alias("topic_summary"), "chunk_text", F.col("message_count").cast("int").alias("message_count"), "embedding", F.lit(model.name).alias("model"),
        "avg_internal_sim", "boundary_sim", F.current_timestamp().alias("created_at"),
    )


def widen_vectors(table: DataFrame) -> DataFrame:
    """The schema step before vectors of another width: the vector column is dropped and added empty."""
    return table.drop("embedding").withColumn("embedding", F.lit(None).cast("array<float>"))
