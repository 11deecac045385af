"""Structured Streaming over the same operators: newest versions, canonical runs in event time, pending vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatlake.models import embedder as E
from chatlake.operators import reuse, upsert
from chatlake.plans.pipeline import Warehouse


def merge_stream(source: DataFrame, w: Warehouse, table: str, keys: list[str], rules: dict[str, str], newer: str, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Upsert each micro-batch into a table; older versions than the stored are dropped, late or not.

    Without `continuous` (a processing-time interval) it takes all there is and stops.
    """

    def apply(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        one = upsert.collapse(batch.withColumn("_o", F.monotonically_increasing_id()), keys, {**dict.fromkeys([c for c in batch.columns if c not in keys], upsert.KEEP), **rules}, "_o", newer=newer)
        w.merge(table, one, keys, rules, newer=newer)

    out = source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return out.trigger(processingTime=continuous).start() if continuous else out.trigger(availableNow=True).start()


def embed_stream(source: DataFrame, w: Warehouse, key: str, content: str, source_type: str, checkpoint: str, model: E.Embedder | None = None) -> StreamingQuery:
    """Vectors of new messages as they arrive; what is stored already is left out by the anti join."""
    model = model or E.HashingEmbedder()

    def apply(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        stored = w.read("message_embeddings") if w.has("message_embeddings") else batch.sparkSession.createDataFrame([], "source_uuid string, source_type string, content_hash string, embedding array<float>, model string")
        pending = reuse.pending_messages(batch.dropDuplicates([key]), stored, key, content, source_type)
        reused, rest = reuse.reuse_by_hash(pending, stored)
        new = reused.unionByName(E.embed_pending(rest.drop("content_hash"), model))
        w.merge("message_embeddings", new, ["source_uuid"], {}, insert_only=True)

    return source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def activity(source: DataFrame, time: str, by: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window, by, n): records per window with a watermark; later records are dropped."""
    return source.withWatermark(time, late).groupBy(F.window(time, window), by).agg(F.count("*").alias("n"))


def until_done(step: Callable[[], int], most: int = 1000) -> int:
    """Run a step again and again until it makes no progress; the number of rounds."""
    for i in range(most):
        if not step():
            return i
    return most


def read_table_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
