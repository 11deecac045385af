"""Coverage of the pipeline's stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def embedding_coverage(totals: dict[str, DataFrame], stored: DataFrame, key: str = "source_uuid") -> DataFrame:
    """(source_type, total, embedded, percent): distinct keys per source and how many have a stored vector."""
    parts = [df.select(F.lit(t).alias("source_type"), F.col(df.columns[0]).cast("string").alias("id")) for t, df in totals.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    have = stored.filter(F.col("embedding").isNotNull()).select(F.col(key).alias("id")).distinct().withColumn("has", F.lit(1))
    agg = rows.distinct().join(have, "id", "left").groupBy("source_type").agg(F.count("*").alias("total"), F.count("has").alias("embedded"))
    return agg.withColumn("percent", F.bround(F.lit(100.0) * F.col("embedded") / F.greatest(F.lit(1), F.col("total")), 0))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n): one row per table; the counts are one job each, without data at the driver."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def topic_coverage(topics: DataFrame) -> DataFrame:
    """(source_type, n_topics, n_conversations)."""
    return topics.groupBy("source_type").agg(F.countDistinct("topic_id").alias("n_topics"), F.countDistinct("conversation_id").alias("n_conversations"))


def worker_slice(df: DataFrame, key: str, workers: int) -> DataFrame:
    """`df` with rn and worker, rn numbering all rows by `key` from 1.

    The number of a row is its place within a range partition plus the rows of the partitions before, so no task sorts
    the whole table.
    """
    from chatlake.runtime import cut
    from pyspark.sql import Window as W

    ranged = cut(df.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "slices")
    sizes = {r["_part"]: r["n"] for r in ranged.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # a row per partition
    before, at = [], 0
    for p in sorted(sizes):
        before.append((p, at))
        at += sizes[p]
    ahead = df.sparkSession.createDataFrame(before, "_part int, _ahead bigint")
    inner = F.row_number().over(W.partitionBy("_part").orderBy(key))
    out = ranged.withColumn("_i", inner).join(F.broadcast(ahead), "_part").withColumn("rn", F.col("_ahead") + F.col("_i"))
    return out.withColumn("worker", (F.col("rn") - 1) % workers).drop("_part", "_i", "_ahead")
