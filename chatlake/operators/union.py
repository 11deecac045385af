"""Unified tables: ordered unions by key in which the first source that has a key wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_wins(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of all sources, one per key: from the first source that has it. Columns that a source lacks are null.

    Within a source the row with the smallest values is taken, so the result does not depend on the order of rows. One
    aggregate, which combines before its shuffle.
    """
    tagged = [s.withColumn("_priority", F.lit(i)) for i, s in enumerate(sources)]
    allrows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rest = [c for c in allrows.columns if c not in (*keys, "_priority")]
    best = allrows.groupBy(*keys).agg(F.min(F.struct("_priority", *rest)).alias("b"))
    return best.select(*keys, *[F.col(f"b.{c}").alias(c) for c in rest])


def unified_conversations(web: DataFrame, agent: DataFrame, tree: DataFrame) -> DataFrame:
    """Conversations of the three sources with their source."""
    return first_wins([web.withColumn("source", F.lit("web")), agent.withColumn("source", F.lit("code")), tree.withColumn("source", F.lit("chatgpt"))], ["conversation_id"])


def unified_messages(web: DataFrame, agent: DataFrame, tree: DataFrame) -> DataFrame:
    """(uuid, conversation_id, sender, content, created_at, parent_uuid): canonical web messages, all agent messages,
    canonical tree messages. `user` becomes `human`."""
    cols = ["conversation_id", "sender", "content", "created_at", "parent_uuid"]
    human = F.when(F.col("sender") == "user", "human").otherwise(F.col("sender")).alias("sender")
    pick = lambda d: d.select("uuid", *[human if c == "sender" else F.col(c) for c in cols])
    return first_wins([pick(web.filter("is_canonical")), pick(agent), pick(tree.filter("is_canonical"))], ["uuid"])
