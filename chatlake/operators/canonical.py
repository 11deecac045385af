"""Canonical messages: the last of each run of one sender, so that abandoned edits drop out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.operators import sequence


def mark_canonical(df: DataFrame, conv: str, sender: str, time: str, key: str) -> DataFrame:
    """`df` with is_canonical, by (time, key), null times last: true where the next message of the conversation is another
    sender's, or there is none. Null senders are equal to each other; messages without a conversation are never canonical.

    `key` is unique and not null. Only the four columns are sorted, spread over tasks whatever the size of a conversation
    (see `sequence.placed`); other columns are joined again by the key.
    """
    narrow = sequence.placed(df.select(conv, sender, time, key), conv, [time, key], {"_sender": sender})
    last = F.col("is_last") | ~F.col("_sender").eqNullSafe(F.col(sender))
    flags = narrow.select(conv, sender, time, key, (F.col(conv).isNotNull() & last).alias("is_canonical"))
    if set(df.columns) == {conv, sender, time, key}:
        return flags.select(*df.columns, "is_canonical")
    return df.join(flags.select(key, "is_canonical"), key).select(*df.columns, "is_canonical")


def canonical_counts(marked: DataFrame, by: str) -> DataFrame:
    """(by, n_canonical, n_filtered)."""
    return marked.groupBy(by).agg(F.count_if("is_canonical").alias("n_canonical"), F.count_if(~F.col("is_canonical")).alias("n_filtered"))


def branched_counts(marked: DataFrame, conv: str) -> DataFrame:
    """(n_branched, n_linear): conversations with and without filtered messages."""
    per = marked.filter(F.col(conv).isNotNull()).groupBy(conv).agg(F.bool_or(~F.col("is_canonical")).alias("branched"))
    return per.agg(F.count_if("branched").alias("n_branched"), F.count_if(~F.col("branched")).alias("n_linear"))
