"""Exports in ZIP archives: an array of conversations and, in tree exports, members with attachments."""

from __future__ import annotations

import io
import json
import os
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.functions import ids, jsonx, text

MEMBER = "conversations.json"
#: Suffixes that a dry run counts as attachments (fixed values).
ATTACHMENT_SUFFIXES = [".png", ".jpg", ".jpeg", ".webp", ".pdf", ".csv"]


def list_archives(roots: list[str], limit: int | None = None) -> list[str]:
    """Archives of the roots, each sorted by name, roots in their order, without repeats of one path."""
    found: dict[str, None] = {}
    for r in roots:
        if os.path.isdir(r):
            found |= dict.fromkeys(os.path.join(r, n) for n in sorted(os.listdir(r)) if n.endswith(".zip"))
    return list(found)[:limit]


def read_archives(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(conversations, members, errors).

    conversations: (archive, file_ordinal, ordinal, raw), one row per element. members: (archive, ordinal, member).
    errors: (archive, error) of archives that cannot be read, which give nothing else. Each archive is opened in one
    task; elements are passed on in groups, so a large export does not become one batch.
    """
    order = spark.createDataFrame([(f"file:{p}" if "://" not in p and not p.startswith("file:") else p, i) for i, p in enumerate(paths)], "archive string, file_ordinal int")
    files = spark.read.format("binaryFile").load(paths).select("path", "content") if paths else spark.createDataFrame([], "path string, content binary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["archive", "kind", "ordinal", "value"]
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        items, names = json.loads(z.read(MEMBER)), z.namelist()
                    if not isinstance(items, list):
                        raise ValueError("no array")  # noqa: TRY301
                except Exception as e:  # noqa: BLE001 - any unreadable archive is an error row
                    yield pd.DataFrame([(path, "error", 0, str(e)[:200])], columns=cols)
                    continue
                yield pd.DataFrame([(path, "member", i, n) for i, n in enumerate(names)], columns=cols)
                for at in range(0, len(items), 500):
                    yield pd.DataFrame([(path, "item", i, json.dumps(x, ensure_ascii=False)) for i, x in enumerate(items[at : at + 500], at)], columns=cols)

    from chatlake.runtime import cut

    rows = cut(files.mapInPandas(run, "archive string, kind string, ordinal int, value string").withColumn("archive", F.regexp_replace("archive", "^file:/+", "file:/")), "archives")
    order = order.withColumn("archive", F.regexp_replace("archive", "^file:/+", "file:/"))
    items = rows.filter("kind = 'item'").join(F.broadcast(order), "archive").select("archive", "file_ordinal", "ordinal", F.col("value").alias("raw"))
    return items, rows.filter("kind = 'member'").select("archive", "ordinal", F.col("value").alias("member")), rows.filter("kind = 'error'").select("archive", F.col("value").alias("error"))


def web_conversations(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, errors) of a web export. An account that is null, not missing, makes an error."""
    g = lambda p: F.get_json_object("raw", p)
    bad = F.col("raw").rlike(r'"account"\s*:\s*null')
    out = items.filter(~bad).select(
        "archive", "file_ordinal", "ordinal", g("$.uuid").alias("conversation_id"), F.coalesce(g("$.account.uuid"), F.lit("")).alias("account_id"), F.coalesce(g("$.account.email_address"), F.lit("")).alias("account_email"), text.display_name(g("$.name"), g("$.summary")).alias("name"), g("$.summary").alias("summary"),
        jsonx.iso_time(g("$.created_at")).alias("created_at"), jsonx.iso_time(g("$.updated_at")).alias("updated_at"), text.strip_nul_json(F.col("raw")).alias("data"), F.regexp_extract("archive", "[^/]+$", 0).alias("source_file"),
    )
    return out, items.filter(bad).select("archive", "ordinal", F.lit("account is null").alias("error"))


def web_messages(convs: DataFrame) -> DataFrame:
    """Messages of the conversations (with data), as written in `chat_messages`."""
    m = convs.select("conversation_id", "file_ordinal", F.posexplode(F.from_json(F.get_json_object("data", "$.chat_messages"), "array<string>")).alias("i", "raw_data"))
    g = lambda p: F.get_json_object("raw_data", p)
    return m.select(
        g("$.uuid").alias("uuid"), F.col("conversation_id").alias("conversation_uuid"), g("$.sender").alias("sender"), text.message_text(F.from_json(g("$.content"), text.BLOCKS), g("$.text")).alias("content"), jsonx.iso_time(g("$.created_at")).alias("created_at"), jsonx.iso_time(g("$.updated_at")).alias("updated_at"),
        g("$.parent_message_uuid").alias("parent_message_uuid"), jsonx.filled_only(attachments=g("$.attachments"), files=g("$.files")).alias("metadata"), "raw_data", "file_ordinal", "i",
    )


def tree_conversations(items: DataFrame) -> DataFrame:
    """Conversations of a tree export; one without an id gets a hash of its mapping."""
    g = lambda p: F.get_json_object("raw", p)
    return items.select("archive", "file_ordinal", "ordinal", ids.tree_conversation_id(F.col("raw")).alias("conversation_id"), g("$.title").alias("title"), jsonx.epoch_time(g("$.create_time")).alias("created_at"), jsonx.epoch_time(g("$.update_time")).alias("updated_at"), text.strip_nul_json(F.col("raw")).alias("raw"))


def dry_run(items: DataFrame, members: DataFrame) -> DataFrame:
    """(archive, n_conversations, n_messages, n_attachments)."""
    n = items.groupBy("archive").agg(F.count("*").alias("n_conversations"), F.sum(F.coalesce(F.json_array_length(F.get_json_object("raw", "$.chat_messages")), F.lit(0))).alias("n_messages"))
    ends = F.lit(False)
    for s in ATTACHMENT_SUFFIXES:
        ends = ends | F.endswith("member", F.lit(s))
    a = members.groupBy("archive").agg(F.count_if(ends).alias("n_attachments"))
    return n.join(a, "archive", "left").fillna(0, ["n_attachments"])
