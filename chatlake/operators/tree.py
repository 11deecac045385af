"""Exports that give a conversation as a tree of nodes: canonical path, messages, attachments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatlake.functions import jsonx, text

MAPPING = "map<string,struct<parent:string,children:array<string>,message:string>>"
#: The id of the made-up root of some exports (a fixed value).
CLIENT_ROOT = "client-created-root"


def canonical_path(mapping: Column) -> Column:
    """Ids of the nodes with a message from the root on, always by the last child.

    The root is the first entry without a parent, or with the made-up one, that is not the made-up one itself; else that
    node's first child. The walk ends at a leaf, a missing node or a node it has been at. A fold over at most as many
    steps as there are nodes; no Python.
    """
    ids = F.map_keys(mapping)
    roots = F.filter(ids, lambda i: (i != CLIENT_ROOT) & (mapping[i]["parent"].isNull() | (mapping[i]["parent"] == CLIENT_ROOT)))
    start = F.coalesce(F.try_element_at(roots, F.lit(1)), F.try_element_at(F.try_element_at(mapping, F.lit(CLIENT_ROOT))["children"], F.lit(1)))
    none = F.array().cast("array<string>")

    def step(acc: Column, _: Column) -> Column:
        cur = acc["cur"]
        node = F.try_element_at(mapping, cur)
        stop = cur.isNull() | node.isNull() | F.array_contains(acc["seen"], F.coalesce(cur, F.lit("")))
        message = F.coalesce(node["message"], F.lit("{}"))
        said = ~message.isin("{}", "null", "")
        return F.named_struct(
            F.lit("cur"), F.when(~stop, F.try_element_at(node["children"], F.lit(-1))), F.lit("seen"), F.when(stop, acc["seen"]).otherwise(F.array_append(acc["seen"], cur)), F.lit("path"), F.when(stop | ~said, acc["path"]).otherwise(F.array_append(acc["path"], cur))
        )

    zero = F.named_struct(F.lit("cur"), start, F.lit("seen"), none, F.lit("path"), none)
    return F.when(F.size(mapping) > 0, F.aggregate(F.sequence(F.lit(1), F.size(mapping)), zero, step, lambda a: a["path"])).otherwise(none)


def tree_messages(convs: DataFrame, conv: str = "conversation_id", raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """(conversation_id, message_id, parent_id, sender, content, content_type, created_at, is_canonical, assets): one row
    per node with a message, without context nodes of the user's settings and system messages without text. A message that
    names no author has the sender `unknown`. Columns `keep` of the conversations go with them."""
    m = convs.select(F.col(conv).alias("conversation_id"), *keep, F.from_json(F.get_json_object(raw, "$.mapping"), MAPPING).alias("m"))
    paths = m.select("conversation_id", *keep, "m", canonical_path(F.col("m")).alias("path"))
    nodes = paths.select("conversation_id", *keep, "path", F.explode("m").alias("message_id", "node"))
    msg = F.col("node.message")
    parts = F.from_json(F.get_json_object(msg, "$.content.parts"), "array<variant>")
    out = nodes.filter(msg.isNotNull() & ~msg.isin("{}", "null")).select(
        "conversation_id", *keep, "message_id", F.col("node.parent").alias("parent_id"), F.coalesce(F.get_json_object(msg, "$.author.role"), F.lit("unknown")).alias("sender"), text.strip_nul(text.parts_text(parts)).alias("content"), F.coalesce(F.get_json_object(msg, "$.content.content_type"), F.lit("text")).alias("content_type"), jsonx.epoch_time(F.get_json_object(msg, "$.create_time")).alias("created_at"), F.array_contains("path", F.col("message_id")).alias("is_canonical"), text.parts_assets(parts).alias("assets")
    )
    context = F.col("content_type") == "user_editable_context"
    return out.filter(~context & ~((F.col("sender") == "system") & (F.coalesce("content", F.lit("")) == "")))


def match_assets(pointers: DataFrame, members: DataFrame, archive: str = "archive") -> DataFrame:
    """(archive, asset_pointer, member): the member of the same archive that belongs to a pointer.

    The id is the pointer without its scheme. The first member that begins with it wins; failing that, the first member
    in a folder whose path contains it; an empty id has none. `members` is (archive, ordinal, member). The join is on the
    archive, so only names of one archive meet.
    """
    ids = pointers.select(archive, "asset_pointer").distinct().withColumn("asset", F.regexp_replace("asset_pointer", "^(?:sediment|file-service)://", "")).filter("asset <> ''")
    j = ids.join(members, archive)
    direct = F.startswith("member", F.col("asset"))
    nested = F.contains("member", F.lit("/")) & F.contains(F.col("member"), F.col("asset"))
    hit = j.withColumn("class", F.when(direct, 0).when(nested, 1)).filter("class is not null")
    return hit.groupBy(archive, "asset_pointer").agg(F.min_by("member", F.struct("class", "ordinal")).alias("member"))
