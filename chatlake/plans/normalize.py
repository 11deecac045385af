"""Raw tables to per-source tables to unified tables.

Every step is a pure function from DataFrames to a new snapshot; `Warehouse.swap` publishes a set of snapshots at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.functions import jsonx
from chatlake.operators import canonical, union, upsert

#: The stored rows of a key stay as they are; only what is new is added.
APPEND, SNAPSHOT = "append", "snapshot"


def web_accounts(raw: DataFrame) -> DataFrame:
    """(account_id, email, first_seen, last_seen): one row per account; the e-mail of its earliest conversation."""
    r = raw.filter(F.col("account_id").isNotNull() & (F.col("account_id") != ""))
    return r.groupBy("account_id").agg(F.min_by("account_email", F.struct(F.col("created_at").isNull(), "created_at", "account_email")).alias("email"), F.min("created_at").alias("first_seen"), F.max("updated_at").alias("last_seen"))


def merge_accounts(stored: DataFrame, new: DataFrame) -> DataFrame:
    return upsert.upsert(stored, new, ["account_id"], {"last_seen": upsert.GREATEST})


def web_conversations(raw: DataFrame) -> DataFrame:
    """(conversation_id, account_id, name, summary, created_at, updated_at)."""
    return raw.select("conversation_id", F.nullif("account_id", F.lit("")).alias("account_id"), "name", F.get_json_object("data", "$.summary").alias("summary"), "created_at", "updated_at")


def merge_web_conversations(stored: DataFrame, new: DataFrame) -> DataFrame:
    return upsert.upsert(stored, new, ["conversation_id"], {"name": upsert.TAKE, "summary": upsert.TAKE, "updated_at": upsert.GREATEST})


def agent_conversations(raw: DataFrame) -> DataFrame:
    """(conversation_id, device, project_path, created_at, updated_at): span over all devices; the device of the earliest."""
    r = raw.withColumnRenamed("timestamp", "record_ts") if "timestamp" in raw.columns else raw
    per = r.groupBy("conversation_id", "device", "project_path").agg(F.min("record_ts").alias("a"), F.max("record_ts").alias("b"))
    first = F.min_by(F.struct("device", "project_path"), F.struct(F.col("a").isNull(), "a", "device", "project_path"))
    return per.groupBy("conversation_id").agg(first.alias("f"), F.min("a").alias("created_at"), F.max("b").alias("updated_at")).select("conversation_id", "f.device", "f.project_path", "created_at", "updated_at")


def merge_agent_conversations(stored: DataFrame, new: DataFrame) -> DataFrame:
    return upsert.upsert(stored, new, ["conversation_id"], {"updated_at": upsert.GREATEST})


def agent_messages(raw: DataFrame) -> DataFrame:
    """(uuid, conversation_id, session_id, sender, content, created_at, record_type): user, assistant and summary records
    with an id, each id once, by (conversation_id, line_number)."""
    r = raw.filter(F.col("record_type").isin("user", "assistant", "summary") & F.col("record_uuid").isNotNull())
    first = r.groupBy("record_uuid").agg(F.min_by(F.struct("conversation_id", "session_id", "record_type", "data", "record_ts"), F.struct("conversation_id", "line_number")).alias("r")).select("record_uuid", "r.*")
    sender = F.when(F.col("record_type") == "user", "human").otherwise(F.col("record_type"))
    return first.select(F.col("record_uuid").alias("uuid"), "conversation_id", "session_id", sender.alias("sender"), jsonx.content_for_store(F.col("data")).alias("content"), F.col("record_ts").alias("created_at"), "record_type")


def canonical_web(messages: DataFrame) -> DataFrame:
    """Messages with is_canonical set anew."""
    return canonical.mark_canonical(messages.drop("is_canonical"), "conversation_uuid", "sender", "created_at", "uuid")


def with_parents(messages: DataFrame, raw: DataFrame) -> DataFrame:
    """Agent messages with parent_uuid of their record; ids are made unique before the join, so it does not fan out."""
    parents = raw.filter("record_uuid is not null").groupBy(F.col("record_uuid").alias("uuid")).agg(F.min_by("parent_uuid", F.struct("conversation_id", "line_number")).alias("parent_uuid"))
    return messages.join(parents, "uuid", "left")


def unified(tables: dict[str, DataFrame], stored: dict[str, DataFrame] | None = None, mode: str = SNAPSHOT) -> dict[str, DataFrame]:
    """accounts, conversations and messages from the per-source tables.

    `snapshot` computes them anew; `append` keeps every stored row and adds keys that are not there.
    """
    none = F.lit(None).cast("string")
    web = tables["web_conversations"].select("conversation_id", "account_id", "name", "summary", "created_at", "updated_at")
    agent = tables["agent_conversations"].select("conversation_id", none.alias("account_id"), none.alias("name"), none.alias("summary"), "created_at", "updated_at", "device", "project_path")
    tree = tables["tree_conversations"].select("conversation_id", none.alias("account_id"), F.col("title").alias("name"), none.alias("summary"), "created_at", "updated_at")
    wm = tables["web_messages"].select("uuid", F.col("conversation_uuid").alias("conversation_id"), "sender", "content", "created_at", F.col("parent_message_uuid").alias("parent_uuid"), "is_canonical")
    am = with_parents(tables["agent_messages"], tables["agent_raw"]).select("uuid", "conversation_id", "sender", "content", "created_at", "parent_uuid")
    tm = tables["tree_messages"].select(F.col("message_id").alias("uuid"), "conversation_id", "sender", "content", "created_at", F.col("parent_id").alias("parent_uuid"), "is_canonical")
    out = {"accounts": tables["web_accounts"].select("account_id", "email", F.lit("web").alias("source"), "first_seen", "last_seen"), "conversations": union.unified_conversations(web, agent, tree), "messages": union.unified_messages(wm, am, tm)}
    if mode == APPEND and stored:
        keys = {"accounts": "account_id", "conversations": "conversation_id", "messages": "uuid"}
        for name, key in keys.items():
            if name in stored:
                rules = {"last_seen": upsert.GREATEST} if name == "accounts" else {}
                out[name] = upsert.upsert(stored[name], out[name], [key], rules, insert_only=name != "accounts").drop("_action")
    return out


def status(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) of the unified tables."""
    from chatlake.operators.stats import table_counts

    return table_counts({k: v for k, v in tables.items() if k in ("accounts", "conversations", "messages")})
