"""The queries pN_ of the training-data problems (but for those of the core), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.llm import conversations, credentials, encoding, formatting, mixing, pii, splitting, tokens, vectors
from chatlake.runtime import cut, load

CASES = ["no_turns", "first_not_human", "last_not_assistant", "unknown_sender", "no_time", "lost_parent"]


def _messages(spark: SparkSession, d: str, links: bool = True) -> DataFrame:
    """The messages; with the links of the logs, which are all between messages of one conversation, or as they are stated."""
    web = conversations.messages(load(spark, d, "claude_web_messages"), "web", "conversation_uuid", "uuid", "parent_message_uuid")
    code = conversations.messages(load(spark, d, "claude_code_messages"), "code", "conversation_id", "uuid", None)
    if links:
        code = conversations.with_links(cut(code, "code"), load(spark, d, "claude_code_raw"), "record_uuid", "parent_uuid")
    return cut(web.unionByName(code), "messages")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The cases are defined by the clock and the stated parents, so neither Kahn's order nor the links of the logs, which
    `p1_turns` needs, can change them, and neither is made."""
    checked = conversations.check_by_clock(_messages(spark, d, links=False))
    return checked.filter(F.arrays_overlap("clock_reasons", F.array(*map(F.lit, CASES)))).select("source_type", "conversation_id")


def p1_turns(spark: SparkSession, d: str) -> DataFrame:
    """The turns of the whole conversations, without their texts."""
    msgs = _messages(spark, d)
    order = conversations.kahn_order(msgs)
    return conversations.ordered_conversations(msgs, conversations.check_conversations(msgs, order), order)


def p1_conversations(spark: SparkSession, d: str) -> DataFrame:
    texts = conversations.texts(load(spark, d, "claude_web_messages"), "web", "uuid").unionByName(conversations.texts(load(spark, d, "claude_code_messages"), "code", "uuid"))
    return p1_turns(spark, d).join(texts, ["source_type", "uuid"])


def _redacted(spark: SparkSession, d: str) -> DataFrame:
    msg = credentials.redact_column(load(spark, d, "claude_code_messages"), ["conversation_id", "uuid"], "content")
    raw = credentials.redact_column(load(spark, d, "claude_code_raw"), ["conversation_id", "line_number"], "data")
    msg = msg.select(F.lit("claude_code_messages").alias("table_name"), "conversation_id", F.col("uuid").alias("record_id"), "text", "n_found")
    return msg.unionByName(raw.select(F.lit("claude_code_raw").alias("table_name"), "conversation_id", F.col("line_number").cast("string").alias("record_id"), "text", "n_found"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _redacted(spark, d).select("table_name", "conversation_id", "record_id")


def p2_redacted(spark: SparkSession, d: str) -> DataFrame:
    return _redacted(spark, d)


def _rooted(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    web, emb = load(spark, d, "claude_web_messages"), load(spark, d, "message_embeddings")
    return {"claude_web_messages": formatting.roots(web, "uuid", "content"), "message_embeddings": formatting.hash_roots(emb, "source_uuid", "content_hash")}


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [formatting.collapse(r)[1].select(F.lit(t).alias("table_name"), "id_keep", "id_copy") for t, r in _rooted(spark, d).items()]
    return parts[0].unionByName(parts[1])


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    parts = [formatting.collapse(r)[0].select(F.lit(t).alias("table_name"), "id_keep", "n_copies") for t, r in _rooted(spark, d).items()]
    return parts[0].unionByName(parts[1])


_VECTORS = {"message_embeddings": ("source_uuid", "updated_at"), "conversation_topics": ("topic_id", "created_at")}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [vectors.similar_pairs(load(spark, d, t), i, "embedding", newest=new).select(F.lit(t).alias("table_name"), "id_a", "id_b") for t, (i, new) in _VECTORS.items()]
    return parts[0].unionByName(parts[1])


def p4_neighbours(spark: SparkSession, d: str) -> DataFrame:
    parts = [vectors.most_similar(load(spark, d, t), i, "embedding", newest=new).select(F.lit(t).alias("table_name"), "*") for t, (i, new) in _VECTORS.items()]
    return parts[0].unionByName(parts[1])


def _limits(spark: SparkSession, d: str) -> dict[str, tuple[int, int]]:
    return {r["field_name"]: (r["max_chars"], r["overlap_chars"]) for r in load(spark, d, "split_limits").collect()}  # a row per field


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    lim = _limits(spark, d)
    web = splitting.split_oversized(load(spark, d, "claude_web_messages"), "uuid", "content", *lim["claude_web_messages.content"])
    top = splitting.split_oversized(load(spark, d, "conversation_topics"), "topic_id", "chunk_text", *lim["conversation_topics.chunk_text"])
    return web.select(F.lit("claude_web_messages").alias("table_name"), "*").unionByName(top.select(F.lit("conversation_topics").alias("table_name"), "*"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_pieces(spark, d).filter("piece_no = 0").select("table_name", "item_id")


def p5_cover(spark: SparkSession, d: str) -> DataFrame:
    """The oversized items put together again from their pieces, and whether these keep to the limit and the overlap."""
    lim = {k.split(".")[0]: v for k, v in _limits(spark, d).items()}
    p = p5_pieces(spark, d).join(spark.createDataFrame([(k, *v) for k, v in lim.items()], "table_name string, most int, lap int"), "table_name")  # two rows
    own = F.when(F.col("piece_no") == 0, F.col("text")).otherwise(F.expr("substr(text, lap + 1)"))
    parts = p.groupBy("table_name", "item_id", "lap").agg(F.array_sort(F.collect_list(F.struct("piece_no", "start", "end", own.alias("own")))).alias("l"), F.min(F.col("end") - F.col("start") <= F.col("most")).alias("within"))
    laps = F.forall(F.sequence(F.lit(1), F.size("l") - 1), lambda i: F.element_at("l", i)["end"] - F.element_at("l", i + 1)["start"] == F.col("lap"))
    return parts.select("table_name", "item_id", F.md5(F.array_join(F.transform("l", lambda e: e["own"]), "")).alias("digest"), (F.col("within") & ((F.size("l") == 1) | laps)).alias("kept"))


def p6_redacted(spark: SparkSession, d: str) -> DataFrame:
    names = load(spark, d, "name_list")
    parts = [pii.redact_people(load(spark, d, t), i, "content", names).select(F.lit(t).alias("table_name"), "*") for t, i in (("claude_web_messages", "uuid"), ("chatgpt_messages", "message_id"))]
    return parts[0].unionByName(parts[1])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_redacted(spark, d).select("table_name", "record_id", F.explode("kinds").alias("kind"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_column(load(spark, d, "documents"), "doc_id", "text")


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Digests of the texts that the ids decode to."""
    return tokens.decode_column(p8_ids(spark, d), "doc_id", "ids").select("doc_id", F.md5("text").alias("digest"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(load(spark, d, "documents"), load(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(load(spark, d, "documents"), load(spark, d, "mix_targets"))[1]


def p9_shard_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shard_shares(mixing.mix(load(spark, d, "documents"), load(spark, d, "mix_targets"))[0])


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.find_garbled(load(spark, d, "documents"), "doc_id", "text")[0].select(F.col("id").alias("doc_id"))


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.restore_garbled(load(spark, d, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_turns, p1_conversations, p2_found, p2_redacted, p3_found, p3_groups, p4_found, p4_neighbours, p5_found, p5_pieces, p5_cover, p6_found, p6_redacted, p8_ids, p8_decoded, p9_mix, p9_shares, p9_shard_shares, p10_found, p10_restored)}


_BLANK = r"regexp_matches({0}, '[^\s\x0b\x1c-\x1f\x85\xa0\p{{Z}}]')"

_P1 = rf"""
WITH web AS (
  SELECT DISTINCT ON (uuid) 'web' AS source_type, conversation_uuid AS conversation_id, uuid, sender, content, created_at, parent_message_uuid AS parent
  FROM claude_web_messages WHERE conversation_uuid IS NOT NULL AND uuid IS NOT NULL),
code AS (
  SELECT DISTINCT ON (uuid) 'code' AS source_type, conversation_id, uuid, sender, content, created_at, NULL::varchar AS parent
  FROM claude_code_messages WHERE conversation_id IS NOT NULL AND uuid IS NOT NULL),
m AS (
  SELECT *, CASE WHEN s IN ('human', 'user') THEN 'human' WHEN s = 'assistant' THEN s WHEN s IN ('system', 'tool', 'summary') THEN 'aside' ELSE 'unknown' END AS role,
    NOT coalesce({_BLANK.format('content')}, false) AS blank
  FROM (SELECT *, lower(trim(sender, E' \t\n\r')) AS s FROM (SELECT * FROM web UNION ALL SELECT * FROM code))),
a AS (
  SELECT source_type, conversation_id,
    count(*) FILTER (role IN ('human', 'assistant') AND NOT blank) AS n,
    first(role ORDER BY created_at ASC NULLS LAST, uuid) FILTER (role IN ('human', 'assistant') AND NOT blank) AS f,
    last(role ORDER BY created_at ASC NULLS LAST, uuid) FILTER (role IN ('human', 'assistant') AND NOT blank) AS l,
    count(*) FILTER (NOT blank AND role <> 'aside' AND (role = 'unknown' OR created_at IS NULL)) AS odd,
    count(*) FILTER (parent IS NOT NULL AND NOT EXISTS (SELECT 1 FROM m p WHERE p.uuid = m.parent AND p.conversation_id = m.conversation_id AND p.source_type = m.source_type)) AS lost
  FROM m GROUP BY ALL)
SELECT source_type, conversation_id FROM a WHERE n = 0 OR f <> 'human' OR l <> 'assistant' OR odd > 0 OR lost > 0
"""

_P1_TURNS = r"""
WITH RECURSIVE web AS (
  SELECT DISTINCT ON (uuid) 'web' AS source_type, conversation_uuid AS conversation_id, uuid, sender, content, created_at, parent_message_uuid AS parent
  FROM claude_web_messages WHERE conversation_uuid IS NOT NULL AND uuid IS NOT NULL ORDER BY uuid, updated_at),
code AS (
  SELECT DISTINCT ON (uuid) 'code' AS source_type, conversation_id, uuid, sender, content, created_at
  FROM claude_code_messages WHERE conversation_id IS NOT NULL AND uuid IS NOT NULL),
links AS (SELECT record_uuid AS uuid, min(parent_uuid) AS parent FROM claude_code_raw WHERE record_uuid IS NOT NULL AND parent_uuid IS NOT NULL GROUP BY 1),
linked AS (SELECT code.*, l.parent FROM code LEFT JOIN (SELECT links.uuid, links.parent FROM links JOIN code c ON c.uuid = links.uuid JOIN code p ON p.uuid = links.parent AND p.conversation_id = c.conversation_id) l USING (uuid)),
m AS (
  SELECT *, CASE WHEN s IN ('human', 'user') THEN 'human' WHEN s = 'assistant' THEN s WHEN s IN ('system', 'tool', 'summary') THEN 'aside' ELSE 'unknown' END AS role,
    NOT coalesce({blank}, false) AS blank, coalesce(lpad(epoch_us(created_at)::varchar, 20, '0'), '~') || ' ' || uuid AS k
  FROM (SELECT *, lower(trim(sender, E' \t\n\r')) AS s FROM (SELECT * FROM web UNION ALL SELECT * FROM linked))),
e AS (
  SELECT source_type, conversation_id, uuid, k, k AS eff, 0 AS level FROM m WHERE parent IS NULL OR NOT EXISTS (SELECT 1 FROM m p WHERE p.uuid = m.parent AND p.conversation_id = m.conversation_id AND p.source_type = m.source_type)
  UNION ALL
  SELECT m.source_type, m.conversation_id, m.uuid, m.k, greatest(e.eff, m.k), CASE WHEN e.eff > m.k THEN e.level + 1 ELSE 0 END
  FROM m JOIN e ON m.parent = e.uuid AND m.conversation_id = e.conversation_id AND m.source_type = e.source_type),
t AS (SELECT m.*, e.eff, e.level, e.uuid IS NULL AS cyclic FROM m LEFT JOIN e USING (source_type, conversation_id, uuid)),
a AS (
  SELECT source_type, conversation_id,
    count(*) FILTER (role IN ('human', 'assistant') AND NOT blank) AS n,
    first(role ORDER BY eff, level, k) FILTER (role IN ('human', 'assistant') AND NOT blank) AS f,
    last(role ORDER BY eff, level, k) FILTER (role IN ('human', 'assistant') AND NOT blank) AS l,
    count(*) FILTER (cyclic OR NOT blank AND role <> 'aside' AND (role = 'unknown' OR created_at IS NULL)) AS odd,
    count(*) FILTER (parent IS NOT NULL AND NOT EXISTS (SELECT 1 FROM m p WHERE p.uuid = t.parent AND p.conversation_id = t.conversation_id AND p.source_type = t.source_type)) AS lost
  FROM t GROUP BY ALL),
good AS (SELECT source_type, conversation_id FROM a WHERE n > 0 AND f = 'human' AND l = 'assistant' AND odd = 0 AND lost = 0)
SELECT source_type, conversation_id, row_number() OVER w - 1 AS turn_no, uuid, role, created_at, lag(role) OVER w AS after{more}
FROM t SEMI JOIN good USING (source_type, conversation_id) WHERE role IN ('human', 'assistant') AND NOT blank
WINDOW w AS (PARTITION BY source_type, conversation_id ORDER BY eff, level, k)
""".replace("{blank}", _BLANK.format("content"))

_P5 = """
SELECT DISTINCT 'claude_web_messages' AS table_name, uuid AS item_id FROM claude_web_messages
WHERE length(content) > (SELECT max_chars FROM split_limits WHERE field_name = 'claude_web_messages.content')
UNION ALL
SELECT DISTINCT 'conversation_topics', topic_id FROM conversation_topics
WHERE length(chunk_text) > (SELECT max_chars FROM split_limits WHERE field_name = 'conversation_topics.chunk_text')
"""


_P3 = r"""
WITH w AS (SELECT DISTINCT ON (uuid) uuid AS id, content AS c FROM claude_web_messages WHERE uuid IS NOT NULL AND regexp_matches(content, '[\p{L}\p{N}]')),
k AS (SELECT *, regexp_matches(c, '^[\s\p{Z}\x{FEFF}]*\{') AND json_valid(c) AND coalesce(json_type(CASE WHEN json_valid(c) THEN c END) = 'OBJECT', false) AS o FROM w),
t AS (SELECT id, 't' || lower(regexp_replace(upper(c), '[^\p{L}\p{N}]+', '', 'g')) AS canon FROM k WHERE NOT o),
j AS (SELECT k.id, lower(regexp_replace(upper(e.fullkey), '[^\p{L}\p{N}\[\].$]+', '', 'g')) || '=' || CASE WHEN e.type IN ('OBJECT', 'ARRAY') THEN e.type ELSE lower(regexp_replace(upper(e.atom->>'$'), '[^\p{L}\p{N}]+', '', 'g')) END AS leaf
  FROM k, json_tree(k.c) e WHERE o),
g AS (SELECT id, 'o' || string_agg(coalesce(leaf, '-'), '|' ORDER BY leaf) AS canon FROM j GROUP BY id),
m AS (SELECT DISTINCT source_uuid AS id, lower(regexp_replace(content_hash, '[\s\p{P}\p{S}\p{C}\p{Z}]+', '', 'g')) AS canon FROM message_embeddings WHERE source_uuid IS NOT NULL),
a AS (SELECT 'claude_web_messages' AS table_name, * FROM (SELECT * FROM t UNION ALL SELECT * FROM g) UNION ALL SELECT 'message_embeddings', * FROM m WHERE canon <> '')"""
_P3_FOUND = f"{_P3}, f AS (SELECT *, min(id) OVER (PARTITION BY table_name, canon) AS id_keep FROM a) SELECT DISTINCT table_name, id_keep, id AS id_copy FROM f WHERE id <> id_keep"
_P3_GROUPS = f"{_P3} SELECT table_name, min(id) AS id_keep, count(*) AS n_copies FROM a GROUP BY table_name, canon"

_P5_COVER = """
SELECT DISTINCT 'claude_web_messages' AS table_name, uuid AS item_id, md5(content) AS digest, true AS kept FROM claude_web_messages
WHERE length(content) > (SELECT max_chars FROM split_limits WHERE field_name = 'claude_web_messages.content')
UNION ALL
SELECT DISTINCT 'conversation_topics', topic_id, md5(chunk_text), true FROM conversation_topics
WHERE length(chunk_text) > (SELECT max_chars FROM split_limits WHERE field_name = 'conversation_topics.chunk_text')
"""


def oracle_sql() -> dict[str, str]:
    return {"p3_found": _P3_FOUND, "p3_groups": _P3_GROUPS, "p8_decoded": "SELECT doc_id, md5(text) AS digest FROM documents", "p5_cover": _P5_COVER, "p1_found": _P1, "p1_turns": _P1_TURNS.replace("{more}", ""), "p1_conversations": _P1_TURNS.replace("{more}", ", content"), "p5_found": _P5}
