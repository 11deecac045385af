"""Queries of the warehouse's operators over whole tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake import constants as K
from chatlake.functions import ids, jsonx, text, vector
from chatlake.models import embedder, summarizer
from chatlake.operators import canonical, reuse, segment, stats, tree, union, upsert
from chatlake.plans import normalize, topics
from chatlake.runtime import load

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def _web(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "claude_web_messages").dropDuplicates(["uuid"])


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """Stored vectors, one row per message: the newest with a vector of full width."""
    e = load(spark, d, "message_embeddings").filter("size(embedding) = 128")
    return e.groupBy("source_uuid").agg(F.max_by(F.struct("source_type", "content_hash", "embedding", "model"), F.struct("updated_at", "content_hash")).alias("r")).select("source_uuid", "r.*")


def _total(vec: str) -> Column:
    return F.aggregate(vec, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double"))


_WEB = "web AS (SELECT DISTINCT ON (uuid) * FROM claude_web_messages)"
_STORED = "stored AS (SELECT DISTINCT ON (source_uuid) * FROM message_embeddings WHERE len(embedding) = 128 ORDER BY source_uuid, updated_at DESC, content_hash DESC)"
_CANON = "(lead(1) OVER w IS NULL OR lead({s}) OVER w IS DISTINCT FROM {s})"


# --- canonical runs -------------------------------------------------------------------------------------------------


@query(
    f"""WITH m AS (SELECT event_type, {_CANON.format(s='event_type')} AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_type, count(*) FILTER (c) AS n_canonical, count(*) FILTER (NOT c) AS n_filtered FROM m GROUP BY 1"""
)
def canonical_run_counts(spark: SparkSession, d: str) -> DataFrame:
    return canonical.canonical_counts(canonical.mark_canonical(load(spark, d, "events"), "user_id", "event_type", "ts", "event_id"), "event_type")


@query(
    f"""WITH {_WEB}, m AS (SELECT uuid, conversation_uuid IS NOT NULL AND {_CANON.format(s='sender')} AS is_canonical FROM web
    WINDOW w AS (PARTITION BY conversation_uuid ORDER BY created_at ASC NULLS LAST, uuid)) SELECT uuid, is_canonical FROM m"""
)
def canonical_messages(spark: SparkSession, d: str) -> DataFrame:
    web = _web(spark, d).select("uuid", "conversation_uuid", "sender", "created_at")
    return canonical.mark_canonical(web, "conversation_uuid", "sender", "created_at", "uuid").select("uuid", "is_canonical")


@query(
    f"""WITH {_WEB}, m AS (SELECT conversation_uuid AS c, NOT {_CANON.format(s='sender')} AS b FROM web WHERE conversation_uuid IS NOT NULL
    WINDOW w AS (PARTITION BY conversation_uuid ORDER BY created_at ASC NULLS LAST, uuid)), g AS (SELECT c, bool_or(b) AS b FROM m GROUP BY 1)
    SELECT count(*) FILTER (b) AS n_branched, count(*) FILTER (NOT b) AS n_linear FROM g"""
)
def branched_conversations(spark: SparkSession, d: str) -> DataFrame:
    web = _web(spark, d).select("uuid", "conversation_uuid", "sender", "created_at")
    return canonical.branched_counts(canonical.mark_canonical(web, "conversation_uuid", "sender", "created_at", "uuid"), "conversation_uuid")


# --- spans, filters, mappings ---------------------------------------------------------------------------------------


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL")
def hourly_activity(spark: SparkSession, d: str) -> DataFrame:
    """The windows of the stream of events, over the whole table."""
    from chatlake.streaming.tables import activity

    return activity(load(spark, d, "events"), "ts", "event_type").select(F.col("window.start").alias("hour"), "event_type", "n")


@query("SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1")
def account_span(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


@query("SELECT conversation_id, device, project_path, min(record_ts) AS created_at, max(record_ts) AS updated_at FROM claude_code_raw GROUP BY ALL")
def conversation_span(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "claude_code_raw").groupBy("conversation_id", "device", "project_path").agg(F.min("record_ts").alias("created_at"), F.max("record_ts").alias("updated_at"))


@query(
    """SELECT conversation_id, line_number, CASE record_type WHEN 'user' THEN 'human' ELSE record_type END AS sender FROM claude_code_raw
    WHERE record_type IN ('user', 'assistant', 'summary') AND record_uuid IS NOT NULL"""
)
def sender_map(spark: SparkSession, d: str) -> DataFrame:
    r = load(spark, d, "claude_code_raw").filter(F.col("record_type").isin("user", "assistant", "summary") & F.col("record_uuid").isNotNull())
    return r.select("conversation_id", "line_number", F.when(F.col("record_type") == "user", "human").otherwise(F.col("record_type")).alias("sender"))


@query("SELECT conversation_id, line_number, data->>'$.type' AS record_type, data->>'$.uuid' AS record_uuid, data->>'$.parentUuid' AS parent_uuid, data->>'$.sessionId' AS session_id FROM claude_code_raw")
def record_fields(spark: SparkSession, d: str) -> DataFrame:
    f = jsonx.record_fields(F.col("data"))
    return load(spark, d, "claude_code_raw").select("conversation_id", "line_number", *[f[n].alias(n) for n in ("record_type", "record_uuid", "parent_uuid", "session_id")])


@query(
    """SELECT conversation_id, line_number, CASE WHEN json_type(data, '$.timestamp') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN make_timestamp(nullif((data->>'$.timestamp')::bigint, 0) * 1000)
    ELSE (try_cast(data->>'$.timestamp' AS timestamptz) AT TIME ZONE 'UTC') END AS parsed FROM claude_code_raw"""
)
def record_times(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "claude_code_raw").select("conversation_id", "line_number", jsonx.record_time(F.col("data")).alias("parsed"))


@query(
    """SELECT conversation_id, line_number, CASE WHEN a NOT LIKE '{%' THEN md5(a) END AS for_store, CASE WHEN a LIKE '{%' THEN list_aggr(list_sort(json_keys(a)), 'string_agg', ',') END AS store_keys,
    CASE WHEN b NOT LIKE '{%' AND b NOT LIKE '[%' THEN md5(b) END AS for_topic, CASE WHEN b LIKE '{%' THEN list_aggr(list_sort(json_keys(b)), 'string_agg', ',') END AS topic_keys, CASE WHEN b LIKE '[%' THEN json_array_length(b)::bigint END AS topic_items
    FROM (SELECT *, coalesce(data->>'$.message', data->>'$.content[0].text', data->>'$.text', '') AS a, coalesce(data->>'$.message', data->>'$.content', '') AS b FROM claude_code_raw)"""
)
def json_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Digests of texts; of objects and lists, whose spelling is not SQL's, the keys and the length."""
    raw = F.col("data")
    a, b = jsonx.content_for_store(raw), jsonx.content_for_topic(raw)
    keys = lambda c: F.when(F.startswith(c, F.lit("{")), F.array_join(F.array_sort(F.json_object_keys(c)), ","))
    items = F.when(F.startswith(b, F.lit("[")), F.json_array_length(b).cast("bigint"))
    return load(spark, d, "claude_code_raw").select(
        "conversation_id", "line_number", F.when(~F.startswith(a, F.lit("{")), F.md5(a)).alias("for_store"), keys(a).alias("store_keys"), F.when(~b.rlike(r"^[{\[]"), F.md5(b)).alias("for_topic"), keys(b).alias("topic_keys"), items.alias("topic_items")
    )

@query("SELECT topic_id, coalesce(nullif(topic_summary, ''), nullif(source_type, ''), 'Untitled') AS name FROM conversation_topics")
def display_names(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "conversation_topics").select("topic_id", text.display_name(F.col("topic_summary"), F.col("source_type")).alias("name"))


@query("SELECT uuid FROM claude_code_messages WHERE content IS NOT NULL AND regexp_matches(content, '[^\\s\\x0b\\x1c-\\x1f\\x85\\xa0\\p{Z}]')")
def not_blank(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "claude_code_messages").filter(~text.is_blank(F.col("content"))).select("uuid")


# --- hashes, texts ---------------------------------------------------------------------------------------------------


@query("SELECT doc_id, substr(sha256(coalesce(text, '')), 1, 32) AS content_hash FROM documents")
def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


@query("SELECT substr(sha256(coalesce(text, '')), 1, 32) AS content_hash, min(doc_id) AS first_id, count(*) AS n FROM documents GROUP BY 1")
def first_by_hash(spark: SparkSession, d: str) -> DataFrame:
    return reuse.first_by_hash(load(spark, d, "documents"), "doc_id", "text")


@query(
    """SELECT doc_id, i AS no, substr(text, (i * 5700 + 1)::bigint, 6000) AS piece FROM (SELECT doc_id, text, unnest(range(CASE WHEN length(text) <= 6000 THEN 1 ELSE ceil((length(text) - 300) / 5700.0)::bigint END)) AS i
    FROM documents WHERE text IS NOT NULL)"""
)
def chunk_text(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").filter("text is not null").select("doc_id", F.posexplode(text.pieces(F.col("text"))).alias("no", "piece")).withColumn("no", F.col("no").cast("bigint"))


@query("SELECT doc_id, CASE WHEN length(text) > 24000 THEN substr(text, 1, 24000) || '... [truncated]' ELSE text END AS text FROM documents")
def truncated(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", text.truncate(F.col("text")).alias("text"))


@query("""SELECT uuid, regexp_replace(content, '"data"\\s*:\\s*"[A-Za-z0-9+/=\\s\\\\]{1000,}"', '"data": "[base64 removed]"', 'g') AS content FROM claude_code_messages""")
def blobs_stripped(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "claude_code_messages").select("uuid", text.strip_blobs(F.col("content")).alias("content"))


@query(
    """WITH b AS (SELECT conversation_id, line_number, unnest(from_json(data->'$.message.content', '[{"type":"VARCHAR","text":"VARCHAR"}]'), recursive := true), generate_subscripts(from_json(data->'$.message.content', '[{"type":"VARCHAR","text":"VARCHAR"}]'), 1) AS i
    FROM claude_code_raw WHERE json_type(data, '$.message.content') = 'ARRAY')
    SELECT conversation_id, line_number, coalesce(string_agg(CASE WHEN coalesce(type, '') IN ('', 'text') THEN text ELSE '[' || type || '] ' || text END, E'\\n\\n' ORDER BY i) FILTER (coalesce(text, '') <> ''), '') AS content
    FROM (SELECT DISTINCT * FROM b) GROUP BY ALL"""
)
def block_texts(spark: SparkSession, d: str) -> DataFrame:
    c = F.get_json_object("data", "$.message.content")
    r = load(spark, d, "claude_code_raw").filter(F.startswith(c, F.lit("["))).select("conversation_id", "line_number", text.blocks_text(F.from_json(c, text.BLOCKS)).alias("content"))
    return r.distinct()


_NAMES = ", ".join(f"'{x}'" for x in [*K.CONTENT_TYPES, ".PNG", ".Jpg", ".bin", "", ".tar.gz", ".json/"])
_TYPES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.CONTENT_TYPES.items())


@query(f"""SELECT p_partkey, CASE regexp_extract(lower(n), '[^/.](\\.[^./]+)$', 1) {_TYPES} ELSE '{K.DEFAULT_CONTENT_TYPE}' END AS content_type FROM (SELECT p_partkey, p_type || ([{_NAMES}])[(p_partkey % {len(K.CONTENT_TYPES) + 6} + 1)::bigint] AS n FROM part)""")
def content_types(spark: SparkSession, d: str) -> DataFrame:
    ends = [*K.CONTENT_TYPES, ".PNG", ".Jpg", ".bin", "", ".tar.gz", ".json/"]
    name = F.concat("p_type", F.element_at(F.array(*map(F.lit, ends)), (F.col("p_partkey") % len(ends) + 1).cast("int")))
    return load(spark, d, "part").select("p_partkey", text.content_type(name).alias("content_type"))

@query("SELECT DISTINCT project_path, CASE WHEN project_path LIKE '/%' THEN replace(project_path, '-', '/') END AS back FROM claude_code_raw")
def project_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths written as folder names and read back."""
    p = load(spark, d, "claude_code_raw").select("project_path").distinct()
    return p.select("project_path", F.when(F.startswith("project_path", F.lit("/")), ids.project_path(F.translate("project_path", "/", "-"))).alias("back"))


@query(
    f"""WITH h AS (SELECT doc_id, sha1(unhex('{K.ID_NAMESPACE.replace("-", "")}') || encode('doc-' || doc_id::varchar)) AS h FROM documents)
    SELECT doc_id, concat_ws('-', h[1:8], h[9:12], '5' || h[14:16], substr('89ab', (('0x' || h[17:17])::int % 4) + 1, 1) || h[18:20], h[21:32]) AS id FROM h"""
)
def derived_ids(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", ids.conversation_id(F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))).alias("id"))


# --- pending texts and reuse -----------------------------------------------------------------------------------------


@query(f"WITH {_WEB} SELECT uuid AS source_uuid, 'web' AS source_type, content FROM web WHERE content IS NOT NULL AND content <> '' AND NOT EXISTS (SELECT 1 FROM message_embeddings e WHERE e.source_uuid = uuid)")
def pending_web(spark: SparkSession, d: str) -> DataFrame:
    return reuse.pending_messages(_web(spark, d), load(spark, d, "message_embeddings"), "uuid", "content", "web")


@query("SELECT DISTINCT message_id AS source_uuid, 'chatgpt' AS source_type, content FROM chatgpt_messages WHERE is_canonical AND content IS NOT NULL AND content <> '' AND NOT EXISTS (SELECT 1 FROM message_embeddings e WHERE e.source_uuid = message_id)")
def pending_tree(spark: SparkSession, d: str) -> DataFrame:
    return reuse.pending_messages(load(spark, d, "chatgpt_messages").dropDuplicates(["message_id"]), load(spark, d, "message_embeddings"), "message_id", "content", "chatgpt", canonical=True)


@query(
    f"""SELECT DISTINCT record_uuid AS source_uuid, 'code' AS source_type, CASE WHEN c NOT LIKE '{{%' AND c NOT LIKE '[%' THEN md5(c) END AS digest FROM (SELECT *, coalesce(data->>'$.message', data->>'$.content', '{{') AS c FROM claude_code_raw)
    WHERE record_type IN ('user', 'assistant') AND record_uuid IS NOT NULL AND length(json(data)) < {K.MAX_RECORD_CHARS} AND NOT contains(json(data), '"type":"image"') AND NOT contains(json(data), 'data:image/') AND NOT EXISTS (SELECT 1 FROM message_embeddings e WHERE e.source_uuid = record_uuid)"""
)
def pending_code(spark: SparkSession, d: str) -> DataFrame:
    """Pending records; of contents that are no objects or lists, whose spelling is not SQL's, the digest."""
    p = reuse.pending_records(load(spark, d, "claude_code_raw"), load(spark, d, "message_embeddings"))
    return p.select("source_uuid", "source_type", F.when(~F.col("content").rlike(r"^[{\[]"), F.md5("content")).alias("digest")).distinct()

@query(
    f"""WITH {_WEB}, {_STORED}, p AS (SELECT uuid, content FROM web WHERE content IS NOT NULL AND content <> '' AND NOT EXISTS (SELECT 1 FROM message_embeddings e WHERE e.source_uuid = uuid)),
    s AS (SELECT substr(sha256(content), 1, 32) AS h, arg_min(e.embedding, uuid) AS v FROM web JOIN stored e ON e.source_uuid = uuid WHERE content IS NOT NULL GROUP BY 1)
    SELECT p.uuid AS source_uuid, s.h AS content_hash, round(list_sum(s.v::double[]), 4) AS total FROM p JOIN s ON s.h = substr(sha256(p.content), 1, 32)"""
)
def hash_reuse(spark: SparkSession, d: str) -> DataFrame:
    web, e = _web(spark, d), load(spark, d, "message_embeddings")
    vecs = _stored(spark, d).select(F.col("source_uuid").alias("uuid"), "embedding", "model")
    stored = web.filter("content is not null").join(vecs, "uuid").select(F.col("uuid").alias("source_uuid"), text.content_hash(F.col("content")).alias("content_hash"), "embedding", "model")
    got = reuse.reuse_by_hash(reuse.pending_messages(web, e, "uuid", "content", "web"), stored)[0]
    return got.select("source_uuid", "content_hash", F.round(_total("embedding"), 4).alias("total"))

@query(
    f"""WITH {_STORED}, w AS (SELECT uuid, min(content) AS content FROM claude_web_messages GROUP BY 1), k AS (SELECT uuid, min(content) AS content FROM claude_code_messages GROUP BY 1)
    SELECT source_uuid, coalesce(k.content, w.content) AS content FROM stored LEFT JOIN k ON source_type = 'code' AND source_uuid = k.uuid LEFT JOIN w ON source_type = 'web' AND source_uuid = w.uuid"""
)
def reembed_contents(spark: SparkSession, d: str) -> DataFrame:
    return reuse.stored_contents(_stored(spark, d), load(spark, d, "claude_code_messages"), load(spark, d, "claude_web_messages"))


# --- vectors and topics ----------------------------------------------------------------------------------------------


@query("SELECT label, pos - 1 AS pos, round(avg(x), 6) AS x FROM (SELECT label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL")
def vector_mean(spark: SparkSession, d: str) -> DataFrame:
    m = vector.mean_vectors(load(spark, d, "embeddings"), "label", "embedding")
    return m.select("label", F.posexplode("vector").alias("pos", "x")).select("label", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x"))


@query("SELECT a.label, round(avg(list_cosine_similarity(a.embedding::double[], b.embedding::double[])), 6) AS coherence FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY 1")
def internal_similarity(spark: SparkSession, d: str) -> DataFrame:
    c = vector.coherence(load(spark, d, "embeddings"), "label", "embedding")
    return c.select("label", F.round("coherence", 6).alias("coherence"))


def _messages_with_vectors(spark: SparkSession, d: str) -> DataFrame:
    web = _web(spark, d).filter("conversation_uuid is not null and content is not null and content <> ''")
    m = web.select(F.col("conversation_uuid").alias("conversation_id"), "uuid", F.col("sender").alias("role"), "content", "created_at")
    m = m.join(_stored(spark, d).select(F.col("source_uuid").alias("uuid"), "embedding"), "uuid", "left")
    return segment.numbered(m, "conversation_id", ["created_at", "uuid"], ["uuid"])


_PAIRS = f"""WITH {_WEB}, {_STORED}, m AS (SELECT conversation_uuid AS conversation_id, uuid, row_number() OVER w - 1 AS pos, embedding::double[] AS v, lead(embedding::double[]) OVER w AS n
    FROM web LEFT JOIN stored ON uuid = source_uuid WHERE conversation_uuid IS NOT NULL AND content IS NOT NULL AND content <> '' WINDOW w AS (PARTITION BY conversation_uuid ORDER BY created_at ASC NULLS LAST, uuid)),
    s AS (SELECT conversation_id, uuid, pos, CASE WHEN list_dot_product(v, v) > 0 AND list_dot_product(n, n) > 0 THEN list_cosine_similarity(v, n) END AS sim FROM m)"""


@query(_PAIRS + " SELECT conversation_id, pos, round(sim, 6) AS next_sim FROM s WHERE sim IS NOT NULL")
def adjacent_similarity(spark: SparkSession, d: str) -> DataFrame:
    s = segment.adjacent_similarity(_messages_with_vectors(spark, d))
    return s.filter("next_sim is not null").select("conversation_id", F.col("pos").cast("bigint").alias("pos"), F.round("next_sim", 6).alias("next_sim"))


@query(_PAIRS + " SELECT conversation_id, uuid FROM s WHERE sim < 0.3")
def topic_boundaries(spark: SparkSession, d: str) -> DataFrame:
    return segment.boundaries(segment.adjacent_similarity(_messages_with_vectors(spark, d))).filter("is_boundary").select("conversation_id", "uuid")


_STRIP = r"""regexp_replace({0}, '"data"\s*:\s*"[A-Za-z0-9+/=\s\\]{{1000,}}"', '"data": "[base64 removed]"', 'g')"""


@query(
    f"""WITH RECURSIVE {_WEB}, {_STORED},
    m AS (SELECT conversation_uuid AS c, uuid, content, row_number() OVER w - 1 AS pos, embedding::double[] AS v, lead(embedding::double[]) OVER w AS n, '[' || CASE WHEN coalesce(sender, '') = '' THEN 'MSG' ELSE upper(sender) END || ']: ' || content AS line
      FROM web LEFT JOIN stored ON uuid = source_uuid WHERE conversation_uuid IS NOT NULL AND content IS NOT NULL AND content <> '' WINDOW w AS (PARTITION BY conversation_uuid ORDER BY created_at ASC NULLS LAST, uuid)),
    s AS (SELECT *, CASE WHEN list_dot_product(v, v) > 0 AND list_dot_product(n, n) > 0 THEN list_cosine_similarity(v, n) END AS sim FROM m WHERE c IN (SELECT c FROM m GROUP BY 1 HAVING count(*) >= {K.MIN_CHUNK_MESSAGES} AND 2 * count(v) >= count(*))),
    sums AS (SELECT c, pos, sum(length(content)) OVER w AS r, sum(length({_STRIP.format("line")})) OVER w AS l, coalesce(sim < {K.SIMILARITY_THRESHOLD}, false) AS b FROM s WINDOW w AS (PARTITION BY c ORDER BY pos)),
    a AS (SELECT c, [0] || list(r::bigint ORDER BY pos) AS r, [0] || list(l::bigint ORDER BY pos) AS l, list_reverse(list_sort(list_distinct(coalesce(list(pos) FILTER (b), []) || [max(pos)]))) AS todo FROM sums GROUP BY 1),
    step AS (SELECT c, r, l, todo, 0::bigint AS first, NULL::bigint AS a, NULL::bigint AS b FROM a
      UNION ALL
      SELECT c, r, l, CASE WHEN halve THEN list_append(todo, first + size // 2 - 1) ELSE todo[1:len(todo) - 1] END, CASE WHEN joins OR halve THEN first ELSE last + 1 END, CASE WHEN NOT joins AND NOT halve THEN first END, CASE WHEN NOT joins AND NOT halve THEN last END
      FROM (SELECT *, NOT joins AND size >= {2 * K.MIN_CHUNK_MESSAGES} AND (size > {K.MAX_CHUNK_MESSAGES} OR l[last + 2] - l[first + 1] + 2 * (size - 1) > {K.MAX_CHUNK_CHARS}) AS halve
        FROM (SELECT *, size < {K.MIN_CHUNK_MESSAGES} AND len(todo) > 1 AND coalesce(r[far + 2] - r[first + 1] <= {K.MAX_CHUNK_CHARS} OR far - first + 1 >= {2 * K.MIN_CHUNK_MESSAGES}, false) AS joins
          FROM (SELECT *, todo[len(todo)] AS last, todo[len(todo) - 1] AS far, todo[len(todo)] - first + 1 AS size FROM step WHERE len(todo) > 0)))),
    k AS (SELECT c, a, b FROM step WHERE a IS NOT NULL),
    p AS (SELECT k.c, k.a, avg(CASE WHEN list_dot_product(x.v, x.v) > 0 AND list_dot_product(y.v, y.v) > 0 THEN list_cosine_similarity(x.v, y.v) ELSE 0 END) AS co FROM k JOIN s x ON x.c = k.c AND x.pos BETWEEN k.a AND k.b JOIN s y ON y.c = k.c AND y.pos BETWEEN x.pos + 1 AND k.b WHERE x.v IS NOT NULL AND y.v IS NOT NULL GROUP BY ALL)
    SELECT k.c AS conversation_id, k.a AS start_msg_idx, k.b AS end_msg_idx, arg_min(s.uuid, pos) AS start_msg_uuid, arg_max(s.uuid, pos) AS end_msg_uuid, count(*) AS message_count, md5({_STRIP.format("string_agg(line, E'\n\n' ORDER BY pos)")}) AS digest, round(any_value(co), 5) AS avg_internal_sim, round(max(sim) FILTER (pos = k.b), 5) AS boundary_sim
    FROM k JOIN s ON s.c = k.c AND s.pos BETWEEN k.a AND k.b LEFT JOIN p ON p.c = k.c AND p.a = k.a GROUP BY k.c, k.a, k.b"""
)
def topic_chunks(spark: SparkSession, d: str) -> DataFrame:
    t = segment.segment(_messages_with_vectors(spark, d))
    whole = [F.col(c).cast("bigint").alias(c) for c in ("start_msg_idx", "end_msg_idx", "message_count")]
    return t.select("conversation_id", *whole, "start_msg_uuid", "end_msg_uuid", F.md5("chunk_text").alias("digest"), F.round("avg_internal_sim", 5).alias("avg_internal_sim"), F.round("boundary_sim", 5).alias("boundary_sim"))


@query(
    f"""WITH {_WEB}, m AS (SELECT conversation_uuid AS c, created_at, uuid, '[' || CASE WHEN coalesce(sender, '') = '' THEN 'MSG' ELSE upper(sender) END || ']: ' || coalesce(content, '') AS l FROM web WHERE conversation_uuid IS NOT NULL)
    SELECT c AS conversation_uuid, md5(regexp_replace(string_agg(l, E'\\n\\n' ORDER BY created_at ASC NULLS LAST, uuid), '"data"\\s*:\\s*"[A-Za-z0-9+/=\\s\\\\]{{1000,}}"', '"data": "[base64 removed]"', 'g')) AS digest FROM m GROUP BY 1"""
)
def transcripts(spark: SparkSession, d: str) -> DataFrame:
    web = segment.numbered(_web(spark, d).filter("conversation_uuid is not null"), "conversation_uuid", ["created_at", "uuid"], ["uuid"])
    return segment.transcript(web, "conversation_uuid", "pos", "sender", "content").select("conversation_uuid", F.md5("transcript").alias("digest"))


@query(
    f"""WITH {_WEB} SELECT conversation_uuid, count(*) AS n_embedded FROM web WHERE EXISTS (SELECT 1 FROM message_embeddings e WHERE e.source_uuid = uuid) AND conversation_uuid IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM conversation_topics t WHERE t.conversation_id = conversation_uuid) GROUP BY 1 HAVING count(*) >= 3"""
)
def eligible_conversations(spark: SparkSession, d: str) -> DataFrame:
    web = _web(spark, d).filter("conversation_uuid is not null")
    return segment.eligible_conversations(web, load(spark, d, "message_embeddings"), load(spark, d, "conversation_topics"), "conversation_uuid", "uuid")


@query(
    """SELECT r.conversation_id, count(*) AS n_embedded FROM (SELECT DISTINCT ON (conversation_id, line_number) * FROM claude_code_raw) r WHERE record_type IN ('user', 'assistant') AND (data->>'$.message' IS NOT NULL OR data->>'$.content' IS NOT NULL) AND coalesce(data->>'$.message', data->>'$.content', '') <> ''
    AND EXISTS (SELECT 1 FROM message_embeddings e WHERE e.source_uuid = record_uuid) AND NOT EXISTS (SELECT 1 FROM conversation_topics t WHERE t.conversation_id = r.conversation_id) GROUP BY 1 HAVING count(*) >= 3"""
)
def eligible_agent_conversations(spark: SparkSession, d: str) -> DataFrame:
    raw = load(spark, d, "claude_code_raw").dropDuplicates(["conversation_id", "line_number"])
    return segment.eligible_conversations(topics.agent_messages_with_text(raw), load(spark, d, "message_embeddings"), load(spark, d, "conversation_topics"), "conversation_id", "record_uuid")


@query(
    """SELECT DISTINCT ON (topic_id) topic_id, CASE WHEN regexp_matches(topic_summary, '[^\\s\\x0b\\x1c-\\x1f\\x85\\xa0\\p{Z}]') THEN 'hashing-16' ELSE model END AS model, CASE WHEN regexp_matches(topic_summary, '[^\\s\\x0b\\x1c-\\x1f\\x85\\xa0\\p{Z}]') THEN 16 ELSE len(embedding) END AS dims FROM conversation_topics"""
)
def topics_reembedded(spark: SparkSession, d: str) -> DataFrame:
    """Topics with vectors of their summaries; those without one keep theirs."""
    t = topics.reembed_topics(load(spark, d, "conversation_topics").dropDuplicates(["topic_id"]), embedder.HashingEmbedder(16))
    return t.select("topic_id", "model", F.when(F.col("embedding").isNotNull(), F.size("embedding")).cast("bigint").alias("dims"))


@query("SELECT conversation_id, count(*) AS n FROM claude_code_messages WHERE conversation_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, conversation_id LIMIT 50")
def largest_conversations(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "claude_code_messages").filter("conversation_id is not null").groupBy("conversation_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "conversation_id").limit(50)


@query("SELECT vec_id, rn, (rn - 1) % 24 AS worker FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rn FROM embeddings)")
def worker_slices(spark: SparkSession, d: str) -> DataFrame:
    return stats.worker_slice(load(spark, d, "embeddings").select("vec_id"), "vec_id", 24)


# --- unified tables, upserts, versions -------------------------------------------------------------------------------


@query(
    f"""WITH {_WEB}, k AS (SELECT DISTINCT ON (uuid) * FROM claude_code_messages), t AS (SELECT DISTINCT ON (message_id) * FROM chatgpt_messages),
    a AS (SELECT 0 AS p, uuid, conversation_uuid AS c, sender, content, created_at, parent_message_uuid AS parent FROM web WHERE is_canonical UNION ALL SELECT 1, uuid, conversation_id, sender, content, created_at, NULL FROM k UNION ALL SELECT 2, message_id, conversation_id, sender, content, created_at, parent_id FROM t WHERE is_canonical)
    SELECT DISTINCT ON (uuid) uuid, c AS conversation_id, CASE sender WHEN 'user' THEN 'human' ELSE sender END AS sender, md5(content) AS digest, created_at, parent AS parent_uuid FROM a WHERE uuid IS NOT NULL ORDER BY uuid, p"""
)
def unified_messages(spark: SparkSession, d: str) -> DataFrame:
    web = _web(spark, d).select("uuid", F.col("conversation_uuid").alias("conversation_id"), "sender", "content", "created_at", F.col("parent_message_uuid").alias("parent_uuid"), "is_canonical")
    agent = load(spark, d, "claude_code_messages").select("uuid", "conversation_id", "sender", "content", "created_at", F.lit(None).cast("string").alias("parent_uuid"))
    tr = load(spark, d, "chatgpt_messages").select(F.col("message_id").alias("uuid"), "conversation_id", "sender", "content", "created_at", F.col("parent_id").alias("parent_uuid"), "is_canonical")
    return union.unified_messages(web, agent, tr).filter("uuid is not null").select("uuid", "conversation_id", "sender", F.md5("content").alias("digest"), "created_at", "parent_uuid")

@query(
    """WITH a AS (SELECT 0 AS p, 'web' AS source, conversation_uuid AS conversation_id, min(created_at) AS created_at FROM claude_web_messages GROUP BY 3 UNION ALL SELECT 1, 'code', conversation_id, min(record_ts) FROM claude_code_raw GROUP BY 3
    UNION ALL SELECT 2, 'chatgpt', conversation_id, min(created_at) FROM chatgpt_messages GROUP BY 3) SELECT DISTINCT ON (conversation_id) conversation_id, created_at, source FROM a WHERE conversation_id IS NOT NULL ORDER BY conversation_id, p"""
)
def unified_conversations(spark: SparkSession, d: str) -> DataFrame:
    span = lambda t, c, ts: load(spark, d, t).filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("conversation_id")).agg(F.min(ts).alias("created_at"))
    return union.unified_conversations(span("claude_web_messages", "conversation_uuid", "created_at"), span("claude_code_raw", "conversation_id", "record_ts"), span("chatgpt_messages", "conversation_id", "created_at"))


@query(
    """WITH t AS (SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen FROM events WHERE event_id % 2 = 0 GROUP BY 1), s AS (SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen FROM events WHERE event_id % 2 = 1 GROUP BY 1)
    SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.first_seen, s.first_seen) AS first_seen, greatest(t.last_seen, s.last_seen) AS last_seen, CASE WHEN t.user_id IS NULL THEN 'insert' WHEN s.user_id IS NULL THEN 'skip' ELSE 'update' END AS action
    FROM t FULL JOIN s ON t.user_id = s.user_id"""
)
def upsert_greatest(spark: SparkSession, d: str) -> DataFrame:
    span = lambda k: load(spark, d, "events").filter(F.col("event_id") % 2 == k).groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
    return upsert.upsert(span(0), span(1), ["user_id"], {"last_seen": upsert.GREATEST}).withColumnRenamed("_action", "action")


_DELIVERED = """r AS (SELECT DISTINCT conversation_id, line_number, device, record_type, file_mtime, ('0x' || substr(md5(device || epoch_us(file_mtime)::varchar || coalesce(epoch_us(ingested_at), 0)::varchar || coalesce(record_type, '')), 1, 12))::bigint AS i FROM claude_code_raw),
    c AS (SELECT conversation_id, line_number, i % 2 AS half, arg_min(device, i) AS device, arg_max(coalesce(record_type, '-'), (file_mtime, -i)) AS record_type, max(file_mtime) AS file_mtime FROM r GROUP BY ALL)"""


@query(
    f"""WITH {_DELIVERED}, t AS (SELECT * FROM c WHERE half = 0), s AS (SELECT * FROM c WHERE half = 1)
    SELECT coalesce(t.conversation_id, s.conversation_id) AS conversation_id, coalesce(t.line_number, s.line_number) AS line_number, coalesce(t.device, s.device) AS device, CASE WHEN t.device IS NULL OR s.file_mtime > t.file_mtime THEN s.record_type ELSE t.record_type END AS record_type,
    greatest(t.file_mtime, s.file_mtime) AS file_mtime, CASE WHEN t.device IS NULL THEN 'insert' WHEN s.file_mtime > t.file_mtime THEN 'update' ELSE 'skip' END AS action FROM t FULL JOIN s ON t.conversation_id = s.conversation_id AND t.line_number = s.line_number"""
)
def upsert_guarded(spark: SparkSession, d: str) -> DataFrame:
    """Two batches of deliveries, each in an order made from a hash, applied one after the other: the device stays the
    first, the rest follows a later file time."""
    micros = lambda c: F.coalesce(F.unix_micros(F.col(c).cast("timestamp")), F.lit(0)).cast("string")
    order = F.conv(F.substring(F.md5(F.concat("device", micros("file_mtime"), micros("ingested_at"), F.coalesce("record_type", F.lit("")))), 1, 12), 16, 10).cast("bigint")
    r = load(spark, d, "claude_code_raw").select("conversation_id", "line_number", "device", F.coalesce("record_type", F.lit("-")).alias("record_type"), "file_mtime", order.alias("i")).distinct()
    keys, take = ["conversation_id", "line_number"], {"record_type": upsert.TAKE, "file_mtime": upsert.TAKE}
    batch = lambda k: upsert.collapse(r.filter(F.col("i") % 2 == k), keys, {"device": upsert.KEEP, **take}, "i", newer="file_mtime")
    return upsert.upsert(batch(0), batch(1), keys, take, newer="file_mtime").withColumnRenamed("_action", "action")

@query(
    """WITH RECURSIVE v AS (SELECT conversation_uuid AS c, updated_at AS u, row_number() OVER (PARTITION BY conversation_uuid ORDER BY uuid, updated_at ASC NULLS FIRST) AS i FROM (SELECT conversation_uuid, uuid, CASE WHEN length(content) % 7 = 0 THEN NULL ELSE updated_at END AS updated_at FROM claude_web_messages) WHERE conversation_uuid IS NOT NULL),
    s AS (SELECT c, i, u AS stored, true AS ok FROM v WHERE i = 1 UNION ALL
      SELECT v.c, v.i, CASE WHEN v.u IS NULL OR s.stored IS NULL OR v.u > s.stored THEN v.u ELSE s.stored END, v.u IS NULL OR s.stored IS NULL OR v.u > s.stored FROM s JOIN v ON v.c = s.c AND v.i = s.i + 1)
    SELECT c AS conversation_uuid, count(*) FILTER (ok) AS n_accepted, count(*) FILTER (NOT ok) AS n_refused FROM s GROUP BY 1"""
)
def accepted_versions(spark: SparkSession, d: str) -> DataFrame:
    """Versions one after the other, some without a date, against a reader that takes them in turn."""
    seen = F.when(F.coalesce(F.length("content") % 7 != 0, F.lit(True)), F.col("updated_at"))
    v = load(spark, d, "claude_web_messages").filter("conversation_uuid is not null").select("conversation_uuid", "uuid", seen.alias("updated_at")).withColumn("o", F.struct("uuid", "updated_at"))
    got = upsert.accepted_versions(v, "conversation_uuid", "updated_at", "o").groupBy("conversation_uuid")
    return got.agg(F.count_if("accepted").alias("n_accepted"), F.count_if(~F.col("accepted")).alias("n_refused"))


_RAW = "raw AS (SELECT DISTINCT ON (record_uuid) * FROM claude_code_raw WHERE record_uuid IS NOT NULL ORDER BY record_uuid, conversation_id, line_number)"


@query(
    """WITH p AS (SELECT conversation_id, device, project_path, min(record_ts) AS a, max(record_ts) AS b FROM claude_code_raw GROUP BY ALL)
    SELECT conversation_id, first(device ORDER BY a NULLS LAST, device, project_path) AS device, first(project_path ORDER BY a NULLS LAST, device, project_path) AS project_path, min(a) AS created_at, max(b) AS updated_at FROM p GROUP BY 1"""
)
def agent_conversations(spark: SparkSession, d: str) -> DataFrame:
    return normalize.agent_conversations(load(spark, d, "claude_code_raw"))


@query(
    """SELECT DISTINCT ON (record_uuid) record_uuid AS uuid, conversation_id, session_id, CASE record_type WHEN 'user' THEN 'human' ELSE record_type END AS sender, record_ts AS created_at, CASE WHEN a NOT LIKE '{%' THEN md5(a) END AS digest
    FROM (SELECT *, coalesce(data->>'$.message', data->>'$.content[0].text', data->>'$.text', '') AS a FROM claude_code_raw) WHERE record_type IN ('user', 'assistant', 'summary') AND record_uuid IS NOT NULL ORDER BY record_uuid, conversation_id, line_number"""
)
def agent_messages(spark: SparkSession, d: str) -> DataFrame:
    m = normalize.agent_messages(load(spark, d, "claude_code_raw"))
    return m.select("uuid", "conversation_id", "session_id", "sender", "created_at", F.when(~F.startswith("content", F.lit("{")), F.md5("content")).alias("digest"))

@query(f"WITH {_RAW} SELECT m.uuid, raw.parent_uuid FROM (SELECT DISTINCT uuid FROM claude_code_messages) m LEFT JOIN raw ON raw.record_uuid = m.uuid")
def agent_parents(spark: SparkSession, d: str) -> DataFrame:
    return normalize.with_parents(load(spark, d, "claude_code_messages").select("uuid").distinct(), load(spark, d, "claude_code_raw"))


@query(
    f"""WITH {_STORED}, r AS (SELECT DISTINCT ON (conversation_id, line_number) conversation_id, line_number, record_uuid, record_ts, coalesce(data->>'$.message', data->>'$.content', '') AS t FROM claude_code_raw
    WHERE record_type IN ('user', 'assistant') AND (data->>'$.message' IS NOT NULL OR data->>'$.content' IS NOT NULL)),
    q AS (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY record_ts ASC NULLS LAST, line_number, record_uuid) - 1 AS pos FROM r WHERE regexp_matches(t, '[^\\s\\x0b\\x1c-\\x1f\\x85\\xa0\\p{{Z}}]'))
    SELECT conversation_id, line_number, pos, round(list_sum(embedding::double[]), 4) AS total FROM q LEFT JOIN stored ON source_uuid = record_uuid"""
)
def agent_sequence(spark: SparkSession, d: str) -> DataFrame:
    raw = load(spark, d, "claude_code_raw").dropDuplicates(["conversation_id", "line_number"])
    s = topics.agent_sequence(raw, _stored(spark, d))
    return s.select("conversation_id", "line_number", F.col("pos").cast("bigint").alias("pos"), F.round(_total("embedding"), 4).alias("total"))

@query(
    f"""WITH {_WEB}, {_STORED} SELECT conversation_uuid AS conversation_id FROM web LEFT JOIN stored ON uuid = source_uuid WHERE conversation_uuid IS NOT NULL AND content IS NOT NULL AND content <> ''
    GROUP BY 1 HAVING count(*) >= 3 AND 2 * count(stored.embedding) >= count(*)"""
)
def ready_conversations(spark: SparkSession, d: str) -> DataFrame:
    return segment.ready_conversations(_messages_with_vectors(spark, d))


@query("SELECT topic_id, round(list_sum(embedding::double[]), 5) AS total, len(embedding) AS dims FROM conversation_topics WHERE embedding IS NOT NULL")
def vectors_from_text(spark: SparkSession, d: str) -> DataFrame:
    """Vectors written as text and read back."""
    t = load(spark, d, "conversation_topics").filter("embedding is not null").select("topic_id", vector.parse(F.to_json("embedding")).alias("v"))
    return t.select("topic_id", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 5).alias("total"), F.size("v").cast("bigint").alias("dims"))


# --- trees and attachments -------------------------------------------------------------------------------------------


def _trees(spark: SparkSession, d: str) -> DataFrame:
    """(conversation_id, m): node maps from the message rows, entries and children by (created_at, message_id)."""
    m = load(spark, d, "chatgpt_messages").dropDuplicates(["message_id"]).filter("conversation_id is not null").select("conversation_id", "message_id", "parent_id", "content", F.struct(F.col("created_at").isNull(), "created_at", "message_id").alias("o"))
    kids = m.filter("parent_id is not null").groupBy("conversation_id", F.col("parent_id").alias("message_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "message_id"))), lambda e: e["message_id"]).alias("children"))
    j = m.join(kids, ["conversation_id", "message_id"], "left")
    node = F.struct(F.col("parent_id").alias("parent"), F.coalesce("children", F.array().cast("array<string>")).alias("children"), F.lit("x").alias("message"))
    got = j.groupBy("conversation_id").agg(F.array_sort(F.collect_list(F.struct("o", "message_id", node.alias("node")))).alias("l"))
    return got.select("conversation_id", F.map_from_entries(F.transform("l", lambda e: F.struct(e["message_id"], e["node"]))).alias("m"))


@query(
    """WITH RECURSIVE m AS (SELECT DISTINCT ON (message_id) * FROM chatgpt_messages WHERE conversation_id IS NOT NULL),
    k AS (SELECT conversation_id AS c, message_id AS id, parent_id AS p, row_number() OVER (PARTITION BY conversation_id, parent_id ORDER BY created_at DESC NULLS FIRST, message_id DESC) AS last, row_number() OVER (PARTITION BY conversation_id, parent_id IS NULL OR parent_id = 'client-created-root' ORDER BY created_at ASC NULLS LAST, message_id) AS nth FROM m),
    w AS (SELECT c, id, 1 AS depth FROM k WHERE (p IS NULL OR p = 'client-created-root') AND nth = 1 UNION ALL SELECT k.c, k.id, depth + 1 FROM w JOIN k ON k.c = w.c AND k.p = w.id AND k.last = 1)
    SELECT c AS conversation_id, id AS message_id, depth FROM w"""
)
def tree_canonical_path(spark: SparkSession, d: str) -> DataFrame:
    p = _trees(spark, d).select("conversation_id", F.posexplode(tree.canonical_path(F.col("m"))).alias("i", "message_id"))
    return p.select("conversation_id", "message_id", (F.col("i") + 1).alias("depth"))


_MEMBER = "CASE WHEN lang IN ('pl', 'el') OR doc_id % 2 = 0 THEN 'files/' || lang || '-' || doc_id ELSE lang || '-' || doc_id END"


@query(
    f"""WITH p AS (SELECT DISTINCT source AS archive, 'file-service://' || lang AS asset_pointer, lang FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL), n AS (SELECT source AS archive, doc_id AS ordinal, {_MEMBER} AS member FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL),
    h AS (SELECT *, CASE WHEN starts_with(member, lang) THEN 0 WHEN contains(member, '/') AND contains(member, lang) THEN 1 END AS class FROM p JOIN n USING (archive))
    SELECT archive, asset_pointer, arg_min(member, (class, ordinal)) AS member FROM h WHERE class IS NOT NULL GROUP BY ALL"""
)
def asset_match(spark: SparkSession, d: str) -> DataFrame:
    """Members that begin with the id, and others that hold it in their path."""
    docs = load(spark, d, "documents").filter("source is not null and lang is not null")
    pointers = docs.select(F.col("source").alias("archive"), F.concat(F.lit("file-service://"), "lang").alias("asset_pointer"))
    members = docs.select(F.col("source").alias("archive"), F.col("doc_id").alias("ordinal"), F.expr(_MEMBER).alias("member"))
    return tree.match_assets(pointers, members)


# --- coverage and models ---------------------------------------------------------------------------------------------


@query(
    """WITH a AS (SELECT DISTINCT 'web' AS source_type, uuid AS id FROM claude_web_messages UNION ALL SELECT DISTINCT 'code', uuid FROM claude_code_messages UNION ALL SELECT DISTINCT 'chatgpt', message_id FROM chatgpt_messages), e AS (SELECT DISTINCT source_uuid AS id FROM message_embeddings WHERE embedding IS NOT NULL)
    SELECT source_type, count(*) AS total, count(e.id) AS embedded, round_even(100.0 * count(e.id) / greatest(1, count(*)), 0)::double AS percent FROM a LEFT JOIN e ON a.id = e.id GROUP BY 1"""
)
def embedding_coverage(spark: SparkSession, d: str) -> DataFrame:
    t = {"web": ("claude_web_messages", "uuid"), "code": ("claude_code_messages", "uuid"), "chatgpt": ("chatgpt_messages", "message_id")}
    out = stats.embedding_coverage({k: load(spark, d, n).select(c) for k, (n, c) in t.items()}, load(spark, d, "message_embeddings"))
    return out.withColumn("percent", F.col("percent").cast("double"))


@query("SELECT source_type, count(DISTINCT topic_id) AS n_topics, count(DISTINCT conversation_id) AS n_conversations FROM conversation_topics GROUP BY 1")
def topic_coverage(spark: SparkSession, d: str) -> DataFrame:
    return stats.topic_coverage(load(spark, d, "conversation_topics"))


@query("SELECT 'claude_web_messages' AS table_name, count(*) AS n FROM claude_web_messages UNION ALL SELECT 'claude_code_messages', count(*) FROM claude_code_messages UNION ALL SELECT 'chatgpt_messages', count(*) FROM chatgpt_messages")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.table_counts({t: load(spark, d, t) for t in ("claude_web_messages", "claude_code_messages", "chatgpt_messages")})


@query()
def embed_local(spark: SparkSession, d: str) -> DataFrame:
    pending = reuse.pending_messages(load(spark, d, "chatgpt_messages").dropDuplicates(["message_id"]), load(spark, d, "message_embeddings"), "message_id", "content", "chatgpt", canonical=True)
    return embedder.embed_pending(pending, embedder.HashingEmbedder())


_LINES = r"""regexp_split_to_array(t, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]')"""


@query(
    f"""WITH c AS (SELECT DISTINCT ON (topic_id) topic_id, CASE WHEN length(chunk_text) > {K.SUMMARY_CHARS} THEN substr(chunk_text, 1, {K.SUMMARY_CHARS}) || E'\\n{K.CUT_MARK}' ELSE coalesce(chunk_text, '') END AS t FROM conversation_topics),
    l AS (SELECT topic_id, list_filter(list_transform({_LINES}, lambda x: regexp_replace(CASE WHEN x LIKE '[%' AND contains(x, ']: ') THEN substr(x, strpos(x, ']: ') + 3) ELSE x END, '^[\\s\\x1f\\p{{Z}}]+|[\\s\\x1f\\p{{Z}}]+$', '', 'g')), lambda x: x <> '') AS lines FROM c)
    SELECT topic_id, coalesce(substr(lines[1], 1, 160), '') AS topic_summary FROM l"""
)
def topic_summaries(spark: SparkSession, d: str) -> DataFrame:
    return summarizer.summarize(load(spark, d, "conversation_topics").dropDuplicates(["topic_id"]), summarizer.FirstLine(), ["topic_id"], "chunk_text")


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
