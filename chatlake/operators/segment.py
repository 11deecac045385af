"""Topic segmentation of conversations by drops of similarity between neighbouring messages."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake import constants as K
from chatlake.functions import text, vector
from chatlake.operators import sequence
from chatlake.runtime import cut


def numbered(messages: DataFrame, conv: str, order: list[str], keys: list[str]) -> DataFrame:
    """`messages` with pos, from 0 in each conversation by `order`, nulls last. `keys` tell messages apart and are not null.

    Only the narrow columns are sorted (see `sequence.placed`); texts and vectors are joined again by the keys, so a
    conversation with a third of all messages is spread over many tasks.
    """
    narrow = messages.select(*dict.fromkeys([conv, *order, *keys]))
    places = sequence.placed(narrow, conv, order).select(*keys, "pos")
    return messages.join(places, keys).select(*messages.columns, "pos")


def adjacent_similarity(msgs: DataFrame, conv: str = "conversation_id", vec: str = "embedding") -> DataFrame:
    """`msgs` (with pos) and next_sim: cosine with the next message; null if either has no vector. The next one is joined
    by its place, which is spread over tasks where a window over the conversation is not."""
    following = msgs.select(conv, (F.col("pos") - 1).alias("pos"), F.col(vec).alias("_next_vec"))
    return msgs.join(following, [conv, "pos"], "left").select(*msgs.columns, vector.cosine(F.col(vec), F.col("_next_vec")).alias("next_sim"))


def boundaries(with_sim: DataFrame, threshold: float = K.SIMILARITY_THRESHOLD) -> DataFrame:
    """`with_sim` with is_boundary: the similarity to the next message is below the threshold."""
    return with_sim.withColumn("is_boundary", F.coalesce(F.col("next_sim") < threshold, F.lit(False)))


def ready_conversations(msgs: DataFrame, conv: str = "conversation_id", vec: str = "embedding") -> DataFrame:
    """(conv): conversations of at least three messages of which at least half have a vector."""
    return msgs.groupBy(conv).agg(F.count("*").alias("n"), F.count_if(F.col(vec).isNotNull() & (F.size(vec) > 0)).alias("k")).filter(f"n >= {K.MIN_CHUNK_MESSAGES} and 2 * k >= n").select(conv)


def eligible_conversations(messages: DataFrame, stored: DataFrame, topics: DataFrame, conv: str, key: str, limit: int | None = None, minimum: int = K.MIN_CHUNK_MESSAGES) -> DataFrame:
    """(conv, n_embedded): conversations with enough embedded messages and no topics yet, the largest first."""
    n = messages.join(stored.select(F.col("source_uuid").alias(key)).distinct(), key).groupBy(conv).agg(F.count("*").alias("n_embedded")).filter(F.col("n_embedded") >= minimum)
    rest = n.join(topics.select(F.col("conversation_id").alias(conv)).distinct(), conv, "left_anti")
    return rest.orderBy(F.desc("n_embedded"), conv).limit(limit) if limit else rest


def hash_slice(df: DataFrame, key: str, worker: int | None, workers: int) -> DataFrame:
    """The rows of one of `workers` slices by hash of the key; all without a worker. The hash does not depend on the rest."""
    return df if worker is None or workers < 2 else df.filter(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(workers)) == worker)


def cut_points(lengths: list[int], shown: list[int], bounds: list[bool], low: int = K.MIN_CHUNK_MESSAGES, high: int = K.MAX_CHUNK_MESSAGES, chars: int = K.MAX_CHUNK_CHARS) -> list[tuple[int, int]]:
    """Chunks (first, last) of one conversation.

    `lengths` are characters of the contents, `shown` those of the lines of the transcript (with separators between), and
    `bounds` marks the messages after which the topic changes. From left to right: a chunk below `low` messages is joined
    with the next unless that makes it too long and still smaller than twice `low`; a chunk above `high` messages or
    `chars` characters, of at least twice `low` messages, is halved; otherwise it stands.
    """
    n = len(lengths)
    if not n:
        return []
    ends = sorted({i for i, b in enumerate(bounds) if b} | {n - 1})
    raw, lines = [0], [0]
    for a, b in zip(lengths, shown, strict=True):
        raw.append(raw[-1] + a)
        lines.append(lines[-1] + b)
    todo, out, first = ends[::-1], [], 0
    while todo:
        last = todo[-1]
        size = last - first + 1
        if size < low and len(todo) > 1:
            far = todo[-2]
            if raw[far + 1] - raw[first] <= chars or far - first + 1 >= 2 * low:
                todo.pop()
                continue
        if size >= 2 * low and (size > high or lines[last + 1] - lines[first] + 2 * (size - 1) > chars):
            todo.append(first + size // 2 - 1)
            continue
        out.append((first, last))
        first = last + 1
        todo.pop()
    return out


def segment(msgs: DataFrame, conv: str = "conversation_id", key: str = "uuid", role: str = "role", content: str = "content", vec: str = "embedding", threshold: float = K.SIMILARITY_THRESHOLD) -> DataFrame:
    """(conv, start_msg_idx, end_msg_idx, start_msg_uuid, end_msg_uuid, message_count, chunk_text, avg_internal_sim,
    boundary_sim) of the ready conversations. `msgs` has pos.

    Only positions, two lengths and a flag of each message pass through Python; texts and vectors stay in the JVM.
    """
    m = cut(msgs.select(conv, "pos", key, role, content, vec), "messages")
    m = m.join(ready_conversations(m, conv, vec), conv, "left_semi")
    # written once: the similarities are needed for the cuts, for the rows and for the coherence
    m = cut(boundaries(adjacent_similarity(m, conv, vec), threshold), "similar")
    label = text.role_label(F.col(role))
    line = F.concat(F.lit("["), label, F.lit("]: "), F.coalesce(content, F.lit("")))
    narrow = m.select(F.col(conv).alias("conv"), "pos", F.length(F.coalesce(content, F.lit(""))).alias("raw"), F.length(text.strip_blobs(line)).alias("shown"), "is_boundary")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values("pos")
        got = cut_points(p["raw"].tolist(), p["shown"].tolist(), p["is_boundary"].tolist())
        return pd.DataFrame({"conv": p["conv"].iloc[0], "start_msg_idx": [a for a, _ in got], "end_msg_idx": [b for _, b in got]})

    chunks = narrow.groupBy("conv").applyInPandas(run, "conv string, start_msg_idx int, end_msg_idx int")
    spread = chunks.withColumn("pos", F.explode(F.sequence("start_msg_idx", "end_msg_idx")))
    full = m.withColumn("line", line).withColumn("conv", F.col(conv).cast("string")).join(spread, ["conv", "pos"])
    on = ["conv", "start_msg_idx", "end_msg_idx"]
    out = full.groupBy(*on).agg(
        F.min_by(key, "pos").alias("start_msg_uuid"), F.max_by(key, "pos").alias("end_msg_uuid"), F.count("*").alias("message_count"), F.max_by("next_sim", "pos").alias("boundary_sim"), text.strip_blobs(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda e: e["line"]), "\n\n")).alias("chunk_text")
    )
    co = vector.coherence(full.select(*on, F.col(vec).alias("v")), on, "v")
    return out.join(co, on, "left").select(F.col("conv").alias(conv), *on[1:], "start_msg_uuid", "end_msg_uuid", "message_count", "chunk_text", F.col("coherence").alias("avg_internal_sim"), "boundary_sim")


def transcript(msgs: DataFrame, conv: str, order: str, role: str, content: str) -> DataFrame:
    """(conv, transcript): lines `[ROLE]: content` joined by blank lines, without blobs."""
    line = F.concat(F.lit("["), text.role_label(F.col(role)), F.lit("]: "), F.coalesce(content, F.lit("")))
    got = msgs.groupBy(conv).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line")))).alias("l"))
    return got.select(conv, text.strip_blobs(F.array_join(F.transform("l", lambda e: e["line"]), "\n\n")).alias("transcript"))


