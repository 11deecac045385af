"""Stages over a folder of Parquet snapshots, their order, and the command line."""

from __future__ import annotations

import argparse
import json
import logging
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatlake.models import embedder as E
from chatlake.operators import reuse, segment, stats, tree, upsert
from chatlake.plans import normalize, topics
from chatlake.runtime import build_session, cut, cut_counted
from chatlake.sources import attachments, jsonl, zip_json

log = logging.getLogger("chatlake")


class Warehouse:
    """Named tables in a folder of any Hadoop file system. An index names the folders of each table's present snapshot, so
    a set of tables changes at once; the snapshot before stays until the next change, for those that still read it.

    A table that rows are merged into lies in BUCKETS folders by hash of its keys, and a merge reads and writes only the
    buckets that the batch has keys for.
    """

    BUCKETS = 32

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.index = f"{self.root}/tables.json"
        self._fs().mkdirs(self._path(self.root))

    def _path(self, at: str) -> object:
        return self.spark._jvm.org.apache.hadoop.fs.Path(at)

    def _fs(self) -> object:
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self) -> dict[str, dict]:
        """name -> keys, paths by bucket, and the folders of the snapshot before."""
        if not self._fs().exists(self._path(self.index)):
            return {}
        lines = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        stream = self._fs().open(self._path(self.index))
        try:
            return json.loads(lines.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, tables: dict[str, dict]) -> None:
        """Replace the index by one rename, and drop what only the snapshot before the last one used."""
        old = self._at()
        for n, t in tables.items():
            t["before"] = sorted(set(old.get(n, {}).get("paths", {}).values()) - set(t["paths"].values()))
        part = f"{self.index}.{uuid.uuid4().hex}"
        out = self._fs().create(self._path(part))
        out.write(bytearray(json.dumps(old | tables).encode()))
        out.close()
        fs = self.spark._jvm.org.apache.hadoop.fs
        how = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = fs.Options.Rename.OVERWRITE
        fs.FileContext.getFileContext(self._path(self.root).toUri() if "://" in self.root else self.spark._jvm.java.net.URI("file:///"), self.spark._jsc.hadoopConfiguration()).rename(self._path(part), self._path(self.index), how)
        used = {p for t in (old | tables).values() for p in [*t["paths"].values(), *t.get("before", [])]}
        for n in tables:
            for p in old.get(n, {}).get("before", []):
                if p not in used:
                    self._fs().delete(self._path(p), True)
                folder = p.rsplit("/", 1)[0]
                if "/_bucket=" in p and not any(u.startswith(folder + "/") for u in used):
                    self._fs().delete(self._path(folder), True)

    def has(self, name: str) -> bool:
        return name in self._at()

    def require(self, *names: str) -> None:
        """Raise if tables are missing; nothing is created for the caller."""
        if missing := [n for n in names if not self.has(n)]:
            raise LookupError(f"missing tables: {', '.join(missing)}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(*sorted(self._at()[name]["paths"].values()))

    def swap(self, tables: dict[str, DataFrame]) -> None:
        """Write snapshots of all the tables, then publish them with one rename. A failure leaves the old ones."""
        new = {n: f"{self.root}/{n}-{uuid.uuid4().hex}" for n in tables}
        try:
            for n, df in tables.items():
                df.write.parquet(new[n])
        except BaseException:
            for p in new.values():
                self._fs().delete(self._path(p), True)
            raise
        self._publish({n: {"keys": [], "paths": {"all": p}} for n, p in new.items()})

    def merge(self, name: str, new: DataFrame, keys: list[str], rules: dict[str, str], newer: str | None = None, insert_only: bool = False) -> dict[str, int]:
        """Upsert into a table; the numbers of rows of `new` that were inserted, updated or skipped, without zeros."""
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.BUCKETS)).cast("int")
        batch, n = cut_counted(new, F.lit(True), "batch")  # it may depend on the table itself
        old = self._at().get(name)
        if old is None:
            if not n:
                self.swap({name: batch})
                return {}
            old = {"keys": keys, "paths": {}}
        if not n:
            return {}
        touched = {str(r[0]) for r in batch.select(bucket).distinct().collect()}  # at most BUCKETS
        whole = old["keys"] != keys  # not in buckets yet
        mine = [p for k, p in old["paths"].items() if whole or k in touched]
        merged = upsert.upsert(self.spark.read.parquet(*mine) if mine else batch.limit(0), batch, keys, rules, newer, insert_only)
        seen = Observation()
        merged = merged.observe(seen, F.count_if(F.col("_action") == "insert").alias("insert"), F.count_if(F.col("_action") == "update").alias("update"))
        at = f"{self.root}/{name}-{uuid.uuid4().hex}"
        merged.withColumn("_bucket", bucket).drop("_action").repartition("_bucket").write.partitionBy("_bucket").parquet(at)
        made = {str(f.getPath().getName()).removeprefix("_bucket="): str(f.getPath()) for f in self._fs().listStatus(self._path(at)) if f.isDirectory()}
        kept = {} if whole else {k: p for k, p in old["paths"].items() if k not in touched}
        self._publish({name: {"keys": keys, "paths": kept | made}})
        counts = {k: seen.get[k] or 0 for k in ("insert", "update")}
        counts["skip"] = n - sum(counts.values())
        return {k: v for k, v in counts.items() if v}


def ingest_logs(w: Warehouse, base: str, limit: int | None = None) -> dict[str, int]:
    """Log records of all devices. `limit` takes so many conversations of each device that have something new, by name."""
    lines = jsonl.read_session_logs(w.spark, base)
    records, errors = jsonl.parse_records(lines)
    keys = ["conversation_id", "line_number"]
    take = dict.fromkeys(["record_type", "record_uuid", "parent_uuid", "session_id", "record_ts", "data", "file_mtime"], upsert.TAKE)
    rules = {"device": upsert.KEEP, "project_path": upsert.KEEP} | take
    numbered = records.withColumn("ord", F.xxhash64("device", "project_path"))
    if limit:
        stored = w.read("agent_raw").select(*keys, F.col("file_mtime").alias("stored_mtime")) if w.has("agent_raw") else w.spark.createDataFrame([], "conversation_id string, line_number int, stored_mtime timestamp")
        fresh = numbered.select("device", *keys, "file_mtime").join(stored, keys, "left").filter("stored_mtime is null or stored_mtime < file_mtime")
        nth = F.row_number().over(W.partitionBy("device").orderBy("conversation_id"))
        chosen = fresh.select("device", "conversation_id").distinct().withColumn("nth", nth).filter(F.col("nth") <= limit)
        numbered = numbered.join(chosen.select("device", "conversation_id"), ["device", "conversation_id"], "left_semi")
    one = cut(upsert.collapse(numbered, keys, rules, "ord", newer="file_mtime"), "logs")
    counts = w.merge("agent_raw", one, keys, take, newer="file_mtime")
    bad = errors.count()
    return counts | ({"error": bad} if bad else {})


def ingest_web(w: Warehouse, paths: list[str]) -> dict[str, int]:
    items, _, errors = zip_json.read_archives(w.spark, paths)
    convs, bad = zip_json.web_conversations(items)
    order = F.struct("file_ordinal", "ordinal")
    versions = convs.withColumn("o", order)
    if w.has("web_raw"):
        stored = w.read("web_raw").select("conversation_id", "updated_at").withColumns({"o": F.struct(F.lit(-1).alias("file_ordinal"), F.lit(-1).alias("ordinal")), "stored": F.lit(True)})
        versions = versions.withColumn("stored", F.lit(False)).unionByName(stored, allowMissingColumns=True)
    else:
        versions = versions.withColumn("stored", F.lit(False))
    every = cut(upsert.accepted_versions(versions, "conversation_id", "updated_at", "o").filter("not stored").drop("stored"), "versions")
    ok = every.filter("accepted").drop("accepted")
    keep, take = ["account_id", "account_email", "created_at"], ["name", "updated_at", "data", "source_file"]
    raw = upsert.collapse(ok, ["conversation_id"], dict.fromkeys(keep, upsert.KEEP) | dict.fromkeys(take, upsert.TAKE), "o")
    messages = zip_json.web_messages(ok).withColumn("o", F.struct("file_ordinal", "i"))
    mkeep, mtake = ["conversation_uuid", "sender", "created_at", "parent_message_uuid"], ["content", "updated_at", "metadata", "raw_data"]
    msgs = upsert.collapse(messages.filter("uuid is not null"), ["uuid"], dict.fromkeys(mkeep, upsert.KEEP) | dict.fromkeys(mtake, upsert.TAKE), "o").withColumn("is_canonical", F.lit(False))
    raw, msgs = cut(raw, "raw"), cut(msgs, "msgs")  # both depend on the stored versions, which the first merge replaces
    counts = w.merge("web_raw", raw, ["conversation_id"], dict.fromkeys(take, upsert.TAKE))
    said = w.merge("web_messages", msgs, ["uuid"], dict.fromkeys(mtake, upsert.TAKE))
    refused = every.filter("not accepted").count()
    return counts | ({"skip": refused} if refused else {}) | {f"messages_{k}": v for k, v in said.items()} | _failures(errors, bad)


def _failures(errors: DataFrame, bad: DataFrame | None = None) -> dict[str, object]:
    """How many archives and conversations failed, and the archives that they are in; one row per archive."""
    per = errors.select("archive") if bad is None else errors.select("archive").unionByName(bad.select("archive"))
    rows = per.groupBy("archive").agg(F.count("*").alias("n")).collect()
    return {"error": sum(r["n"] for r in rows), "failed": sorted(r["archive"] for r in rows)}


def ingest_tree(w: Warehouse, paths: list[str], attachment_root: str | None = None, reprocess_attachments: bool = False) -> dict[str, int]:
    """Tree exports. A version of a conversation counts where it is newer than the stored one and the versions before it;
    the messages of all versions that count are merged in their order, so none of an earlier one is lost, and none of an
    older export than the stored comes in. With `reprocess_attachments` the files of all versions are extracted again.
    """
    items, members, errors = zip_json.read_archives(w.spark, paths)
    convs = zip_json.tree_conversations(items)
    order = F.struct("file_ordinal", "ordinal")
    versions = convs.withColumns({"o": order, "stored": F.lit(False)})
    if w.has("tree_raw"):
        stored = w.read("tree_raw").select("conversation_id", "updated_at").withColumns({"o": F.struct(F.lit(-1).alias("file_ordinal"), F.lit(-1).alias("ordinal")), "stored": F.lit(True)})
        versions = versions.unionByName(stored, allowMissingColumns=True)
    every = cut(upsert.accepted_versions(versions, "conversation_id", "updated_at", "o").filter("not stored").drop("stored"), "versions")
    ok = every.filter("accepted")
    raw = upsert.collapse(ok, ["conversation_id"], {"created_at": upsert.KEEP, "title": upsert.TAKE, "updated_at": upsert.TAKE, "raw": upsert.TAKE, "archive": upsert.TAKE}, "o")
    nodes = cut(tree.tree_messages(every if reprocess_attachments else ok, keep=("archive", "accepted", "o")), "tree")
    keep, take = ["conversation_id", "parent_id", "sender", "content_type", "created_at"], ["content", "is_canonical"]
    msgs = upsert.collapse(nodes.filter("accepted"), ["message_id"], dict.fromkeys(keep, upsert.KEEP) | dict.fromkeys(take, upsert.TAKE), "o")
    raw, msgs = cut(raw, "raw"), cut(msgs, "msgs")
    refused = every.filter("not accepted").count()
    counts = w.merge("tree_raw", raw.withColumnRenamed("raw", "data"), ["conversation_id"], dict.fromkeys(["title", "updated_at", "data", "archive"], upsert.TAKE))
    said = w.merge("tree_messages", msgs, ["message_id"], dict.fromkeys(take, upsert.TAKE))
    out = counts | ({"skip": refused} if refused else {}) | {f"messages_{k}": v for k, v in said.items()}
    if attachment_root:
        assets = nodes.filter("size(assets) > 0")
        pointers = assets.select("archive", "conversation_id", F.explode("assets").alias("a")).select("archive", "conversation_id", "a.asset_pointer")
        matched = cut(tree.match_assets(pointers, members), "matched")
        wanted = pointers.join(matched, ["archive", "asset_pointer"])
        files = cut(attachments.extract_attachments(wanted, attachment_root), "files")
        rows = attachments.attachment_rows(assets, matched, files).filter("file_path is not null")
        key = ["source", "conversation_id", "filename"]
        first = dict.fromkeys([c for c in rows.columns if c not in (*key, "file_path", "file_hash")], upsert.KEEP)
        rows = upsert.collapse(rows.withColumn("o", F.struct("created_at", "message_id", "asset_pointer")), key, first | dict.fromkeys(["file_path", "file_hash"], upsert.TAKE), "o")
        got = w.merge("attachments", cut(rows, "attachments"), key, dict.fromkeys(["file_path", "file_hash"], upsert.TAKE))
        out["attachments"] = sum(got.values())
    return out | _failures(errors)


def _empty(w: Warehouse, name: str, schema: str) -> DataFrame:
    return w.read(name) if w.has(name) else w.spark.createDataFrame([], schema)


RAW = "device string, project_path string, conversation_id string, line_number int, record_type string, record_uuid string, parent_uuid string, session_id string, record_ts timestamp, data string, file_mtime timestamp"
WEB_RAW = "conversation_id string, account_id string, account_email string, created_at timestamp, name string, updated_at timestamp, data string, source_file string"
WEB = "uuid string, conversation_uuid string, sender string, created_at timestamp, parent_message_uuid string, content string, updated_at timestamp, metadata string, raw_data string, is_canonical boolean"
TREE_RAW = "conversation_id string, created_at timestamp, title string, updated_at timestamp, data string, archive string"
TREE = "message_id string, conversation_id string, parent_id string, sender string, content string, content_type string, created_at timestamp, is_canonical boolean"
STORED = "source_uuid string, source_type string, content_hash string, embedding array<float>, model string, updated_at timestamp"
TOPICS = "topic_id string, conversation_id string, source_type string, start_msg_idx int, end_msg_idx int"


def run_normalize(w: Warehouse, mode: str = normalize.SNAPSHOT) -> dict[str, int]:
    """All per-source and unified tables; published at once. Accounts and conversations that are there keep what the rules
    keep (first dates, devices) and take the later of the last dates."""
    raw, web_raw = _empty(w, "agent_raw", RAW), _empty(w, "web_raw", WEB_RAW)
    web = normalize.canonical_web(_empty(w, "web_messages", WEB))
    merged = lambda n, new, rule: rule(w.read(n), new).drop("_action") if w.has(n) else new
    t = {
        "web_accounts": merged("web_accounts", normalize.web_accounts(web_raw), normalize.merge_accounts), "web_conversations": merged("web_conversations", normalize.web_conversations(web_raw), normalize.merge_web_conversations), "web_messages": web,
        "agent_conversations": merged("agent_conversations", normalize.agent_conversations(raw), normalize.merge_agent_conversations), "agent_messages": normalize.agent_messages(raw),
        "tree_conversations": _empty(w, "tree_raw", TREE_RAW), "tree_messages": _empty(w, "tree_messages", TREE), "agent_raw": raw,
    }
    stored = {n: w.read(n) for n in ("accounts", "conversations", "messages") if w.has(n)}
    out = normalize.unified(t, stored, mode)
    w.swap({n: t[n] for n in ("web_accounts", "web_conversations", "web_messages", "agent_conversations", "agent_messages")} | out)
    return {r["table_name"]: r["n"] for r in normalize.status({n: w.read(n) for n in out}).collect()}


def run_embed(w: Warehouse, model: E.Embedder | None = None, limit: int | None = None) -> dict[str, int]:
    """Vectors of all pending texts: by hash where one is stored, else by the model."""
    model = model or E.HashingEmbedder()
    stored = _empty(w, "message_embeddings", STORED)
    pending = reuse.pending_messages(_empty(w, "web_messages", WEB), stored, "uuid", "content", "web", limit=limit)
    pending = pending.unionByName(reuse.pending_records(_empty(w, "agent_raw", RAW), stored, limit)).unionByName(reuse.pending_messages(_empty(w, "tree_messages", TREE), stored, "message_id", "content", "chatgpt", canonical=True, limit=limit)).dropDuplicates(["source_uuid"])
    reused, rest = reuse.reuse_by_hash(cut(pending, "pending"), stored)
    made = E.embed_pending(rest.drop("content_hash"), model)
    new = cut(reused.unionByName(made).withColumn("updated_at", F.current_timestamp()), "vectors")
    return w.merge("message_embeddings", new, ["source_uuid"], {}, insert_only=True)


def run_topics(w: Warehouse, model: E.Embedder | None = None, limit: int | None = None, worker: int | None = None, workers: int = 1) -> dict[str, int]:
    """Topics of the conversations that are eligible: enough messages with vectors, and no topics yet. `limit` takes the
    largest of each source, `worker` of `workers` those of one slice by hash of the conversation.
    """
    stored, done = _empty(w, "message_embeddings", STORED), _empty(w, "topics", TOPICS)
    web_msgs, raw = _empty(w, "web_messages", WEB), _empty(w, "agent_raw", RAW)
    ready = lambda msgs, conv, key: segment.hash_slice(segment.eligible_conversations(msgs, stored, done, conv, key), conv, worker, workers)
    first = lambda e, conv: (e.orderBy(F.desc("n_embedded"), conv).limit(limit) if limit else e).select(F.col(conv).alias("conversation_id"))
    web_ready = first(ready(web_msgs.filter("conversation_uuid is not null"), "conversation_uuid", "uuid"), "conversation_uuid")
    agent_ready = first(ready(topics.agent_messages_with_text(raw), "conversation_id", "record_uuid"), "conversation_id")
    web = topics.web_sequence(web_msgs, stored).join(web_ready, "conversation_id", "left_semi")
    agent = topics.agent_sequence(raw, stored).join(agent_ready, "conversation_id", "left_semi")
    new = topics.build_topics(web, "web", model).unionByName(topics.build_topics(agent, "code", model))
    return w.merge("topics", new, ["conversation_id", "start_msg_idx", "end_msg_idx"], {}, insert_only=True)


def run_reembed_messages(w: Warehouse, model: E.Embedder | None = None, worker: int | None = None, workers: int = 1) -> int:
    """New vectors for stored messages from their texts, all or those of one worker; the number of stored rows."""
    w.require("message_embeddings")
    stored = w.read("message_embeddings")
    mine = stored.select("source_uuid", "source_type")
    if worker is not None:
        mine = stats.worker_slice(mine, "source_uuid", workers).filter(F.col("worker") == worker).select("source_uuid", "source_type")
    contents = reuse.stored_contents(mine, _empty(w, "agent_messages", "uuid string, content string"), _empty(w, "web_messages", WEB))
    w.swap({"message_embeddings": E.reembed(stored, contents, model or E.HashingEmbedder(), "source_uuid", "content")})
    return w.read("message_embeddings").count()


def run_reembed_topics(w: Warehouse, model: E.Embedder | None = None) -> int:
    """New vectors for topics from their summaries. Topics without a summary keep theirs, unless the model gives vectors
    of another width than is stored: then the column is emptied first, as for a schema of another width."""
    w.require("topics")
    model, t = model or E.HashingEmbedder(), w.read("topics")
    if not t.filter(F.size("embedding") != model.dims).isEmpty():
        t = topics.widen_vectors(t)
    w.swap({"topics": topics.reembed_topics(t, model)})
    return w.read("topics").count()


def dry_run(w: Warehouse, logs: str | None, archives: list[str]) -> dict[str, object]:
    """What the ingesting stages would read: session files per device; conversations, messages and attachments per archive."""
    out: dict[str, object] = {}
    if logs:
        out["logs"] = {r["device"]: r["n_files"] for r in jsonl.count_files(w.spark, logs).collect()}  # a row per device
    if archives:
        items, members, errors = zip_json.read_archives(w.spark, archives)
        out["archives"] = {r["archive"]: (r["n_conversations"], r["n_messages"], r["n_attachments"]) for r in zip_json.dry_run(items, members).collect()}  # a row per archive
        out["failed"] = [r["archive"] for r in errors.collect()]
    return out


def run_status(w: Warehouse) -> DataFrame:
    t = {"web": _empty(w, "web_messages", WEB).select("uuid"), "code": _empty(w, "agent_messages", "uuid string").select("uuid"), "chatgpt": _empty(w, "tree_messages", TREE).select("message_id")}
    return stats.embedding_coverage(t, _empty(w, "message_embeddings", STORED))


@dataclass
class Pipeline:
    """Named stages in order. With `on_error="continue"` a failed stage is logged and the next one runs."""

    stages: list[tuple[str, Callable[[], object]]]
    on_error: str = "continue"
    results: dict[str, object] = field(default_factory=dict)

    def run(self, skip: set[str] | None = None, dry: bool = False) -> dict[str, object]:
        for name, stage in self.stages:
            if skip and name in skip:
                continue
            if dry:
                self.results[name] = "not run"
                continue
            try:
                self.results[name] = stage()
            except Exception as e:
                if self.on_error != "continue":
                    raise
                log.exception("stage %s failed", name)
                self.results[name] = e
        return self.results


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="chatlake", description="Stages of the warehouse.")
    p.add_argument("stage", choices=["logs", "web", "tree", "normalize", "embed", "topics", "reembed-messages", "reembed-topics", "status", "all"])
    p.add_argument("--warehouse", required=True)
    p.add_argument("--logs")
    p.add_argument("--web-inbox", action="append", default=[])
    p.add_argument("--tree-inbox", action="append", default=[])
    p.add_argument("--mirror", action="append", default=[], help="folders of tree exports that are read but never moved")
    p.add_argument("--file", help="one archive instead of all")
    p.add_argument("--attachments")
    p.add_argument("--reprocess-attachments", action="store_true")
    p.add_argument("--limit", type=int)
    p.add_argument("--worker", type=int)
    p.add_argument("--workers", type=int, default=1)
    p.add_argument("--skip", action="append", default=[])
    p.add_argument("--dry-run", action="store_true")
    a = p.parse_args(argv)
    w = Warehouse(build_session(), a.warehouse)
    found = lambda *roots: [a.file] if a.file else zip_json.list_archives([r for rs in roots for r in rs], a.limit)
    stages: dict[str, Callable[[], object]] = {
        "logs": lambda: ingest_logs(w, a.logs, a.limit) if a.logs else {},
        "web": lambda: archive_done(found(a.web_inbox), lambda ps: ingest_web(w, ps), a.web_inbox),
        "tree": lambda: archive_done(found(a.tree_inbox, a.mirror), lambda ps: ingest_tree(w, ps, a.attachments, a.reprocess_attachments), a.tree_inbox),
        "normalize": lambda: run_normalize(w),
        "embed": lambda: run_embed(w, limit=a.limit),
        "topics": lambda: run_topics(w, limit=a.limit, worker=a.worker, workers=a.workers),
    }
    others = {"reembed-messages": lambda: run_reembed_messages(w, worker=a.worker, workers=a.workers), "reembed-topics": lambda: run_reembed_topics(w)}
    if a.stage == "status":
        run_status(w).show()
        return 0
    if a.dry_run:
        print(dry_run(w, a.logs, found(a.web_inbox, a.tree_inbox, a.mirror)))
        return 0
    names = list(stages) if a.stage == "all" else [a.stage]
    out = Pipeline([(n, (stages | others)[n]) for n in names]).run(set(a.skip))
    for n, r in out.items():
        print(n, r)
    return int(any(isinstance(r, Exception) for r in out.values()))


def archive_done(paths: list[str], ingest: Callable[[list[str]], dict[str, int]], inboxes: list[str] | None = None) -> dict[str, int]:
    """Ingest archives and move those without an error to `processed` beside them; only out of `inboxes`, where given."""
    counts = ingest(paths) if paths else {}
    bad = {os.path.basename(str(f)) for f in counts.get("failed", [])}
    roots = None if inboxes is None else {os.path.abspath(r) for r in inboxes}
    for p in paths:
        if os.path.basename(p) in bad or roots is not None and os.path.dirname(os.path.abspath(p)) not in roots:
            continue
        done = os.path.join(os.path.dirname(p), "processed")
        os.makedirs(done, exist_ok=True)
        os.replace(p, os.path.join(done, os.path.basename(p)))
    return counts


if __name__ == "__main__":
    raise SystemExit(main())
