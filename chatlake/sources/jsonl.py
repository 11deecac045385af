"""Session logs: one JSON record per line, one file per conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.functions import ids, jsonx, text

LAYOUT = r"([^/]+)/\.claude/projects/([^/]+)/([^/]+)\.jsonl$"


def read_session_logs(spark: SparkSession, base: str) -> DataFrame:
    """(device, project_path, file_conversation, conversation_id, file_mtime, path, line_number, line) of
    `<base>/<device>/.claude/projects/<folder>/<conversation>.jsonl`.

    Lines are numbered from 1 and blank ones count. A file is one row only while it is split; its lines then spread.
    """
    files = spark.read.text(f"{base}/*/.claude/projects/*/*.jsonl", wholetext=True).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("file_mtime"))
    part = lambda i: F.url_decode(F.regexp_replace(F.regexp_extract("path", LAYOUT, i), r"\+", "%2B"))
    lines = files.select(part(1).alias("device"), ids.project_path(part(2)).alias("project_path"), part(3).alias("file_conversation"), "file_mtime", "path", F.posexplode(F.split("value", "\r\n|\n|\r")).alias("i", "line"))
    out = lines.select("device", "project_path", "file_conversation", ids.conversation_id(F.col("file_conversation")).alias("conversation_id"), "file_mtime", "path", (F.col("i") + 1).cast("int").alias("line_number"), F.regexp_replace("line", r"(?U)^\s+|\s+$", "").alias("line"))
    return out.filter("line <> ''")


def parse_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, errors). Bad JSON lines are left out; a file with a line that is JSON but no object is an error as a
    whole and gives no records. Records have the columns of the raw table."""
    v = F.try_parse_json("line")
    kind = F.schema_of_variant(v)
    parsed = lines.withColumn("kind", kind).filter("kind is not null")
    bad = parsed.filter(~F.startswith("kind", F.lit("OBJECT"))).groupBy("path").agg(F.min("line_number").alias("line_number"))
    good = parsed.join(bad.select("path"), "path", "left_anti")
    raw = text.strip_nul_json(F.col("line"))
    fields = jsonx.record_fields(F.col("data"))
    records = good.select("device", "project_path", "conversation_id", "line_number", "file_mtime", raw.alias("data"))
    return records.select("device", "project_path", "conversation_id", "line_number", *[c.alias(n) for n, c in fields.items()], "data", "file_mtime"), bad.withColumn("error", F.lit("record is no object"))


def count_files(spark: SparkSession, base: str) -> DataFrame:
    """(device, n_files): a dry run; all session files at any depth below a device's projects, contents unread."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", True).load(f"{base}/*/.claude/projects").select("path")
    return files.select(F.regexp_extract("path", r"([^/]+)/\.claude/projects/", 1).alias("device")).filter("device <> ''").groupBy("device").agg(F.count("*").alias("n_files"))
