"""Attachments of tree exports, written to a content-addressed folder."""

from __future__ import annotations

import hashlib
import os
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.functions import text


def extract_attachments(wanted: DataFrame, root: str) -> DataFrame:
    """(archive, conversation_id, member, file_path, file_hash) for rows (archive, conversation_id, member).

    The bytes go to `<root>/<conversation prefix>/<hash prefix>_<base name>`, which all executors must see; a file that is
    there with the same hash is not written again. A member that cannot be read gives null path and hash. Rows are
    grouped by archive, so an archive is opened once per task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for archive, rows in b.groupby("archive"):
                try:
                    z = zipfile.ZipFile(archive.removeprefix("file:"))
                except OSError:
                    z = None
                except zipfile.BadZipFile:
                    z = None
                for conv, member in zip(rows["conversation_id"], rows["member"], strict=True):
                    try:
                        content = z.read(member)
                        sha = hashlib.sha256(content).hexdigest()
                        path = os.path.join(root, conv[:8], f"{sha[:8]}_{os.path.basename(member)}")
                        if not _same(path, sha):
                            os.makedirs(os.path.dirname(path), exist_ok=True)
                            part = f"{path}.{os.getpid()}.part"
                            with open(part, "wb") as f:
                                f.write(content)
                            os.replace(part, path)
                        out.append((archive, conv, member, path, sha))
                    except Exception:  # noqa: BLE001 - anything unreadable gives nulls
                        out.append((archive, conv, member, None, None))
            yield pd.DataFrame(out, columns=["archive", "conversation_id", "member", "file_path", "file_hash"])

    src = wanted.select("archive", "conversation_id", "member").distinct().repartition("archive").sortWithinPartitions("archive")
    return src.mapInPandas(run, "archive string, conversation_id string, member string, file_path string, file_hash string")


def _same(path: str, sha: str) -> bool:
    try:
        with open(path, "rb") as f:
            return hashlib.sha256(f.read()).hexdigest() == sha
    except OSError:
        return False


def attachment_rows(assets: DataFrame, matched: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of the attachments table from (archive, conversation_id, message_id, created_at, assets)."""
    a = assets.select("archive", "conversation_id", "message_id", "created_at", F.explode("assets").alias("a")).select("archive", "conversation_id", "message_id", "created_at", "a.*").withColumnRenamed("content_type", "part_type")
    j = a.join(matched, ["archive", "asset_pointer"]).join(files, ["archive", "conversation_id", "member"], "left")
    name = text.basename(F.col("member"))
    return j.select(F.lit("chatgpt").alias("source"), "conversation_id", "message_id", "asset_pointer", name.alias("filename"), F.col("member").alias("original_filename"), text.content_type(name).alias("content_type"), "size_bytes", "width", "height", "file_path", "file_hash", "metadata", "created_at")
