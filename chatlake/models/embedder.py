"""Model calls behind replaceable interfaces, with deterministic local defaults."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.functions import text


class TooLong(Exception):
    """A batch that the model refuses because of its length."""


class Embedder(Protocol):
    """Turns texts into vectors, in order. Instances travel to the executors."""

    name: str
    dims: int

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class HashingEmbedder:
    """Signed hashing of lower-case words into a unit vector. No network, same result everywhere."""

    def __init__(self, dims: int = 128, max_batch_chars: int | None = None):
        self.name, self.dims, self.max_batch_chars = f"hashing-{dims}", dims, max_batch_chars

    def embed(self, texts: list[str]) -> list[list[float]]:
        if self.max_batch_chars and sum(map(len, texts)) > self.max_batch_chars:
            raise TooLong
        out = np.zeros((len(texts), self.dims))
        for row, t in zip(out, texts, strict=True):
            for w in re.findall(r"\w+", t.lower()):
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                row[h % self.dims] += 1.0 if h >> 63 else -1.0
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norm == 0, 1, norm)).tolist()


def embed_halving(model: Embedder, texts: list[str], wholes: list[str] | None = None) -> list[list[float] | None]:
    """Vectors of a batch. A batch that is too long is halved until single texts remain; of such a one, the whole text
    (`wholes`, where what is in `texts` was truncated) is cut into overlapping pieces, whose vectors are averaged; it gives
    None only if a piece is refused too."""
    wholes = texts if wholes is None else wholes
    try:
        return list(model.embed(texts))
    except TooLong:
        if len(texts) == 1:
            return [_embed_pieces(model, wholes[0])]
        half = len(texts) // 2
        return embed_halving(model, texts[:half], wholes[:half]) + embed_halving(model, texts[half:], wholes[half:])


def _embed_pieces(model: Embedder, whole: str) -> list[float] | None:
    pieces = text.pieces_of(whole)
    if len(pieces) < 2:
        return None
    try:
        return np.mean([model.embed([p])[0] for p in pieces], axis=0).tolist()
    except TooLong:
        return None


def embed_texts(df: DataFrame, model: Embedder, key: str, content: str, batch: int = 100) -> DataFrame:
    """(key, embedding): vectors in batches inside the partitions. Texts are truncated for the model; one that it refuses
    even so is embedded by the pieces of the whole text."""
    whole = F.coalesce(content, F.lit(""))
    src = df.select(F.col(key).cast("string").alias("k"), text.for_model(whole).alias("t"), F.when(F.length(whole) > F.length(text.for_model(whole)), whole).alias("whole"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at : at + batch]
                said = part["t"].tolist()
                wholes = [w if isinstance(w, str) else t for w, t in zip(part["whole"].tolist(), said, strict=True)]
                yield pd.DataFrame({"k": part["k"].tolist(), "embedding": embed_halving(model, said, wholes)})

    return src.mapInPandas(run, "k string, embedding array<float>").withColumnRenamed("k", key)


def embed_pending(pending: DataFrame, model: Embedder) -> DataFrame:
    """(source_uuid, source_type, content_hash, embedding, model) of pending texts.

    Equal texts are embedded once, and a text that the model refuses by its pieces (see `embed_texts`); texts without a
    vector have no row.
    """
    hashed = pending.withColumn("content_hash", text.content_hash(F.col("content")))
    one = hashed.groupBy("content_hash").agg(F.first("content").alias("content"))
    vecs = embed_texts(one, model, "content_hash", "content").filter("embedding is not null")
    return hashed.join(vecs, "content_hash").select("source_uuid", "source_type", "content_hash", "embedding", F.lit(model.name).alias("model"))


def reembed(table: DataFrame, contents: DataFrame, model: Embedder, key: str, content: str) -> DataFrame:
    """`table` with new vectors and model where `contents` has a text for the key; hashes are kept."""
    from chatlake.operators.upsert import update_by_key

    new = embed_texts(contents.filter(~text.is_blank(F.col(content))), model, key, content).withColumn("model", F.lit(model.name))
    return update_by_key(table, new, [key], ["embedding", "model"])
