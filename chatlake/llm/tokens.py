"""Byte-level BPE encoding and decoding of text columns with a public rank file.

Method. A pre-token is cut by the vocabulary's public pattern; its bytes are a doubly linked list of symbols, and a
priority queue holds the ranks of the adjacent pairs. The lowest rank is merged, its neighbours get new entries, and
entries whose symbols have changed meanwhile are skipped when they come up (stale). So a pre-token of n bytes costs
n log n, also when a text is one long run without spaces. Encoded pre-tokens are kept in a bounded table per Python
worker, because words repeat. Decoding concatenates the vocabulary's byte strings.

Null texts give null ids, empty texts give an empty list; strings of special tokens are ordinary text; lone surrogates
cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the public vocabulary files lie; a parameter of every function here.
TOKENIZER_DIR = os.environ.get("CHATLAKE_TOKENIZERS", "/opt/tokenizers")
#: The published pre-token pattern of the rank files (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens kept per worker, and the longest that is kept.
CACHE_ITEMS, CACHE_CHARS = 400_000, 48

_loaded: dict[str, Bpe] = {}


class Bpe:
    """A rank vocabulary with its encoder and decoder."""

    def __init__(self, path: str):
        import regex

        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.words = {v: k for k, v in self.ranks.items()}
        self.split = regex.compile(PATTERN).findall
        self.cache: dict[str, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token by merging the lowest-ranked adjacent pair first, the leftmost of equals."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        sym: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = ranks.get(piece[i : i + 2])
            if r is not None:
                heap.append((r, i, 2))
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            a = sym[i]
            if a is None:
                continue
            j = nxt[i]
            if j >= n or len(a) + len(sym[j]) != size:
                continue  # stale: one of the two has been merged since
            sym[i] = a = a + sym[j]
            sym[j] = None
            k = nxt[i] = nxt[j]
            if k < n:
                prv[k] = i
                r = ranks.get(a + sym[k])
                if r is not None:
                    heappush(heap, (r, i, len(a) + len(sym[k])))
            h = prv[i]
            if h >= 0:
                r = ranks.get(sym[h] + a)
                if r is not None:
                    heappush(heap, (r, h, len(sym[h]) + len(a)))
        return [ranks[s] for s in sym if s is not None]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        cache, add = self.cache, out.extend
        for w in self.split(text):
            ids = cache.get(w)
            if ids is None:
                ids = self.merge(w.encode())
                if len(w) <= CACHE_CHARS:
                    if len(cache) >= CACHE_ITEMS:
                        cache.clear()
                    cache[w] = ids
            add(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.words[i] for i in ids).decode("utf-8", "replace")


def load_bpe(path: str) -> Bpe:
    """The vocabulary of a rank file; read once per Python worker, from what came with the job where it is not there."""
    if path not in _loaded:
        _loaded[path] = Bpe(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))
    return _loaded[path]


def rank_file(name: str, tokenizer_dir: str | None = None) -> str:
    return os.path.join(tokenizer_dir or TOKENIZER_DIR, f"{name}.tiktoken")


def _ship(df: DataFrame, path: str) -> None:
    """Let the file travel with the job, for executors that do not have it at its path."""
    if os.path.exists(path):
        df.sparkSession.sparkContext.addFile(path)


def encode_column(df: DataFrame, id_col: str, text_col: str, name: str = "byte_bpe_50k", tokenizer_dir: str | None = None, ids_col: str = "ids") -> DataFrame:
    """(id, ids): one row per row of `df`, in any order. Only the two columns are read."""
    path = rank_file(name, tokenizer_dir)
    _ship(df, path)
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load_bpe(path)
        kind = pa.list_(pa.int32())
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                ids = [None if t is None else bpe.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, kind)], names=["id", ids_col])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, {ids_col} array<int>").withColumnRenamed("id", id_col)


def decode_column(df: DataFrame, id_col: str, ids_col: str, name: str = "byte_bpe_50k", tokenizer_dir: str | None = None) -> DataFrame:
    """(id, text): the inverse of `encode_column`. Null ids give null."""
    path = rank_file(name, tokenizer_dir)
    _ship(df, path)
    src = df.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load_bpe(path)
        for b in batches:
            texts = [None if x is None else bpe.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)


def count_tokens(name: str = "byte_bpe_50k", tokenizer_dir: str | None = None) -> Callable[..., Column]:
    """A vectorised function of a text column: its number of tokens; null for null."""
    path = rank_file(name, tokenizer_dir)

    def count(texts: pd.Series) -> pd.Series:
        bpe = load_bpe(path)
        return pd.Series([None if t is None else len(bpe.encode(t)) for t in texts], dtype="Int64")

    return F.pandas_udf(count, "bigint")  # type: ignore[call-overload]
