"""Text of messages: content blocks, parts, pieces, truncation, blobs, hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatlake import constants as K

BLOCKS = "array<struct<type:string,text:string>>"


def content_hash(text: Column) -> Column:
    """First 32 hex digits of the SHA-256 of the UTF-8 text; null counts as empty."""
    return F.substring(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256), 1, 32)


def file_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def strip_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\x00"), F.lit(""))


def strip_nul_json(raw: Column) -> Column:
    r"""Remove the escape \u0000 from raw JSON, but not where its backslash is itself escaped."""
    return F.regexp_replace(raw, r"(?<!\\)((?:\\\\)*)\\u0000", "$1")


def blocks_text(blocks: Column) -> Column:
    """Blocks with text, joined by a blank line; a type other than `text` is put before in brackets."""
    kept = F.filter(blocks, lambda b: F.coalesce(b["text"], F.lit("")) != "")
    said = F.transform(kept, lambda b: F.when(F.coalesce(b["type"], F.lit("")).isin("", "text"), b["text"]).otherwise(F.concat(F.lit("["), b["type"], F.lit("] "), b["text"])))
    return F.coalesce(F.array_join(said, "\n\n"), F.lit(""))


def message_text(blocks: Column, text: Column) -> Column:
    """Text of the blocks, else the plain text, else empty."""
    b = blocks_text(blocks)
    return F.when(b != "", b).otherwise(F.coalesce(text, F.lit("")))


def parts_text(parts: Column) -> Column:
    """Of `array<variant>`: strings and objects with a text and no asset, joined by line ends."""
    kind = lambda p: F.schema_of_variant(p)
    is_text = lambda p: (kind(p) == "STRING") | (F.startswith(kind(p), F.lit("OBJECT")) & F.try_variant_get(p, "$.asset_pointer", "string").isNull() & F.try_variant_get(p, "$.text", "string").isNotNull())
    said = F.transform(F.filter(parts, is_text), lambda p: F.when(kind(p) == "STRING", F.try_variant_get(p, "$", "string")).otherwise(F.try_variant_get(p, "$.text", "string")))
    return F.coalesce(F.array_join(said, "\n"), F.lit(""))


def parts_assets(parts: Column) -> Column:
    """The attachments among the parts: array of (asset_pointer, content_type, size_bytes, width, height, metadata)."""
    get = lambda p, path, t: F.try_variant_get(p, path, t)
    has = F.filter(parts, lambda p: F.startswith(F.schema_of_variant(p), F.lit("OBJECT")) & (F.coalesce(get(p, "$.asset_pointer", "string"), F.lit("")) != ""))
    return F.transform(
        has,
        lambda p: F.struct(
            get(p, "$.asset_pointer", "string").alias("asset_pointer"), get(p, "$.content_type", "string").alias("content_type"), get(p, "$.size_bytes", "bigint").alias("size_bytes"), get(p, "$.width", "int").alias("width"), get(p, "$.height", "int").alias("height"), F.to_json(F.try_variant_get(p, "$.metadata", "variant")).alias("metadata")
        ),
    )


def truncate(text: Column, limit: int = K.MAX_TEXT_CHARS, mark: str = K.CUT_MARK) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(mark))).otherwise(text)


def pieces(text: Column, size: int = K.PIECE_CHARS, overlap: int = K.PIECE_OVERLAP) -> Column:
    """Overlapping pieces of fixed size; a text within the size is one piece. No loop: the starts are a sequence."""
    stride = size - overlap
    n = F.when(F.length(text) <= size, 1).otherwise(F.ceil((F.length(text) - overlap) / F.lit(stride)).cast("int"))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.substring(text, k * stride + 1, F.lit(size)))


def pieces_of(text: str, size: int = K.PIECE_CHARS, overlap: int = K.PIECE_OVERLAP) -> list[str]:
    """The same pieces of a Python string."""
    stride = size - overlap
    n = 1 if len(text) <= size else -(-(len(text) - overlap) // stride)
    return [text[k * stride : k * stride + size] for k in range(n)]


def strip_blobs(text: Column) -> Column:
    return F.regexp_replace(text, K.BLOB_PATTERN, K.BLOB_MARK)


def for_model(text: Column) -> Column:
    """Truncated, and one blank for an empty text."""
    t = truncate(text)
    return F.when(t == "", F.lit(" ")).otherwise(t)


def role_label(role: Column) -> Column:
    return F.when(F.coalesce(role, F.lit("")) == "", "MSG").otherwise(F.upper(role))


def is_blank(text: Column) -> Column:
    """Null, empty, or only Unicode white space."""
    return text.isNull() | ~text.rlike(r"(?U)[^\s\x1c-\x1f]")


def content_type(name: Column) -> Column:
    """By the suffix in lower case."""
    suffix = F.lower(F.regexp_extract(name, r"[^/.](\.[^./]+)$", 1))
    return reduce(lambda rest, kv: F.when(suffix == kv[0], F.lit(kv[1])).otherwise(rest), K.CONTENT_TYPES.items(), F.lit(K.DEFAULT_CONTENT_TYPE))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def display_name(name: Column, summary: Column) -> Column:
    empty = F.lit("")
    return F.coalesce(F.nullif(name, empty), F.nullif(summary, empty), F.lit("Untitled"))
