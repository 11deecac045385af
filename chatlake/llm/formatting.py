"""Records that are equal but for their form, collapsed into one record each with the number of its copies.

Method. A Merkle digest from the leaves up. A leaf is normalised (its letters and digits, Unicode L and N, in order, case
folded) and hashed. A JSON object is an unordered node: the digests of its fields are sorted before they are hashed; an
array is an ordered node. Records are grouped by their root digest, and every group is confirmed by comparing the
canonical texts themselves with that of the record that is kept.

Case is folded by upper, then lower, so that texts whose letters change in number when capitalised meet again. A text
without letters or digits, and null, is no case. A text that begins like an object but is no valid JSON is plain text.
Repeated rows of one id count once. Ties: the smallest id is kept.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.runtime import cut

#: Members of a group that meet the kept record in one task; a larger group is spread over as many tasks as it takes.
HOT_ROWS = 100_000


def fold(text: Column) -> Column:
    """Letters and digits in order, case folded. The removal stands between the two conversions, which the optimizer
    would otherwise reduce to the outer one."""
    return F.lower(F.regexp_replace(F.upper(text), r"[^\p{L}\p{N}]+", ""))


def _leaf(text: str) -> str:
    return "".join(c for c in text.upper() if c.isalnum() or _letter_or_number(c)).lower()


def _letter_or_number(c: str) -> bool:
    import unicodedata

    return unicodedata.category(c)[0] in "LN"


def _digest(kind: str, parts: list[str]) -> str:
    return hashlib.sha256((kind + "\x00".join(parts)).encode("utf-8", "surrogatepass")).hexdigest()


def merkle(node: object) -> tuple[str, str]:
    """(digest, canonical text) of a parsed JSON value; objects come as lists of pairs in a `_Pairs`."""
    if isinstance(node, _Pairs):
        kids = []
        for k, v in node:
            d, c = merkle(v)
            key = _leaf(k)
            kids.append((_digest("f", [_digest("l", [key]), d]), f"{key}:{c}"))
        kids.sort()
        return _digest("o", [d for d, _ in kids]), "{" + ",".join(c for _, c in kids) + "}"
    if isinstance(node, list):
        kids = [merkle(v) for v in node]
        return _digest("a", [d for d, _ in kids]), "[" + ",".join(c for _, c in kids) + "]"
    text = _leaf(node if isinstance(node, str) else json.dumps(node))
    return _digest("l", [text]), text


class _Pairs(list):
    """The fields of an object with their repeats."""


def _canonical_json(text: str) -> tuple[str, str] | None:
    """(digest, canonical text) of a JSON object, else None. Numbers keep their spelling."""
    try:
        value = json.loads(text, object_pairs_hook=_Pairs, parse_int=str, parse_float=str, parse_constant=str, strict=False)
        return merkle(value) if isinstance(value, _Pairs) else None
    except (ValueError, RecursionError):
        return None


def _object_root(texts: pd.Series) -> pd.DataFrame:
    rows = [(None, None) if t is None else (_canonical_json(t) or (None, None)) for t in texts]
    return pd.DataFrame(rows, columns=["digest", "canon"])


def roots(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, root, canon) of the records with a letter or digit, one row per id.

    Plain texts stay in the JVM; only texts that begin with a brace pass through Python.
    """
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter(F.col("id").isNotNull() & F.col("text").rlike(r"[\p{L}\p{N}]"))
    object_root = F.pandas_udf(_object_root, "struct<digest string, canon string>")  # type: ignore[call-overload]
    brace = F.col("text").rlike(r"(?U)^[\s﻿]*\{")
    plain = rows.filter(~brace).select("id", fold(F.col("text")).alias("canon")).withColumn("root", F.sha2(F.concat(F.lit("t"), "canon"), 256))
    obj = rows.filter(brace).select("id", fold(F.col("text")).alias("folded"), object_root("text").alias("o"))
    obj = cut(obj, "objects")  # parsed once, read twice
    obj = obj.select("id", F.coalesce("o.canon", "folded").alias("canon"), F.when(F.col("o.digest").isNotNull(), F.col("o.digest")).otherwise(F.sha2(F.concat(F.lit("t"), "folded"), 256)).alias("root"))
    return plain.select("id", "root", "canon").unionByName(obj.select("id", "root", "canon"))


def hash_roots(df: DataFrame, id_col: str, hash_col: str) -> DataFrame:
    """The same for a column of hashes, compared without case, white space and punctuation (and symbols)."""
    canon = F.lower(F.regexp_replace(F.col(hash_col), r"(?U)[\s\p{P}\p{S}\p{C}\p{Z}]+", ""))
    rows = df.select(F.col(id_col).cast("string").alias("id"), canon.alias("canon")).filter("id is not null and canon <> ''")
    return rows.withColumn("root", F.sha2(F.concat(F.lit("t"), "canon"), 256))


def collapse(rooted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, copies) of (id, root, canon) rows.

    groups: (id_keep, n_copies, root), one row per distinct record, n_copies counting the kept one and its confirmed
    copies. copies: (id_keep, id_copy), a row for every other id of a group. The first shuffle moves ids and digests only
    and combines before it; canonical texts are kept for groups of more than one id alone. A group of more than HOT_ROWS
    is salted by its size; there are at most as many of these as HOT_ROWS goes into the rows.
    """
    one = rooted.select("id", "root").distinct()
    salts = F.ceil(F.col("n") / F.lit(HOT_ROWS)).cast("int")
    sizes = cut(one.groupBy("root").agg(F.min("id").alias("id_keep"), F.count("*").alias("n")).withColumn("salts", salts), "groups")
    several = sizes.filter("n > 1").select("root", "id_keep", "salts")
    hot = several.filter("salts > 1").select("root", F.col("salts").alias("hot"))
    rows = rooted
    if not hot.isEmpty():
        rows = rows.join(hot, "root", "left")
    else:
        rows = rows.withColumn("hot", F.lit(1))
    salt = F.pmod(F.xxhash64("id"), F.coalesce("hot", F.lit(1))).cast("int")
    spread = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    members = cut(rows.withColumn("salt", salt).join(several.select("root", "id_keep", "salts", spread), ["root", "salt"]).select("root", "salt", "salts", "id", "id_keep", "canon"), "members")
    kept = members.filter("id = id_keep").dropDuplicates(["root"]).select("root", F.col("canon").alias("kept_canon"), spread)
    met = members.filter("id <> id_keep").join(kept.hint("merge"), ["root", "salt"]).filter(F.col("canon") == F.col("kept_canon"))
    copies = cut(met.select("root", "id_keep", F.col("id").alias("id_copy")).distinct(), "copies")
    confirmed = copies.groupBy("root").agg(F.count("*").alias("more"))
    groups = sizes.join(confirmed, "root", "left").select("id_keep", (F.coalesce("more", F.lit(0)) + 1).alias("n_copies"), "root")
    return groups, copies.select("id_keep", "id_copy")
