"""Identifiers: derived UUIDs, paths of projects, ids of unnamed conversations."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from chatlake.constants import ID_NAMESPACE

_HEX32 = r"(?i)^(?:urn:)?(?:uuid:)?[{]*(?:[0-9a-f]-?){32}[}]*$"


def uuid5(name: Column, namespace: str = ID_NAMESPACE) -> Column:
    """The name-based UUID (version 5) of a string, in the JVM."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def conversation_id(raw: Column, namespace: str = ID_NAMESPACE) -> Column:
    """An id that is a UUID in any usual spelling is kept as it is; any other becomes its UUID 5."""
    return F.when(raw.rlike(_HEX32), raw).otherwise(uuid5(raw, namespace))


def project_path(folder: Column) -> Column:
    """`-home-u-x` stands for `/home/u/x`; names without the leading dash are kept."""
    return F.when(F.startswith(folder, F.lit("-")), F.translate(folder, "-", "/")).otherwise(folder)


def topic_id(conv: Column, start: Column, end: Column) -> Column:
    """A deterministic id of a topic chunk."""
    return uuid5(F.concat_ws("/", conv, start.cast("string"), end.cast("string")))


def tree_conversation_id(record: Column) -> Column:
    """Of a tree export's JSON: its `id` (null if that is null), else 32 hex digits of the SHA-256 of the key-sorted mapping.

    The hashed text is Python's default JSON spelling, which no built-in function writes, hence a vectorised one.
    """

    def of(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            try:
                d = json.loads(t)
            except (TypeError, ValueError):
                out.append(None)
                continue
            if "id" in d:
                out.append(d["id"])
            else:
                out.append(hashlib.sha256(json.dumps(d.get("mapping", {}), sort_keys=True).encode()).hexdigest()[:32])
        return pd.Series(out, dtype=object)

    return F.pandas_udf(of, "string")(record)  # type: ignore[call-overload]
