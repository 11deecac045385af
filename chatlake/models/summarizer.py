"""Summaries of topic chunks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake import constants as K
from chatlake.functions import text


class Summarizer(Protocol):
    """Turns one text into a short one. A failure gives an empty summary."""

    def summarize(self, text: str) -> str: ...


class FirstLine:
    """The first line with something in it, without its role, up to a length."""

    def __init__(self, limit: int = 160):
        self.limit = limit

    def summarize(self, text: str) -> str:
        for line in text.splitlines():
            line = line.partition("]: ")[2] if line.startswith("[") and "]: " in line else line
            if line.strip():
                return line.strip()[: self.limit]
        return ""


def summarize(df: DataFrame, model: Summarizer, keys: list[str], content: str) -> DataFrame:
    """(*keys, topic_summary)."""
    cut = text.truncate(F.coalesce(content, F.lit("")), K.SUMMARY_CHARS, "\n" + K.CUT_MARK)
    src = df.select(*keys, cut.alias("_t"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def one(t: str) -> str:
        try:
            return model.summarize(t)
        except Exception:  # noqa: BLE001 - any failure of a model gives an empty summary
            return ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({**{k: b[k].tolist() for k in keys}, "topic_summary": [one(t) for t in b["_t"]]})

    return src.mapInPandas(run, f"{kinds}, topic_summary string")
