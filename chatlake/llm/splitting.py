"""Texts over a size limit, cut into overlapping pieces at natural boundaries.

Method. Lexical cohesion: the text is cut into units (lines, else sentences, else words), and at each gap between units
the words of the block before and of the block after are compared by cosine; a valley of this curve marks a change of
topic, and its depth is the height of the lower of the two peaks beside it. A piece begins where the last one ended less
the overlap. Among the gaps in the second half of its window, or in the first half where the second has none, the deepest
valley is taken, paragraph ends before line ends before sentence ends before words where depths are equal; the last of
equals wins. A stretch without any gap is cut at the limit, but not within a surrogate pair (Python strings have none) or before a sign
that belongs to the one before it (combining marks, joiners, variation selectors, skin tones, halves of flags).

The pieces of an item cover it: piece k+1 starts exactly `overlap` characters before the end of piece k, none is longer
than the limit, and dropping the overlaps gives the text back. Lengths are in code points. Texts within the limit, null
and empty ones give no rows. An overlap of half the limit or more is an error.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Units before and after a gap that are compared.
BLOCK = 6
_WORD = re.compile(r"[^\W_]+")
_BREAK = re.compile(r"\n[ \t]*\n\s*|\n|(?<=[.!?…])[\"'”’)\]]*\s+|[。！？]+|\s+")


def _gaps(text: str) -> list[tuple[int, int]]:
    """(position after the break, rank): rank 3 paragraph, 2 line, 1 sentence, 0 word."""
    out = []
    for m in _BREAK.finditer(text):
        s = m.group()
        if "\n" in s:
            rank = 3 if s.count("\n") > 1 else 2
        elif m.start() and text[m.start() - 1] in ".!?…" or s[0] in "。！？\"'”’)]":
            rank = 1
        else:
            rank = 0
        out.append((m.end(), rank))
    return out


def _units(text: str, gaps: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The gaps that part units: sentence ends and better, or every gap where there are none of those."""
    strong = [g for g in gaps if g[1] > 0]
    return strong or gaps


def _cosine(a: Counter, b: Counter) -> float:
    if len(a) > len(b):
        a, b = b, a
    dot = sum(n * b[w] for w, n in a.items())
    if not dot:
        return 0.0
    return dot / (sum(n * n for n in a.values()) * sum(n * n for n in b.values())) ** 0.5


def valley_depths(text: str, gaps: list[tuple[int, int]]) -> list[float]:
    """Depth of the similarity valley at each gap, 0 where the curve has no valley."""
    edges = [0, *(p for p, _ in gaps), len(text)]
    words = [Counter(w.lower() for w in _WORD.findall(text[a:b])) for a, b in zip(edges, edges[1:], strict=False)]
    before, after = Counter(), Counter()
    for w in words[1 : 1 + BLOCK]:
        after.update(w)
    sims = []
    for i in range(len(gaps)):  # gap i lies between unit i and unit i + 1
        before.update(words[i])
        if i >= BLOCK:
            before.subtract(words[i - BLOCK])
            before = +before
        if i:
            after.subtract(words[i])
            after = +after
            if i + BLOCK < len(words):
                after.update(words[i + BLOCK])
        sims.append(_cosine(before, after))
    n = len(sims)
    left, right = [0.0] * n, [0.0] * n
    for i in range(n):
        left[i] = max(sims[i], left[i - 1]) if i and sims[i - 1] >= sims[i] else sims[i]
    for i in reversed(range(n)):
        right[i] = max(sims[i], right[i + 1]) if i + 1 < n and sims[i + 1] >= sims[i] else sims[i]
    return [min(left[i], right[i]) - sims[i] for i in range(n)]


def _joined(text: str, at: int) -> bool:
    """Whether the sign at a position belongs to the one before: combining marks, joiners, selectors, skin tones, and the
    second of two regional signs."""
    c, before = text[at], text[at - 1]
    if unicodedata.combining(c) or unicodedata.category(c) in ("Mn", "Me") or c in "\u200c\u200d" or before == "\u200d" or "\U0001f3fb" <= c <= "\U0001f3ff" or "\U000e0020" <= c <= "\U000e007f":
        return True
    if not "\U0001f1e6" <= c <= "\U0001f1ff":
        return False
    n = at
    while n and "\U0001f1e6" <= text[n - 1] <= "\U0001f1ff" and at - n < 64:
        n -= 1
    return (at - n) % 2 == 1


def split_text(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of each piece."""
    if not 0 <= 2 * overlap < limit:
        raise ValueError("the overlap must be less than half the limit")
    n = len(text)
    if n <= limit:
        return [(0, n)]
    gaps = _gaps(text)
    units = _units(text, gaps)
    depth = dict(zip((p for p, _ in units), valley_depths(text, units), strict=True))
    marks = [(p, rank, depth.get(p, -1.0)) for p, rank in gaps]
    out, start, at = [], 0, 0
    while n - start > limit:
        low, high = start + max(limit // 2, overlap + 1), start + limit
        while at < len(marks) and marks[at][0] < low:
            at += 1
        i = j = at
        while j < len(marks) and marks[j][0] <= high:
            j += 1
        if i == j:  # no gap in the second half
            while i and marks[i - 1][0] > start + overlap:
                i -= 1
        best = max(((rank > 0, round(d, 6), rank, p) for p, rank, d in marks[i:j]), default=None)
        end = best[-1] if best else high
        while not best and end > low and _joined(text, end):
            end -= 1
        out.append((start, end))
        start = end - overlap
        while at and marks[at - 1][0] > start:
            at -= 1
    out.append((start, n))
    return out


def split_oversized(df: DataFrame, id_col: str, text_col: str, limit: int, overlap: int) -> DataFrame:
    """(item_id, piece_no, start, end, text) of the items over the limit, one set per id.

    The length filter runs in the JVM, so only oversized texts reach Python. Repeated rows of one id count once.
    """
    rows = df.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text")).filter(F.col("item_id").isNotNull() & (F.length("text") > limit)).dropDuplicates(["item_id"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(i, k, s, e, t[s:e]) for i, t in zip(b["item_id"], b["text"], strict=True) for k, (s, e) in enumerate(split_text(t, limit, overlap))]
            yield pd.DataFrame(out, columns=["item_id", "piece_no", "start", "end", "text"])

    return rows.mapInPandas(run, "item_id string, piece_no int, start int, end int, text string")
