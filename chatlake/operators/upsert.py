"""Keyed upserts as new snapshots, and the acceptance of newer versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rules for a column when a key is already there.
KEEP, TAKE, GREATEST, LEAST = "keep", "take", "greatest", "least"


def collapse(source: DataFrame, keys: list[str], rules: dict[str, str], ordinal: str, newer: str | None = None) -> DataFrame:
    """One row per key as if the rows had been applied one after the other in the order of `ordinal`.

    Kept columns come from the first row, taken ones from the last; with `newer`, a row is applied only if its value of
    that column is greater than what is stored, so among equal values the first stays.
    """
    aggs = []
    for c, rule in rules.items():
        if rule == KEEP:
            a = F.min_by(c, ordinal)
        elif rule == TAKE:
            a = F.max_by(c, F.struct(F.col(newer), -F.col(ordinal)) if newer else F.col(ordinal))
        else:
            a = F.max(c) if rule == GREATEST else F.min(c)
        aggs.append(a.alias(c))
    return source.groupBy(*keys).agg(*aggs)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], rules: dict[str, str], newer: str | None = None, insert_only: bool = False) -> DataFrame:
    """(*keys, *columns, _action): the merged snapshot, _action being insert, update or skip.

    `source` has one row per key (see `collapse`). `newer` names a column that must be greater in the source for an
    update. Columns that `rules` does not name keep the stored value. One full outer join; no row is visited twice.
    """
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("t_here"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("s_here"))
    cond = [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys]
    j = t.join(s, cond, "full_outer")
    old, new = F.col("t_here").isNotNull(), F.col("s_here").isNotNull()
    fresh = new & ~old
    change: Column = F.lit(False) if insert_only else new & old
    if newer and not insert_only:
        change = change & (F.col(f"s_{newer}") > F.col(f"t_{newer}"))
    out = [F.coalesce(f"t_{k}", f"s_{k}").alias(k) for k in keys]
    for c in [c for c in target.columns if c not in keys]:
        if c not in source.columns:
            out.append(F.col(f"t_{c}").alias(c))
            continue
        tc, sc, rule = F.col(f"t_{c}"), F.col(f"s_{c}"), rules.get(c, KEEP)
        merged = {KEEP: tc, TAKE: sc, GREATEST: F.greatest(tc, sc), LEAST: F.least(tc, sc)}[rule]
        out.append(F.when(fresh, sc).when(change, merged).otherwise(tc).alias(c))
    action = F.when(fresh, "insert").when(change, "update").otherwise("skip")
    return j.select(*out, action.alias("_action"))


def action_counts(merged: DataFrame) -> DataFrame:
    """(action, n)."""
    return merged.groupBy(F.col("_action").alias("action")).agg(F.count("*").alias("n"))


def update_by_key(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """`target` with `columns` replaced where the key is in `source`; no inserts."""
    s = source.select(*keys, *[F.col(c).alias(f"s_{c}") for c in columns], F.lit(True).alias("s_here"))
    j = target.join(s, keys, "left")
    return j.select(*[F.when(F.col("s_here"), F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def accepted_versions(df: DataFrame, key: str, version: str, ordinal: str) -> DataFrame:
    """`df` with accepted: whether a sequential reader would have taken this version.

    It takes one unless the stored and the new version are both known and the stored is not older. A null version is
    taken and makes the stored one unknown, so the greatest known version since the last null decides.
    """
    w = W.partitionBy(key).orderBy(ordinal)
    since = F.count_if(F.col(version).isNull()).over(w.rowsBetween(W.unboundedPreceding, 0))
    marked = df.withColumn("_since", since)
    before = F.max(version).over(W.partitionBy(key, "_since").orderBy(ordinal).rowsBetween(W.unboundedPreceding, -1))
    return marked.withColumn("accepted", F.col(version).isNull() | before.isNull() | (F.col(version) > before)).drop("_since")
