"""Places and neighbours of rows within groups of any size, without a task that holds a whole group.

Rows are partitioned by ranges of (group, order), so a group with a third of all rows is spread over many tasks; what a
window cannot see across the borders comes from one row per group and partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatlake.runtime import cut


def sort_key(order: list[str]) -> Column:
    """Ascending by the columns, nulls last, as one value that can be compared."""
    return F.struct(*[c for o in order for c in (F.col(o).isNull().alias(f"{o}_null"), F.col(o))])


def placed(df: DataFrame, group: str, order: list[str], following: dict[str, str] | None = None) -> DataFrame:
    """`df` with pos, from 0 in each group by `order` (nulls last), with `is_last`, and with the next row's values of the
    columns that `following` names (new column: column). Rows of a null group have null places and are never last.

    `df` should be narrow: it is written once.
    """
    following = following or {}
    by = [F.asc_nulls_last(o) for o in order]
    rows = cut(df.filter(F.col(group).isNotNull()).repartitionByRange(F.col(group), *by).withColumn("_part", F.spark_partition_id()), "ranged")
    value = F.struct(F.lit(1).alias("_x"), *[F.col(c).alias(n) for n, c in following.items()])
    edges = rows.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.min_by(value, sort_key(order)).alias("_first"))
    parts = W.partitionBy(group).orderBy("_part")  # a row per partition that the group is in
    edges = edges.select(group, "_part", F.coalesce(F.sum("_n").over(parts.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead("_first").over(parts).alias("_after"))
    here = W.partitionBy("_part", group).orderBy(*by)
    marked = rows.withColumns({"_i": F.row_number().over(here), "_next": F.lead(value).over(here)}).join(edges, [group, "_part"])
    nxt = F.coalesce("_next", "_after")
    new = {"pos": (F.col("_before") + F.col("_i") - 1).cast("int"), "is_last": nxt.isNull(), **{n: nxt[n] for n in following}}
    out = marked.select(*df.columns, *[c.alias(n) for n, c in new.items()])
    none = df.filter(F.col(group).isNull()).select("*", *[(F.lit(False) if n == "is_last" else F.lit(None).cast(out.schema[n].dataType)).alias(n) for n in new])
    return out.unionByName(none)
