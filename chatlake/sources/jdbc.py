"""Tables of a database as DataFrames and back, where a JDBC driver is on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, key: str | None = None, low: str | None = None, high: str | None = None, parts: int = 8, **options: str) -> DataFrame:
    """A table, read in `parts` ranges of a numeric or date key where its bounds are given; filters are pushed down."""
    r = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize="10000", **options)
    if key and low is not None and high is not None:
        r = r.options(partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=str(parts))
    return r.load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", parts: int = 8, **options: str) -> None:
    """At most `parts` connections; a snapshot replaces the rows and keeps the table's definition."""
    w = df.coalesce(parts).write.format("jdbc").options(url=url, dbtable=table, batchsize="5000", **options)
    (w.option("truncate", "true") if mode == "overwrite" else w).mode(mode).save()
