"""Session settings, table access and lineage cuts shared by all operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "chatlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE and Arrow on; `conf` keys use `__` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in {**base, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for lineage cuts.

    It is the one the cluster names in `spark.checkpoint.dir`. Only where that is unset, as in local tests, one is made
    in the system's temporary folder; on a cluster master that would not be shared, so there it is refused.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="chatlake-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def cut(df: DataFrame, label: str = "t") -> DataFrame:
    """Write `df` to the shared folder and read it again, so later plans neither recompute it nor depend on an executor."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)  # gone with the application
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame, condition: Column, label: str = "t") -> tuple[DataFrame, int]:
    """The same, and how many rows meet `condition`, counted while they are written."""
    seen = Observation()
    out = cut(df.observe(seen, F.count_if(condition).alias("n")), label)
    return out, seen.get["n"] or 0
