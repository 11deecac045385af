"""Vectors as arrays in double precision; sums of many vectors are folded in Arrow batches, all else stays in the JVM."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Sum of products; null where a vector is null or the widths differ."""
    both = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.when(F.size(a) == F.size(b), F.aggregate(both, F.lit(0.0).cast("double"), lambda acc, x: acc + x))


def parse(text: Column) -> Column:
    """A vector written as text, `[0.1,...]`; bad text is null."""
    return F.from_json(text, "array<double>")


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is null, empty, of another width, or zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(a: Column) -> Column:
    """Divided by its length; a zero vector is kept."""
    n = norm(a)
    return F.transform(a, lambda x: x.cast("double") / F.when(n == 0, F.lit(1.0)).otherwise(n))


#: Sums held by a task before they are passed on, in numbers.
_HELD = 4_000_000


def _folded(df: DataFrame, keys: list[str], vec: str, unit_length: bool) -> DataFrame:
    """(*keys, w, n, total, squares): number, sum and sum of squared lengths of the vectors of width `w`.

    Vectors are added up in Arrow batches within a task, as they are or at unit length, so that one row per task and key
    is shuffled and not one per number; the rows of a key are added up in two steps, so no task gets those of all tasks.
    """
    names = [f"k{i}" for i in range(len(keys))]
    src = df.filter(F.col(vec).isNotNull() & (F.size(vec) > 0)).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(vec).cast("array<double>").alias("v"))
    kinds = ", ".join(f"{n} {src.schema[n].dataType.simpleString()}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0
        types = {n: None for n in names}

        def out() -> pa.RecordBatch:
            cols = [pa.array([k[i] for k in held], t) for i, t in enumerate(types.values())]
            return pa.RecordBatch.from_arrays([*cols, pa.array([k[-1] for k in held], pa.int32()), pa.array([h[0] for h in held.values()], pa.int64()), pa.array([h[1] for h in held.values()], pa.list_(pa.float64())), pa.array([h[2] for h in held.values()], pa.float64())], names=[*names, "w", "n", "total", "squares"])

        for b in batches:
            types = {n: b.schema.field(n).type for n in names}
            lists = b.column(len(names))
            widths = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(widths)])
            keyed = list(zip(*[b.column(i).to_pylist() for i in range(len(names))], strict=True))
            for i, k in enumerate(keyed):
                v = values[at[i] : at[i + 1]]
                if unit_length:
                    length = np.sqrt(v @ v)
                    v = v / length if length > 0 else v
                h = held.get((*k, int(widths[i])))
                if h is None:
                    held[(*k, int(widths[i]))] = [1, v.copy(), float(v @ v)]
                    size += len(v)
                else:
                    h[0] += 1
                    h[1] += v
                    h[2] += float(v @ v)
            if size > _HELD:
                yield out()
                held, size = {}, 0
        if held:
            yield out()

    sums = src.mapInArrow(run, f"{kinds}, w int, n bigint, total array<double>, squares double").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    zero = F.transform(F.sequence(F.lit(1), F.col("w")), lambda _: F.lit(0.0).cast("double"))
    for by in ([*names, "w", "part"], [*names, "w"]):
        sums = sums.groupBy(*by).agg(F.sum("n").alias("n"), F.collect_list("total").alias("all"), F.sum("squares").alias("squares"))
        sums = sums.select(*by, "n", F.aggregate("all", zero, lambda a, x: F.zip_with(a, x, lambda p, q: p + q)).alias("total"), "squares")
    return sums.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "w", "n", "total", "squares")


def mean_vectors(df: DataFrame, key: str | list[str], vec: str) -> DataFrame:
    """(*key, vector): element-wise mean per key; vectors of several widths count as far as they go."""
    keys = [key] if isinstance(key, str) else key
    many = _folded(df, keys, vec, False).groupBy(*keys).agg(F.collect_list(F.struct("w", "n", "total")).alias("l"))  # a row per width
    wide = F.array_max(F.transform("l", lambda e: e["w"]))
    at = lambda i: F.filter("l", lambda e: e["w"] > i)
    total = lambda i: F.aggregate(at(i), F.lit(0.0).cast("double"), lambda a, e: a + F.element_at(e["total"], i + 1))
    count = lambda i: F.aggregate(at(i), F.lit(0).cast("bigint"), lambda a, e: a + e["n"])
    one = F.transform(F.col("l")[0]["total"], lambda x: x / F.col("l")[0]["n"])
    return many.select(*keys, F.when(F.size("l") == 1, one).otherwise(F.transform(F.sequence(F.lit(0), wide - 1), lambda i: total(i) / count(i))).alias("vector"))


def coherence(df: DataFrame, key: str | list[str], vec: str) -> DataFrame:
    """(*key, coherence): mean cosine over all pairs of a key's vectors, of one width; null below two vectors.

    Linear time: over unit vectors u, the sum over pairs is (|sum u|^2 - sum |u|^2) / 2.
    """
    keys = [key] if isinstance(key, str) else key
    n = F.col("n")
    t = _folded(df, keys, vec, True).groupBy(*keys).agg(F.sum(dot(F.col("total"), F.col("total"))).alias("ss"), F.sum("squares").alias("qq"), F.sum("n").alias("n"))
    return t.select(*keys, F.when(n >= 2, (F.col("ss") - F.col("qq")) / (n * (n - 1))).alias("coherence"))
