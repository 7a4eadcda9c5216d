"""Scratch tables, row numbers and word patterns shared by the operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.durable import scratch_folder

# white space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and return the written table.

    It cuts the lineage, so a lost executor costs at most the current job, and lets Spark delete the shuffle
    files of the finished job at once.
    """
    spark = df.sparkSession
    path = scratch_folder(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small(batches, rows: int = 1_000):
    """The same rows in batches of at most `rows`, so that a task holds few texts as Python objects at a time."""
    for b in batches:
        for start in range(0, b.num_rows, rows):
            yield b.slice(start, rows)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until no column of `df` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(df: DataFrame, key: str) -> DataFrame:
    """Add `part`, `idx` (unique together) and `pos`: the row's number among all rows of equal integer `key`, from 0.

    Tasks count their own rows; only the counts per (task, key) meet, so a key with any share of the rows
    stays spread over the tasks.  The rows are stored once, so the numbers are the same in every later read.
    """
    from pyspark import TaskContext

    names = df.columns

    def count(batches):
        import numpy as np

        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            k = b.column(names.index(key)).to_numpy(zero_copy_only=False)
            idx = np.empty(len(k), np.int64)
            order = np.argsort(k, kind="stable")
            values, first, n = np.unique(k[order], return_index=True, return_counts=True)
            for v, f, m in zip(values.tolist(), first.tolist(), n.tolist()):
                at = seen.get(v, 0)
                idx[order[f : f + m]] = np.arange(at, at + m)
                seen[v] = at + m
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(k), part, np.int32)), pa.array(idx)], names=[*names, "part", "idx"])

    rows = store(df.mapInArrow(count, ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", part int, idx long"))
    sums = rows.groupBy("part", F.col(key).alias("__k")).count()
    before = Window.partitionBy("__k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("part").alias("__p"), "__k", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__off"))
    joined = rows.join(offsets, (F.col("part") == F.col("__p")) & (F.col(key) == F.col("__k")))
    return joined.select(*rows.columns, (F.col("__off") + F.col("idx")).alias("pos"))


def unit(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) from the MD5 of a seed and columns; SQL engines give the same one."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
