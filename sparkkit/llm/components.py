"""Buckets of candidates and connected components of links, both safe under hot keys."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b): root is the smallest node of its component.

    Large-star and small-star steps: every node's neighbours move to its smallest neighbour until all links
    lead from a node to its root.  Minima are pre-aggregated, and every step is stored in the shared folder.
    """
    links = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(least, F.col("a") == F.col("u")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = store(small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        now = _state(links)
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def in_buckets(rows: DataFrame, item: str, chunk: int, need: str | None = None, payload: DataFrame | None = None) -> DataFrame:
    """Rows of buckets with at least two rows, partitioned and sorted by (bucket, i, j).

    `bucket` is a long.  A bucket of more than `chunk` rows is dealt into chunks by the hash of `item`; the task of
    (i, j) gets chunks i and j, so any two rows meet, no task holds more than about two chunks, and column `c` says which
    chunk a row is from.  Pairs of rows are never materialised.  With `need`, buckets where that boolean column is nowhere true
    are left out.  Columns of `payload` (one row per `item`) are joined to what is left.
    """
    wanted = F.max(need) if need else F.lit(True)
    # stored, so that both sides of the join are plain exchanges and a hot bucket's partition can be split
    sizes = store(rows.groupBy(F.col("bucket").alias("__b")).agg(F.count(F.lit(1)).alias("__n"), wanted.alias("__need")).filter("__n > 1 and __need"))
    full = rows.join(sizes, F.col("bucket") == F.col("__b"))
    chunks = F.ceil(F.col("__n") / F.lit(chunk)).cast("int")
    full = full.withColumn("__chunks", chunks).withColumn("c", F.pmod(F.xxhash64(item), F.col("__chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1))
    dealt = full.withColumn("__o", other).select(*rows.columns, "c", F.least("c", "__o").alias("i"), F.greatest("c", "__o").alias("j"))
    if payload is not None:
        dealt = dealt.join(payload, item)
    return dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def whole_groups(batches, keys: list[str]):
    """Tables that hold only whole runs of equal `keys` from sorted batches; memory is that of a run and a batch."""
    pending: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        ks = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        same = ks[0] == ks[0][-1]
        for k in ks[1:]:
            same &= k == k[-1]
        # the first row of the last run
        start = 0 if same.all() else len(same) - int(same[::-1].argmin())
        first, end = tuple(k[0].item() for k in ks), tuple(k[-1].item() for k in ks)
        if pending and (start or first != last):
            yield pa.Table.from_batches([*pending, b.slice(0, start)] if start else pending)
            pending = [b.slice(start)]
        elif start:
            yield pa.Table.from_batches([b.slice(0, start)])
            pending = [b.slice(start)]
        else:
            pending.append(b)
        last = end
    if pending:
        yield pa.Table.from_batches(pending)


def runs(*keys):
    """Start and end of every run of equal rows in numpy columns."""
    import numpy as np

    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    return zip(starts.tolist(), [*starts[1:].tolist(), len(new)])
