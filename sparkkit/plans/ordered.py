"""Ordered computations (positions, running sums, bounded frames, average ranks) that do not
put a whole group into one task.

A Spark window sorts each window partition in a single task.  That is the best plan while every
group is small, so the size of the largest group is measured first.  Beyond `HOT_GROUP_ROWS` the
rows are range-partitioned on (group, order) instead: every block is then small whatever the skew,
and only per-block totals are combined per group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .durable import durable

HOT_GROUP_ROWS = 2_000_000


def largest_group(df: DataFrame, by: Sequence[str]) -> int:
    """Rows in the largest group (a partial aggregation, safe under any skew)."""
    if not by:
        return df.count()
    return df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


# name of the constant key of an ungrouped computation
ALL = "__all"


def _attach(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Add the single row of an ungrouped aggregation as literals, so that no cross join is planned."""
    found = right.limit(2).collect()
    if len(found) > 1:
        raise ValueError("an ungrouped table has one row")
    fields = [f for f in right.schema.fields if f.name != ALL]
    if not found:
        missing = left.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
        return missing if how == "left" else missing.filter(F.lit(False))
    return left.select("*", *[F.lit(found[0][f.name]).cast(f.dataType).alias(f.name) for f in fields])


def match(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; the key columns appear once."""
    if not on:
        raise ValueError("match needs at least one key column")
    if list(on) == [ALL]:
        return _attach(left, right, how)
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = None
    for c in on:
        test = left[c].eqNullSafe(renamed[f"__r_{c}"])
        cond = test if cond is None else cond & test
    return left.join(renamed, cond, how).drop(*[f"__r_{c}" for c in on])


def _blocks(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Range-partition on (group, order) and store the block number with the rows.

    The rows are checkpointed because range bounds come from a sample: a recomputed partition
    must not see other bounds than the block totals did.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in [*by, *order]]
    return durable(df.repartitionByRange(n, *keys).withColumn("__block", F.spark_partition_id()))


def _with_offsets(blocks: DataFrame, by: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """Add, per row, the totals of all earlier blocks of the row's group as `__off_<name>`."""
    sizes = blocks.groupBy(*by, "__block").agg(*[c.alias(f"__sum_{k}") for k, c in totals.items()])
    # one row per (group, block): a group has at most as many blocks as there are partitions
    earlier = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *by, "__block", *[F.coalesce(F.sum(f"__sum_{k}").over(earlier), F.lit(0)).alias(f"__off_{k}") for k in totals]
    )
    return match(blocks, offsets, [*by, "__block"])


def with_position(
    df: DataFrame, by: Sequence[str], order: Sequence[str], out: str = "position", hot: int = HOT_GROUP_ROWS
) -> DataFrame:
    """0-based dense position inside each group; `order` must be unique inside the group."""
    if largest_group(df, by) <= hot:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn(out, F.row_number().over(w).cast("long") - 1)
    rows = _with_offsets(_blocks(df, by, order), by, {"n": F.count(F.lit(1))})
    inside = Window.partitionBy(*by, "__block").orderBy(*order)
    return rows.withColumn(out, F.col("__off_n") + F.row_number().over(inside) - 1).drop("__block", "__off_n")


def running_sum(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    hot: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Inclusive running sums, null until the first value; `order` must be unique inside the group."""
    if largest_group(df, by) <= hot:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(w).alias(k) for k, c in sums.items()])
    totals = {k: F.sum(c) for k, c in sums.items()} | {f"{k}__known": F.count(c) for k, c in sums.items()}
    rows = _with_offsets(_blocks(df, by, order), by, totals)
    inside = Window.partitionBy(*by, "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    known = {k: F.count(c).over(inside) + F.col(f"__off_{k}__known") for k, c in sums.items()}
    added = [F.when(known[k] > 0, F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"__off_{k}")).alias(k) for k, c in sums.items()]
    return rows.select(*df.columns, *added)


def bounded_frame(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    before: int,
    after: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    hot: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Window columns that look at most `before` rows back and `after` rows ahead.

    Large groups are cut into chunks of positions; the rows next to a border are copied into the
    neighbouring chunk, so every chunk can be computed alone.
    """
    if largest_group(df, by) <= hot:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.select("*", *[c.alias(k) for k, c in columns(w).items()])
    size = max(hot, 4 * (before + after), 1)
    rows = with_position(df, by, order, "__pos", hot)
    chunk = F.floor(F.col("__pos") / size)
    inside = F.col("__pos") % size
    homes = F.array_compact(
        F.array(
            F.struct(chunk.alias("c"), F.lit(True).alias("home")),
            F.when(inside >= size - before, F.struct((chunk + 1).alias("c"), F.lit(False).alias("home"))),
            F.when((inside < after) & (chunk > 0), F.struct((chunk - 1).alias("c"), F.lit(False).alias("home"))),
        )
    )
    copied = rows.select("*", F.inline(homes).alias("__chunk", "__home"))
    w = Window.partitionBy(*by, "__chunk").orderBy("__pos")
    done = copied.select("*", *[c.alias(k) for k, c in columns(w).items()]).filter("__home")
    return done.drop("__pos", "__chunk", "__home")


def average_rank(
    df: DataFrame, by: Sequence[str], value: str, out: str = "rank", hot: int = HOT_GROUP_ROWS
) -> DataFrame:
    """1-based rank of `value` inside each group; ties share their average rank, null stays null."""
    if largest_group(df, by) <= hot:
        w = Window.partitionBy(*by).orderBy(F.col(value).asc_nulls_last())
        ties = F.count(F.lit(1)).over(Window.partitionBy(*by, value))
        return df.withColumn(out, F.when(F.col(value).isNotNull(), F.rank().over(w) + (ties - 1) / F.lit(2.0)))
    # tied rows collapse to one row per distinct value before any ordering takes place
    freq = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    upto = running_sum(freq, by, [value], {"__upto": F.col("__n")}, hot)
    ranks = upto.select(*by, value, (F.col("__upto") - (F.col("__n") - 1) / F.lit(2.0)).alias(out))
    return match(df, ranks, [*by, value], "left")
