"""Joins, reshaping and the table recipes that prepare inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import largest_group, match, running_sum, with_position

MAX_PIVOT_VALUES = 10_000


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a dictionary table to rows.  Adaptive execution broadcasts it when its size allows."""
    return df.join(table, list(on), how)


def band_counts(df: DataFrame, other: DataFrame, on: Sequence[str], at: str, before: float, out: str = "n") -> DataFrame:
    """For each row of `df`: how many rows of `other` share its key and lie in [at - before, at].

    The window edges are put among the points and one running count is read off at both edges,
    so no pair of rows is ever made, however many points fall into a window.
    """
    both = df.select(*on, F.col(at).alias("__at")).distinct()
    marks = both.select(*on, "__at", F.explode(F.array(
        F.struct(F.col("__at").alias("edge"), F.lit(1).alias("sign")),
        F.struct((F.col("__at") - before).alias("edge"), F.lit(-1).alias("sign")),
    )).alias("m")).select(*on, "__at", F.col("m.edge").alias("edge"), F.col("m.sign").alias("sign"))
    # one ordered list per key: points before a closing edge and not before an opening edge
    points = other.groupBy(*on, F.col(at).alias("edge")).agg(F.count(F.lit(1)).alias("w"))
    events = points.select(*on, "edge", F.lit(1).alias("kind"), "w", F.lit(None).cast(both.schema["__at"].dataType).alias("__at")).unionByName(
        marks.select(*on, "edge", F.when(F.col("sign") == 1, 2).otherwise(0).alias("kind"), F.lit(0).cast("long").alias("w"), "__at"))
    upto = running_sum(events, list(on), ["edge", "kind", "__at"], {"__upto": F.col("w")})
    sums = upto.filter("kind <> 1").groupBy(*on, "__at").agg(
        F.sum(F.when(F.col("kind") == 2, F.col("__upto")).otherwise(-F.col("__upto"))).alias(out))
    return match(df.withColumn("__at", F.col(at)), sums, [*on, "__at"], "left").drop("__at")


def pivot(df: DataFrame, key: str, dim: str, value: str, values: Sequence | None = None) -> DataFrame:
    """(key, dim, value) rows -> one column per dim value; a repeated (key, dim) is an error."""
    if values is None:
        found = df.select(dim).filter(F.col(dim).isNotNull()).distinct().limit(MAX_PIVOT_VALUES + 1).collect()
        if len(found) > MAX_PIVOT_VALUES:
            raise ValueError(f"more than {MAX_PIVOT_VALUES} columns")
        values = sorted(r[0] for r in found)
    # (key, dim) first: the duplicate check and the pivot share this aggregation
    once = df.groupBy(key, dim).agg(F.first(value, ignorenulls=True).alias(value), F.count(F.lit(1)).alias("__n"))
    checked = once.withColumn(value, F.when(F.col("__n") == 1, F.col(value)).otherwise(
        F.raise_error(F.lit(f"several rows for one ({key}, {dim})")).cast(df.schema[value].dataType)))
    return checked.groupBy(key).pivot(dim, list(values)).agg(F.first(value, ignorenulls=True))


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def concat_series(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str | Column, sep: str = ";",
                  part_rows: int = 200_000) -> DataFrame:
    """One string per group in order.  A group with more than `part_rows` rows comes in several
    numbered parts, so that no string outgrows a task."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    if largest_group(df, by) <= part_rows:
        rows = df.withColumn("part", F.lit(0).cast("long"))
    else:
        rows = with_position(df, by, order, "__pos", part_rows).withColumn("part", F.floor(F.col("__pos") / part_rows))
    items = F.sort_array(F.collect_list(F.struct(*order, F.coalesce(text, F.lit("")).alias("__text"))))
    return rows.groupBy(*by, "part").agg(
        F.array_join(F.transform(items, lambda x: x["__text"]), sep).alias("series"))


def calendar(df: DataFrame, date: str, horizon: int, generic: str = "<ALL>") -> DataFrame:
    """Every day from the first date to `horizon` days past the last one, flagged Historic/Future,
    once under the generic key and once under its own date."""
    d = F.col(date).cast("date")
    span = df.agg(F.min(d).alias("first"), F.max(d).alias("last"))
    days = span.select("last", F.explode(F.sequence("first", F.date_add("last", horizon))).alias("date"))
    fields = days.select(
        "date",
        F.weekofyear("date").alias("week"), F.month("date").alias("month"), F.year("date").alias("year"),
        F.when(F.col("date") <= F.col("last"), "Historic").otherwise("Future").alias("date_type"),
    )
    return fields.select("*", F.explode(F.array(F.lit(generic), F.col("date").cast("string"))).alias("key"))


def calendar_links(df: DataFrame, date: str, generic: str = "<ALL>") -> DataFrame:
    """Each date linked to itself (Actual) and to the generic key (Generic)."""
    dates = df.select(F.col(date).cast("date").alias("date")).filter("date is not null").distinct()
    links = F.array(
        F.struct(F.lit("Actual").alias("link_type"), F.col("date").cast("string").alias("key")),
        F.struct(F.lit("Generic").alias("link_type"), F.lit(generic).alias("key")),
    )
    return dates.select("date", F.inline(links))


def same_day_count(df: DataFrame, by: Sequence[str], id_col: str, out: str = "same_day") -> DataFrame:
    """Distinct ids per group; duplicates go first, so a hot group only adds up partial counts."""
    return df.select(*by, id_col).distinct().groupBy(*by).agg(F.count(id_col).alias(out))


def bounding_boxes(df: DataFrame, label: str, lat: str, long: str, noise=-1) -> DataFrame:
    """Closed ring around each cluster, as a coordinate string; noise is left out."""
    box = df.filter(F.col(label) != F.lit(noise)).groupBy(label).agg(
        F.min(long).alias("left"), F.max(lat).alias("top"), F.max(long).alias("right"), F.min(lat).alias("bottom"))

    def corner(x, y):
        return F.concat(F.lit("["), F.col(x).cast("string"), F.lit(","), F.col(y).cast("string"), F.lit("]"))

    ring = F.concat_ws(",", corner("left", "top"), corner("right", "top"), corner("right", "bottom"),
                       corner("left", "bottom"), corner("left", "top"))
    return box.select(label, F.concat(F.lit("[[["), ring, F.lit("]]]")).alias("polygon"))


def label_grid(labels: DataFrame, col: str) -> DataFrame:
    """Every (true_label, pred_label) combination of the known labels.

    The grid is the result itself; it is generated from one array of labels, whose length is checked.
    """
    found = labels.select(F.col(col).cast("string")).filter(F.col(col).isNotNull()).distinct()
    values = sorted(r[0] for r in found.limit(MAX_PIVOT_VALUES + 1).collect())
    if len(values) > MAX_PIVOT_VALUES:
        raise ValueError(f"more than {MAX_PIVOT_VALUES} labels")
    spark = labels.sparkSession
    rows = spark.createDataFrame([(v,) for v in values], "true_label string")
    return rows.select("true_label", F.explode(F.array(*[F.lit(v) for v in values])).alias("pred_label"))


def groups_larger_than(df: DataFrame, by: Sequence[str], rows: int) -> DataFrame:
    """Rows of the groups that have more than `rows` rows."""
    big = df.groupBy(*by).count().filter(F.col("count") > rows).select(*by)
    return df.join(big, list(by), "left_semi")
