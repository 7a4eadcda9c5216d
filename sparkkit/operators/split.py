"""Validation splits that do not depend on row order or partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import HOT_GROUP_ROWS, match, with_position


def uniform(*parts) -> Column:
    """Number in [0, 1) that depends on the given values only."""
    text = F.concat_ws("|", *[F.col(p).cast("string") if isinstance(p, str) else F.lit(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 4294967296.0


def holdout_split(df: DataFrame, key: str, test_size: float = 0.33, seed: int = 42, out: str = "is_test") -> DataFrame:
    return df.withColumn(out, uniform(key, seed) < test_size)


def kfold(df: DataFrame, key: str, k: int, label: str | None = None, seed: int = 42, out: str = "fold",
          hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """Fold 0..k-1: the same share of each class per fold, or contiguous runs by key without a label."""
    if k < 2:
        raise ValueError("k must be at least 2")
    if label is not None:
        rows = with_position(df.withColumn("__u", uniform(key, seed)), [label], ["__u", key], "__p", hot)
        return rows.withColumn(out, F.col("__p") % k).drop("__u", "__p")
    n = df.count()
    size, longer = divmod(n, k)
    rows = with_position(df, [], [key], "__p", hot)
    border = longer * (size + 1)
    fold = F.when(F.col("__p") < border, F.floor(F.col("__p") / (size + 1))).otherwise(
        longer + F.floor((F.col("__p") - border) / max(size, 1)))
    return rows.withColumn(out, fold.cast("long")).drop("__p")


def time_series_split(df: DataFrame, key: str, n_splits: int, max_train_size: int | None = None,
                      hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """Row copies with `fold` and `role` (train/test): each fold tests the block after its training rows."""
    n = df.count()
    size = n // (n_splits + 1)
    if size == 0:
        raise ValueError("too few rows for that many splits")
    rows = with_position(df, [], [key], "__p", hot)
    folds = []
    for f in range(n_splits):
        start = n - (n_splits - f) * size
        first = 0 if max_train_size is None else max(start - max_train_size, 0)
        role = F.when((F.col("__p") >= first) & (F.col("__p") < start), "train").when(
            (F.col("__p") >= start) & (F.col("__p") < start + size), "test")
        folds.append(F.struct(F.lit(f).cast("long").alias("fold"), role.alias("role")))
    copies = rows.select("*", F.inline(F.array(*folds)))
    return copies.filter("role is not null").drop("__p")


def split_texts(df: DataFrame, text: str, test: float = 0.3, seed: int = 42) -> DataFrame:
    """Hold out whole texts: all rows of a text fall on the same side."""
    return df.withColumn("subset", F.when(uniform(text, seed) < test, "test").otherwise("train"))


def shuffled_column(df: DataFrame, key: str, col: str, seed, out: str) -> DataFrame:
    """Permutation of a column: rows and values are numbered in two orders of the whole table."""
    rows = with_position(df, [], [key], "__i")
    values = with_position(df.select(F.col(col).alias(out), uniform(key, seed).alias("__u"), F.col(key).alias("__k")), [], ["__u", "__k"], "__i")
    return match(rows, values.select("__i", out), ["__i"]).drop("__i")


def profile_features(df: DataFrame, spec: Sequence, model_name: str = "model") -> DataFrame:
    """Feature definitions checked against the data: one row per feature with counts of nulls, of
    values that do not parse as the declared type, and of distinct values (exact, via one distinct)."""
    from ..functions.parse import parse_int, parse_number
    from ..functions.spec import check_spec

    check_spec(spec)
    types = dict(df.dtypes)
    readers = {"int": parse_int, "float": parse_number, "bool": lambda c: F.lower(F.col(c)).try_cast("boolean"),
               "str": lambda c: F.col(c)}

    def failed(f):
        if types[f.name] != "string":
            return F.lit(0)
        return F.when(F.col(f.name).isNotNull() & readers[f.dtype](f.name).isNull(), 1).otherwise(0)

    rows = F.array(*[
        F.struct(F.lit(i).cast("long").alias("sort_order"), F.lit(f.name).alias("feature"), F.lit(f.role).alias("var_type"),
                 F.lit(f.dtype).alias("data_type"), F.lit(f.strategy).alias("strategy"),
                 F.lit(",".join(f"{k}={v}" for k, v in sorted(f.args.items()))).alias("strategy_args"),
                 F.col(f.name).cast("string").alias("v"), failed(f).alias("bad"))
        for i, f in enumerate(spec)])
    # equal values collapse on the map side, the exact distinct count is then a plain count
    values = df.select(F.inline(rows)).groupBy(
        "sort_order", "feature", "var_type", "data_type", "strategy", "strategy_args", "v").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    return values.groupBy("sort_order", "feature", "var_type", "data_type", "strategy", "strategy_args").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0).cast("long")).alias("nulls"),
        F.sum("bad").alias("cast_failures"), F.count("v").alias("distinct_values"),
    ).withColumn("model_name", F.lit(model_name))
