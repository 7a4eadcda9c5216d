"""Feature importance by shuffling columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import match, with_position
from . import metrics
from .split import uniform


def shuffled_copies(df: DataFrame, key: str, features: Sequence[str], repeats: int, seed: int = 42) -> DataFrame:
    """Rows once per (feature, repeat) with that feature's values permuted, plus `__feature`, `__repeat`.

    A permutation pairs two numberings of all rows, one by the key and one by a number drawn from the key; whatever the number of
    rows, values move over the whole table.
    """
    jobs = F.array(*[F.struct(F.lit(f).alias("__feature"), F.lit(i).alias("__repeat")) for f in features for i in range(repeats)])
    value = F.lit(None).cast("double")
    for f in features:
        value = F.when(F.col("__feature") == f, F.col(f"`{f}`").cast("double")).otherwise(value)
    copies = with_position(df, [], [key], "__i").select("*", F.inline(jobs))
    donors = copies.select("__feature", "__repeat", F.col(key).alias("__k"), value.alias("__value"),
                           uniform(key, "__feature", "__repeat", seed).alias("__u"))
    donors = with_position(donors, ["__feature", "__repeat"], ["__u", "__k"], "__i").select("__feature", "__repeat", "__i", "__value")
    joined = match(copies, donors, ["__feature", "__repeat", "__i"])
    replaced = [F.when(F.col("__feature") == c, F.col("__value")).otherwise(F.col(f"`{c}`").cast("double")).alias(c) if c in set(features) else F.col(f"`{c}`")
                for c in df.columns]
    return joined.select(*replaced, "__feature", "__repeat")


def permutation_importance(df: DataFrame, key: str, features: Sequence[str], y: str, predict: Callable[[DataFrame], DataFrame],
                           score: Callable[[Column, Column], Column], repeats: int = 30, seed: int = 42, model_name: str = "model") -> DataFrame:
    """(model_name, feature_name, importance): mean drop of the score after shuffling a column.

    `score(y, prediction)` is an aggregate, higher is better; all copies are scored in one job.
    """
    base = predict(df).agg(score(F.col(y), F.col("prediction")).alias("s")).first()["s"]
    copies = predict(shuffled_copies(df, key, features, repeats, seed))
    per = copies.groupBy("__feature", "__repeat").agg(score(F.col(y), F.col("prediction")).alias("s"))
    return per.groupBy(F.col("__feature").alias("feature_name")).agg(F.avg(F.lit(float(base)) - F.col("s")).alias("importance")).select(
        F.lit(model_name).alias("model_name"), "feature_name", "importance")


def importance_by_prediction_change(df: DataFrame, key: str, features: Sequence[str], predict: Callable[[DataFrame], DataFrame], repeats: int = 1,
                                    weighted: bool = False, seed: int = 42, model_name: str = "model") -> DataFrame:
    """(model_name, feature_name, importance): mean absolute change of the prediction after shuffling,
    optionally weighted by the size of the change of the feature, summing to one."""
    before = predict(df).select(key, F.col("prediction").cast("double").alias("__before"), *[F.col(f"`{f}`").cast("double").alias(f"__old_{f}") for f in features])
    after = predict(shuffled_copies(df, key, features, repeats, seed))
    rows = after.join(before, key)
    change = F.abs(F.col("prediction").cast("double") - F.col("__before"))
    if weighted:
        spans = df.agg(*[(F.max(f"`{f}`") - F.min(f"`{f}`")).cast("double").alias(f) for f in features]).first()
        moved = F.lit(0.0)
        for f in features:
            span = spans[f] or 1.0
            moved = F.when(F.col("__feature") == f, F.abs(F.col(f"`{f}`") - F.col(f"__old_{f}")) / span).otherwise(moved)
        effect = F.sum(change * moved) / F.greatest(F.sum(moved), F.lit(1e-12))
    else:
        effect = F.avg(change)
    raw = rows.groupBy(F.col("__feature").alias("feature_name")).agg(effect.alias("e"))
    return _normalised(raw, model_name)


def _normalised(raw: DataFrame, model_name: str) -> DataFrame:
    # one row per feature
    whole = raw.agg(F.sum("e")).first()[0] or 0.0
    share = F.col("e") / F.lit(float(whole)) if whole else F.lit(0.0)
    return raw.select(F.lit(model_name).alias("model_name"), "feature_name", share.alias("importance"))


# aggregates in which a higher value is worse; F1 is turned round
SCORERS: dict[str, Callable[[Column, Column], Column]] = {
    "log_loss": metrics.log_loss,
    "mae": metrics.mean_absolute_error,
    "f1": lambda y, p: 1 - metrics.f1_score(y, p),
}


def importance_by_scoring(df: DataFrame, key: str, features: Sequence[str], y: str, predict: Callable[[DataFrame], DataFrame], scorer: str = "mae",
                          repeats: int = 1, seed: int = 42, model_name: str = "model") -> DataFrame:
    """(model_name, feature_name, importance): worsening of a score after shuffling, summing to one."""
    loss = SCORERS[scorer]
    base = predict(df).agg(loss(F.col(y), F.col("prediction")).alias("s")).first()["s"]
    after = predict(shuffled_copies(df, key, features, repeats, seed))
    per = after.groupBy(F.col("__feature").alias("feature_name"), "__repeat").agg(loss(F.col(y), F.col("prediction")).alias("s"))
    raw = per.groupBy("feature_name").agg(F.greatest(F.avg(F.col("s") - F.lit(float(base))), F.lit(0.0)).alias("e"))
    return _normalised(raw, model_name)
