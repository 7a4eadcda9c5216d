"""Evaluation of predictions.  Everything derives from counts or sums, so folds and groups are cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import HOT_GROUP_ROWS, match, with_position
from .relational import label_grid

# fixed value: class name of the row that covers all classes
OVERALL = "overall"
AVERAGES = ("micro", "macro", "weighted")


def _ratio(a: Column, b: Column) -> Column:
    """a / b with zero for a zero denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _class_table(df: DataFrame, y: str, p: str, by: Sequence[str]) -> DataFrame:
    """Per group and class: true positives, predictions and support."""
    counts = df.select(*by, F.col(y).cast("string").alias("y"), F.col(p).cast("string").alias("p")).dropna(
        "any", subset=["y", "p"]).groupBy(*by, "y", "p").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("long")
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(none)
    sides = F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("p").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("tp")),
    )
    return counts.select(*by, F.inline(sides)).groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))


def classifier_metrics(df: DataFrame, y: str, p: str, model_name: str = "model", average: str | None = None,
                       by: Sequence[str] = ()) -> DataFrame:
    """(model_name, class, accuracy, precision, recall, fscore, support): one row per class and an
    `overall` row with the accuracy; with `average`, the overall row only."""
    if average is not None and average not in AVERAGES:
        raise ValueError(f"average must be one of {AVERAGES}")
    by = list(by)
    base = _class_table(df, y, p, by)
    precision, recall = _ratio(F.col("tp"), F.col("predicted")), _ratio(F.col("tp"), F.col("support"))
    table = base.withColumn("precision", precision).withColumn("recall", recall).withColumn(
        "fscore", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    accuracy = _ratio(F.sum("tp"), F.sum("support"))
    null = F.lit(None).cast("double")
    if average is None:
        parts = [null, null, null]
    elif average == "micro":
        parts = [accuracy, accuracy, accuracy]
    elif average == "macro":
        parts = [F.avg(c) for c in ("precision", "recall", "fscore")]
    else:
        parts = [_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")) for c in ("precision", "recall", "fscore")]
    overall = table.groupBy(*by).agg(
        accuracy.alias("accuracy"), *[c.alias(n) for c, n in zip(parts, ("precision", "recall", "fscore"))],
        F.sum("support").alias("support")).withColumn("class", F.lit(OVERALL))
    out = overall
    if average is None:
        out = table.withColumn("accuracy", null).select(*overall.columns).unionByName(overall)
    return out.select(F.lit(model_name).alias("model_name"), *by, "class", "accuracy", "precision", "recall", "fscore", "support")


def group_median(df: DataFrame, by: Sequence[str], value: str, out: str, hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """Exact median per group from positions; no group is collected."""
    rows = df.select(*by, F.col(value).cast("double").alias("__v")).filter("__v is not null")
    placed = with_position(rows, by, ["__v"], "__p", hot)
    if by:
        sized = match(placed, rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")), by)
    else:
        sized = placed.withColumn("__n", F.lit(rows.count()))
    middle = (F.col("__p") == F.floor((F.col("__n") - 1) / 2)) | (F.col("__p") == F.ceil((F.col("__n") - 1) / 2))
    return sized.filter(middle).groupBy(*by).agg(F.avg("__v").alias(out))


REGRESSION = ("r2_score", "mean_squared_error", "mean_absolute_error", "median_absolute_error", "explained_variance_score")


def regressor_metrics(df: DataFrame, y: str, p: str, model_name: str = "model", by: Sequence[str] = ()) -> DataFrame:
    """(model_name, r2_score, mean_squared_error, mean_absolute_error, median_absolute_error,
    explained_variance_score) on the given scale."""
    by = list(by)
    rows = df.select(*by, F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p")).dropna(
        "any", subset=["y", "p"]).withColumn("e", F.col("y") - F.col("p")).withColumn("a", F.abs("e"))
    sums = rows.groupBy(*by).agg(
        F.avg(F.col("e") * F.col("e")).alias("mean_squared_error"), F.avg("a").alias("mean_absolute_error"),
        F.var_pop("e").alias("__ve"), F.var_pop("y").alias("__vy"))
    key = by or ["__all"]
    median = group_median(rows, by, "a", "median_absolute_error")
    if not by:
        sums, median = sums.withColumn("__all", F.lit(0)), median.withColumn("__all", F.lit(0))
    return match(sums, median, key, "left").select(
        F.lit(model_name).alias("model_name"), *by,
        (1 - F.try_divide(F.col("mean_squared_error"), F.col("__vy"))).alias("r2_score"),
        "mean_squared_error", "mean_absolute_error", "median_absolute_error",
        (1 - F.try_divide(F.col("__ve"), F.col("__vy"))).alias("explained_variance_score"))


def _over_folds(metrics: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    spread = [F.stddev_pop(c).alias(f"{c}_std") for c in values]
    return metrics.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in values], *spread)


def cv_classifier_metrics(df: DataFrame, y: str, p: str, fold: str, model_name: str = "model",
                          average: str | None = None) -> DataFrame:
    """Mean and population deviation over folds, per class."""
    per_fold = classifier_metrics(df, y, p, model_name, average, [fold])
    return _over_folds(per_fold, ["model_name", "class"], ["accuracy", "precision", "recall", "fscore"])


def cv_regressor_metrics(df: DataFrame, y: str, p: str, fold: str, model_name: str = "model") -> DataFrame:
    return _over_folds(regressor_metrics(df, y, p, model_name, [fold]), ["model_name"], list(REGRESSION))


def confusion_matrix(df: DataFrame, y: str, p: str, model_name: str = "model") -> DataFrame:
    """(model_name, true_label, pred_label, count) over the full grid of labels."""
    counts = df.select(F.col(y).cast("string").alias("true_label"), F.col(p).cast("string").alias("pred_label")).dropna().groupBy(
        "true_label", "pred_label").agg(F.count(F.lit(1)).alias("__n"))
    labels = counts.select(F.explode(F.array("true_label", "pred_label")).alias("label"))
    grid = label_grid(labels, "label")
    return grid.join(counts, ["true_label", "pred_label"], "left").select(
        F.lit(model_name).alias("model_name"), "true_label", "pred_label",
        F.coalesce("__n", F.lit(0).cast("long")).alias("count"))


def step_confusion(df: DataFrame, steps: dict[str, tuple[str, str]], model_name: str = "model") -> DataFrame:
    """(model_name, step, true_negative, false_positive, false_negative, true_positive) per 0/1 output."""
    rows = [F.struct(F.lit(s).alias("step"), (F.col(y).cast("int") == 1).alias("y"), (F.col(p).cast("int") == 1).alias("p"))
            for s, (y, p) in steps.items()]
    long = df.select(F.inline(F.array(*rows))).dropna()
    count = lambda test: F.count(F.when(test, 1))
    y, p = F.col("y"), F.col("p")
    return long.groupBy("step").agg(
        count(~y & ~p).alias("true_negative"), count(~y & p).alias("false_positive"),
        count(y & ~p).alias("false_negative"), count(y & p).alias("true_positive"),
    ).withColumn("model_name", F.lit(model_name))


def overall_score(df: DataFrame, y: str, p: str, kind: str, model_name: str = "model") -> DataFrame:
    """(model_name, score_result, score): accuracy of a classifier, r2 of a regressor."""
    if kind == "classifier":
        rows = df.select((F.col(y).cast("string") == F.col(p).cast("string")).cast("double").alias("ok")).dropna()
        score, label = rows.agg(F.avg("ok").alias("score")), "accuracy"
    else:
        rows = df.select(F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p")).dropna()
        mse = F.avg((F.col("y") - F.col("p")) * (F.col("y") - F.col("p")))
        score, label = rows.agg((1 - F.try_divide(mse, F.var_pop("y"))).alias("score")), "r2"
    return score.select(F.lit(model_name).alias("model_name"), F.lit(label).alias("score_result"), "score")


def log_loss(y: Column, probability: Column) -> Column:
    """Aggregate: mean negative log-likelihood of 0/1 labels, probabilities kept off 0 and 1."""
    q = F.greatest(F.least(probability.cast("double"), F.lit(1 - 1e-15)), F.lit(1e-15))
    return F.avg(-F.when(y.cast("int") == 1, F.log(q)).otherwise(F.log(1 - q)))


def mean_absolute_error(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y.cast("double") - p.cast("double")))


def f1_score(y: Column, p: Column) -> Column:
    """Aggregate: F1 of the class 1."""
    one, hit = y.cast("int") == 1, p.cast("int") == 1
    tp = F.count(F.when(one & hit, 1))
    return _ratio(2 * tp, F.count(F.when(one, 1)) + F.count(F.when(hit, 1)))


def sequence_metrics(predictions: DataFrame, actuals: DataFrame, keys: Sequence[str], y: str, p: str, kind: str,
                     model_name: str = "model", by: Sequence[str] = ()) -> DataFrame:
    """Walk-forward predictions against actual values; rows without a prediction are left out."""
    rows = predictions.filter(F.col(p).isNotNull()).join(actuals, list(keys))
    if kind == "classifier":
        return classifier_metrics(rows, y, p, model_name, by=by)
    return regressor_metrics(rows, y, p, model_name, by)
