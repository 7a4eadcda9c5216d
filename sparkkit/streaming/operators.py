"""Streaming forms of the operators: scoring, entities, windowed statistics, incremental fits, drift."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import entities
from ..operators.linear import LinearModel, Moments, ridge
from ..plans.gram import gram


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.format(fmt).load(path)


def write_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", mode: str = "append") -> StreamingQuery:
    """Append rows to files; the checkpoint folder makes restarts exactly-once."""
    return df.writeStream.outputMode(mode).format(fmt).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def score_stream(df: DataFrame, predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stateless: predictions on arriving rows, the same plan as in batch."""
    return predict(df)


def extract_stream(df: DataFrame, key: str, text: str, patterns: dict | None = None) -> DataFrame:
    """Stateless entity extraction; only row-wise steps are used."""
    return entities.pattern_entities(df, key, text, patterns)


def windowed_stats(df: DataFrame, ts: str, x: str, y: str, length: str, lateness: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by..., start, end, n, correlation, mean_squared_error, mean_absolute_error) per time window.

    Only sums are kept as state; rows later than `lateness` are dropped.  Works on streams and tables.
    """
    rows = df.withWatermark(ts, lateness) if lateness else df
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    stats = rows.filter(both).groupBy(F.window(ts, length), *by).agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop(a, b).alias("__c"), F.stddev_pop(a).alias("__a"), F.stddev_pop(b).alias("__b"),
        F.avg((a - b) * (a - b)).alias("mean_squared_error"), F.avg(F.abs(a - b)).alias("mean_absolute_error"))
    return stats.select(*by, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n",
                        F.try_divide(F.col("__c"), F.col("__a") * F.col("__b")).alias("correlation"), "mean_squared_error", "mean_absolute_error")


def session_stats(df: DataFrame, ts: str, value: str, gap: str, by: Sequence[str], lateness: str | None = None) -> DataFrame:
    """(by..., start, end, n, total, mean) per session: rows of a key that follow one another within `gap`.

    The state is one row of sums per open session; a row that falls between two sessions merges them.  On a stream, rows later than
    `lateness` are dropped and a session is returned once the watermark has passed its end, so the output mode is append.
    """
    rows = df.withWatermark(ts, lateness) if lateness else df
    v = F.col(value).cast("double")
    stats = rows.filter(F.col(ts).isNotNull()).groupBy(F.session_window(ts, gap), *by).agg(F.count(F.lit(1)).alias("n"), F.sum(v).alias("total"), F.avg(v).alias("mean"))
    return stats.select(*by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n", "total", "mean")


def write_updates(df: DataFrame, folder: str, checkpoint: str):
    """Run an aggregating stream; a batch stores the rows it changed under its number, so a repeated batch replaces its own."""

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    return df.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last stored state of every key, also of windows that the watermark has not closed."""
    rest = [c for c in updates.columns if c not in {*keys, "batch"}]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("__last")).select(*keys, "__last.*")


def training_statistics(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[a for f in features for a in (F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}"))]).first()
    return {f: (row[f"m_{f}"], row[f"s_{f}"]) for f in features}


def drift(df: DataFrame, ts: str, reference: dict[str, tuple[float, float]], length: str, slide: str | None = None, lateness: str | None = None) -> DataFrame:
    """(start, feature, n, mean, std, shift): moving statistics against those of the training rows;
    `shift` is the distance of the means in training deviations."""
    rows = df.withWatermark(ts, lateness) if lateness else df
    spans = F.window(ts, length, slide) if slide else F.window(ts, length)
    long = rows.select(F.col(ts), F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"), F.lit(float(m)).alias("__m"), F.lit(float(s)).alias("__s"))
        for f, (m, s) in reference.items()])))
    stats = long.groupBy(spans, "feature", "__m", "__s").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    return stats.select(F.col("window.start").alias("start"), "feature", "n", "mean", "std", F.try_divide(F.col("mean") - F.col("__m"), F.col("__s")).alias("shift"))


class PartialFit:
    """Incremental linear model: the sums of every micro-batch are appended to a state folder under
    the batch number, so a batch that is delivered again replaces itself."""

    def __init__(self, spark: SparkSession, state: str, features: Sequence[str], target: str):
        self.spark, self.state, self.features, self.target = spark, state, list(features), target

    def update(self, batch: DataFrame, batch_id: int) -> None:
        gram(batch, [*self.features, self.target]).coalesce(1).write.mode("overwrite").parquet(f"{self.state}/batch={batch_id}")

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        query = stream.writeStream.foreachBatch(self.update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()

    def model(self, alpha: float = 0.0) -> LinearModel:
        """The model of everything seen so far, from the summed state."""
        parts = self.spark.read.parquet(self.state)
        cells = parts.select("n", F.posexplode("g").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect()
        p = len(self.features)
        g = np.zeros((p + 2) ** 2)
        for r in cells:
            g[r["at"]] = r["v"]
        m = Moments.of(cells[0]["n"], g.reshape(p + 2, p + 2), p)
        w = ridge(m, alpha)
        return LinearModel(self.features, [self.target], w, m.y_mean - m.x_mean @ w, {})


class PartialClassCounts:
    """Incremental class counts and sums for naive Bayes and constant models."""

    def __init__(self, spark: SparkSession, state: str, features: Sequence[str], label: str):
        self.spark, self.state, self.features, self.label = spark, state, list(features), label

    def update(self, batch: DataFrame, batch_id: int) -> None:
        x = [F.col(f).cast("double") for f in self.features]
        sums = [a for f, c in zip(self.features, x) for a in (F.sum(c).alias(f"s_{f}"), F.sum(c * c).alias(f"q_{f}"))]
        batch.groupBy(F.col(self.label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"), *sums).write.mode("overwrite").parquet(f"{self.state}/batch={batch_id}")

    def table(self) -> DataFrame:
        """(label, n, mean and population variance per feature) of everything seen so far."""
        total = self.spark.read.parquet(self.state).groupBy("label").agg(
            F.sum("n").alias("n"), *[F.sum(f"{k}_{f}").alias(f"{k}_{f}") for f in self.features for k in "sq"])
        cols: list[Column] = []
        for f in self.features:
            mean = F.col(f"s_{f}") / F.col("n")
            cols += [mean.alias(f"mean_{f}"), (F.col(f"q_{f}") / F.col("n") - mean * mean).alias(f"var_{f}")]
        return total.select("label", "n", *cols)
