"""Model registry: one folder per model and one small table that lists them."""

from __future__ import annotations

import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.nulls import glob_match

SCHEMA = ("name string, path string, type string, features array<struct<name:string,type:string>>, "
          "metrics map<string,double>, spec string, saved_at timestamp_ntz")


def _table(spark: SparkSession, root: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_models")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{root}/_models")


def models(spark: SparkSession, root: str, pattern: str = "") -> DataFrame:
    """Newest entry of every model whose name matches the pattern (empty: all)."""
    newest = Window.partitionBy("name").orderBy(F.desc("saved_at"))
    rows = _table(spark, root).filter(glob_match("name", pattern))
    return rows.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")


def save_model(spark: SparkSession, root: str, name: str, model=None, overwrite: bool = False, kind: str = "",
               features: list[tuple[str, str]] = (), metrics: dict[str, float] | None = None, spec: str = "") -> None:
    """Store a model and register it; an existing name needs `overwrite`."""
    if not overwrite and models(spark, root).filter(F.col("name") == name).take(1):
        raise FileExistsError(f"model {name!r} exists")
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    path = f"{root}/{name}/{now:%Y%m%dT%H%M%S%f}"
    if model is not None:
        pipeline = model if isinstance(model, PipelineModel) else PipelineModel([model])
        pipeline.write().overwrite().save(path)
    row = (name, path, kind, [tuple(f) for f in features], dict(metrics or {}), spec, now)
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_models")


def model_entry(spark: SparkSession, root: str, name: str):
    found = models(spark, root).filter(F.col("name") == name).take(1)
    if not found:
        raise FileNotFoundError(f"no model {name!r}")
    return found[0]


def load_model(spark: SparkSession, root: str, name: str) -> PipelineModel:
    return PipelineModel.load(model_entry(spark, root, name)["path"])
