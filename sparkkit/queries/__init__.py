"""Registry of the queries the driver runs: name -> (operator id, function, oracle SQL)."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Query(NamedTuple):
    operator: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}

FAMILIES = ("expressions", "relational", "sequence", "rules_correlation", "encoders", "learning",
            "forecasting", "clustering", "text", "scoring", "streams")


class Tables:
    """`t.orders` reads the orders table of a scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        from ..sources.tables import read_table

        return read_table(self.spark, f"{self.folder}/{name}.parquet")


def query(operator: str, sql: str | None = None):
    """Register a function `f(t: Tables) -> DataFrame` under its own name."""

    def add(f):
        @functools.wraps(f)
        def run(spark, folder):
            return f(Tables(spark, folder))

        if f.__name__ in REGISTRY:
            raise ValueError(f"duplicate query {f.__name__}")
        REGISTRY[f.__name__] = Query(operator, run, sql)
        return f

    return add


def load() -> dict[str, Query]:
    for family in FAMILIES:
        importlib.import_module(f"{__name__}.{family}")
    return REGISTRY
