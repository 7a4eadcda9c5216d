"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = ("parquet", "csv", "json", "orc")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None,
               **options) -> DataFrame:
    """Read a table; text formats need a schema so that no pass over the data is spent on guessing."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    if fmt in ("csv", "json") and schema is None:
        raise ValueError(f"reading {fmt} needs a schema")
    reader = spark.read.options(**({"header": True} | options if fmt == "csv" else options))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error",
                partition_by: list[str] | None = None, **options) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    writer = df.write.mode(mode).options(**({"header": True} | options if fmt == "csv" else options))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)
