"""Readers, writers and views."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.sources.schemas import SCHEMAS

MOMENT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and fixed columns.

    A value that does not fit its type ends a read of that column. Spark parses only the columns
    that are asked for, and an empty field is NULL whatever the schema says; :func:`land` reads
    all columns once, and the load gate counts the NULLs.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .option("timestampNTZFormat", MOMENT_FORMAT)
        .csv(path)
    )


def land(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write each table with all its columns as Parquet under ``folder`` and read it back.

    A text source is parsed once and in full here, so a value that does not fit ends the job;
    everything after scans Parquet.
    """
    landed = {}
    for name, df in tables.items():
        write_parquet(df, f"{folder}/{name}")
        landed[name] = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
    return landed


def read_model_csv(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six model tables from ``<folder>/<table>.csv``."""
    return {name: read_csv(spark, f"{folder}/{name}.csv", schema) for name, schema in SCHEMAS.items()}


def read_model_parquet(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema).parquet(f"{folder}/{name}") for name, schema in SCHEMAS.items()}


def flags_as_numbers(df: DataFrame) -> DataFrame:
    """Boolean columns as 0/1, which text readers take without guessing."""
    kinds = {field.name: field.dataType for field in df.schema}
    return df.select(
        *[F.col(n).cast("int").alias(n) if isinstance(k, T.BooleanType) else F.col(n) for n, k in kinds.items()]
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, in the formats that :func:`read_csv` expects."""
    flags_as_numbers(df).write.mode(mode).option("header", True).option("timestampNTZFormat", MOMENT_FORMAT).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] = (), mode: str = "overwrite") -> None:
    """The result format at scale.

    Rows of one partition value are brought together first, so that a job of many tasks does
    not write one small file per task and value. AQE splits a value that is too large.
    """
    keys = list(partition_by)
    if keys:
        spread = df.hint("rebalance", *keys)
        spread.write.mode(mode).partitionBy(*keys).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)
