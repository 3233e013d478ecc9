"""Relational tables as bounded sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_by: str,
    lower: str,
    upper: str,
    partitions: int,
    **properties: str,
) -> DataFrame:
    """A database table read in ``partitions`` ranges of a numeric, date or time column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=split_by, lowerBound=lower,
                 upperBound=upper, numPartitions=partitions, **properties)
        .load()
    )
