"""Catalog tables: scan, schema, create, replace."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str | DataFrame) -> DataFrame:
    """All columns of a table; a DataFrame is taken as it is."""
    return name if isinstance(name, DataFrame) else spark.table(name)


def table_columns(spark: SparkSession, name: str | DataFrame) -> list[str]:
    return read_table(spark, name).columns


def create_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Write a new table; an existing one is an error."""
    _save(df, name, "errorifexists", path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Write a table, replacing an old one in one step."""
    _save(df, name, "overwrite", path)


def _save(df: DataFrame, name: str, mode: str, path: str | None) -> None:
    writer = df.write.mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
