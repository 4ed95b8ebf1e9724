"""Access-log files: text scan and ORC sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path_glob: str) -> DataFrame:
    """``(value)``: one row per line of the text files of a glob."""
    return spark.read.text(path_glob)


def append_orc(
    df: DataFrame, path: str, coalesce_to: int | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Append to an ORC folder. The number of files follows the job's partitions unless
    ``coalesce_to`` asks for fewer; asking for one puts the whole write into one task."""
    out = df if coalesce_to is None else df.coalesce(coalesce_to)
    writer = out.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.orc(path)


def replace_days(df: DataFrame, path: str, day: str = "dt") -> None:
    """Write whole days to an ORC folder with a subfolder per day, in place of what it holds of the same days.

    A rerun adds nothing twice, and other days stay. Rows are dealt out by day, big days over several files of about the
    same size, small days in one each (adaptive execution does this; without it a day is one file).
    """
    out = df.hint("rebalance", day)
    out.write.mode("overwrite").partitionBy(day).option("partitionOverwriteMode", "dynamic").orc(path)
