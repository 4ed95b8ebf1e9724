"""The two access-log jobs: raw lines to the page table, and the page table to the detail table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lumetra.operators import logs as L
from lumetra.operators.interfaces import PAGES
from lumetra.schemas import LOG_DETAIL, LOG_RAW_COLUMNS
from lumetra.sources.logs import append_orc, read_lines
from lumetra.sources.tables import create_table, read_table, replace_table


def run_page_job(
    spark: SparkSession, input_glob: str, output: str, pages: Sequence[str] = tuple(PAGES),
    dedupe: bool = False, quarantine_path: str | None = None, strict: bool = False,
) -> None:
    """Text lines to an ORC folder of the rows of the listed pages, in one pass and one write.

    The write itself counts the bad lines; they are written in a second pass only if there are
    any and a folder is given.
    """
    parsed = L.parse_lines(read_lines(spark, input_glob))
    if strict:
        L.check_strict(parsed)
    counts = Observation("lines")
    seen = parsed.observe(counts, F.count_if(F.col("reason").isNotNull()).alias("bad_rows"))
    append_orc(L.page_filter(L.good_rows(seen), pages, dedupe).select(*LOG_RAW_COLUMNS), output)
    if quarantine_path and counts.get["bad_rows"]:
        append_orc(L.quarantine(parsed), quarantine_path)


def count_columns(detail: DataFrame) -> list[Column]:
    """Counters over the good and bad detail rows."""
    ok = F.col("reason").isNull()
    return [
        F.count_if(ok).alias("detail_rows"),
        F.count_if(~ok).alias("bad_rows"),
        F.count_if(ok & F.col("unmapped_interface")).alias("unmapped_rows"),
    ]


def run_detail_job(
    spark: SparkSession, source: str | DataFrame, target: str, replace: bool = False,
    quarantine_path: str | None = None, strict: bool = False, path: str | None = None,
) -> dict[str, int]:
    """Parsed-line table to the detail table. Row counts come from the write itself; the bad rows
    are written in a second pass only if there are any and a folder is given."""
    detail = L.detail_rows(L.from_table(read_table(spark, source)))
    if strict:
        L.check_strict(detail)
    counts = Observation("detail")
    good = L.good_rows(detail.observe(counts, *count_columns(detail))).select(*LOG_DETAIL.fieldNames())
    (replace_table if replace else create_table)(good, target, path)
    result = counts.get
    if quarantine_path and result["bad_rows"]:
        append_orc(L.quarantine(detail), quarantine_path)
    return result


def etl_row_counts(lines: DataFrame) -> DataFrame:
    """One row of counters over all steps from raw lines on, in one pass."""
    cleaned = L.clean(L.parse_lines(lines))
    enriched = L.enrich(cleaned)
    ok, get = F.col("reason").isNull(), F.col("method") == "GET"
    return enriched.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.coalesce(F.col("reason") != "unparsable_line", F.lit(True))).alias("parsed"),
        F.count_if(F.coalesce(F.col("reason"), F.lit("no_interface")) == "no_interface").alias("cleaned"),
        F.count_if(ok & get).alias("detail"),
        F.count_if(ok & get & F.col("unmapped_interface")).alias("unmapped"),
    )
