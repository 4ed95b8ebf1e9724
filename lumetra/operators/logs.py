"""Access-log jobs: parse, page filter, clean, enrich, quarantine.

Every step is DataFrame in, DataFrame out and narrow, but for the broadcast of the fixed rule
table. Bad rows never fail the job: steps set ``reason`` and keep the line in ``raw``;
``good_rows`` and ``quarantine`` tell them apart at the end.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.functions import weblog as W
from lumetra.operators import interfaces as I
from lumetra.schemas import LOG_CLEAN_COLUMNS, LOG_DETAIL_COLUMNS, LOG_RAW, LOG_RAW_COLUMNS, select_schema


def _computed_once(df: DataFrame, **columns: str) -> DataFrame:
    """Add columns behind a generator, which the optimizer does not substitute into later
    filters and projections, so that a regular expression runs once per row."""
    row = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return df.selectExpr("*", f"inline(array(struct({row})))")


def _named(names: Sequence[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter("reason IS NULL").drop("raw", "reason")


def quarantine(df: DataFrame) -> DataFrame:
    return df.filter("reason IS NOT NULL").select("raw", "reason")


def check_strict(df: DataFrame) -> DataFrame:
    """Raise with counts if any row is bad (one extra pass over the data)."""
    by_reason = quarantine(df).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["reason"]: r["n"] for r in by_reason.collect()}
    if counts:
        raise ValueError(f"bad rows: {counts}")
    return df


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Raw lines to the nine text fields, with ``raw`` and ``reason``; other columns are kept."""
    parsed = _computed_once(lines, _f=W.line_fields(column))
    fields = [f"CASE WHEN coalesce(size(_f), 0) = {W.N_FIELDS} THEN get(_f, {i}) END AS `{n}`" for i, n in enumerate(LOG_RAW_COLUMNS)]
    others = [c for c in lines.columns if c != column]
    reason = f"CASE WHEN coalesce(size(_f), 0) <> {W.N_FIELDS} THEN 'unparsable_line' END AS reason"
    return parsed.selectExpr(*_named(others), *fields, f"{column} AS raw", reason)


def from_table(table: DataFrame) -> DataFrame:
    """A stored table of parsed lines, as ``parse_lines`` returns it."""
    columns = _named(LOG_RAW_COLUMNS)
    return select_schema(table, LOG_RAW).selectExpr(
        *columns, f"concat_ws(' ', {', '.join(columns)}) AS raw", "cast(NULL AS STRING) AS reason"
    )


def page_filter(parsed: DataFrame, pages: Sequence[str] = tuple(I.PAGES), dedupe: bool = False) -> DataFrame:
    """Rows whose request contains a page: one row per page contained, or one in all if ``dedupe``.

    The pages are a list in the job's configuration, so each row is tested in place and in one
    pass; no join takes part.
    """
    if dedupe:
        return parsed.filter(F.col("request").rlike("|".join(re.escape(p) for p in pages)))
    listed = ", ".join(W.text(p) for p in dict.fromkeys(pages))
    return parsed.selectExpr("*", f"explode(filter(array({listed}), p -> contains(request, p))) AS page")


def clean(parsed: DataFrame) -> DataFrame:
    """Time as text, method, decoded request target; other columns are kept."""
    cut = _computed_once(parsed, _t=W.strip_brackets("`time`"), _target=W.request_target("request"))
    staged = _computed_once(
        cut, _time=W.log_time_text("_t"), method=W.request_method("request"), _decoded=W.url_text("_target")
    )
    reason = """coalesce(reason, CASE WHEN _target = '' THEN 'no_target' WHEN _decoded IS NULL THEN 'bad_encoding'
                WHEN _time IS NULL THEN 'bad_time' END) AS reason"""
    others = [c for c in parsed.columns if c not in LOG_RAW_COLUMNS and c not in ("raw", "reason")]
    renamed = {"time": "_time AS time", "request": "_decoded AS request"}
    return staged.selectExpr(
        *_named(others), *[renamed.get(c, f"`{c}`") for c in LOG_CLEAN_COLUMNS], "raw", reason
    )


def only_get(cleaned: DataFrame) -> DataFrame:
    """GET requests; rows that are already bad stay, so that they reach the quarantine."""
    return cleaned.filter("method = 'GET' OR reason IS NOT NULL")


def typed_extras(df: DataFrame) -> DataFrame:
    """Typed forms of the text columns; ``-`` becomes NULL."""
    return df.selectExpr(
        "*", "try_cast(status AS INT) AS status_code", "try_cast(size AS BIGINT) AS size_bytes",
        "try_cast(time AS TIMESTAMP_NTZ) AS event_ts",
    )


def with_labels(cleaned: DataFrame, fallback_to_city: bool = False) -> DataFrame:
    """Add ``act, action, detail, location, unmapped_interface`` by the rule table.

    The rule's path is unique, so the joins keep the number of rows. An unknown path gives NULL
    labels. The location is looked up by the path with ``//`` made ``/``.
    """
    dim = I.interface_dim(cleaned.sparkSession)
    by_path = F.broadcast(dim.drop("loc_param").withColumnRenamed("path", "_path"))
    by_single = F.broadcast(dim.selectExpr("path AS _single", "loc_param"))
    joined = (
        cleaned.selectExpr("*", f"{W.url_path('request')} AS _path", "concat(request, '&') AS _closed")
        .selectExpr("*", "replace(_path, '//', '/') AS _single")
        .join(by_path, "_path", "left")
        .join(by_single, "_single", "left")
    )
    param = W.one_param("_closed", "detail_param", I.detail_params())
    where = W.one_param("_closed", "loc_param", I.location_params())
    if fallback_to_city:
        where = f"coalesce(nullif({where}, ''), {W.url_param('request', W.text('city'))})"
    staged = _computed_once(joined, _param=param, _where=where)
    return staged.selectExpr(
        *_named(cleaned.columns), "act", "action",
        f"""CASE detail_kind WHEN 'text' THEN detail_prefix WHEN 'bare' THEN _param
            WHEN 'wrap' THEN concat(detail_prefix, {W.printed('_param')}, detail_suffix)
            WHEN 'choice' THEN CASE WHEN _param = '0' THEN '{I.COLLECTED_SONGS}' ELSE '{I.COLLECTED_LISTS}' END
            END AS detail""",
        f"""CASE WHEN loc_param = '' THEN '{I.NO_LOCATION}' WHEN loc_param IS NOT NULL
            THEN concat('{I.LOCATION_PREFIX}', {W.printed('_where')}) END AS location""",
        "reason IS NULL AND act IS NULL AS unmapped_interface",
    )


def enrich(cleaned: DataFrame, fallback_to_city: bool = False) -> DataFrame:
    """Cleaned rows to the sixteen detail columns, with ``unmapped_interface``, ``raw``, ``reason``."""
    staged = _computed_once(cleaned, interface_type=W.interface_of(W.url_path("request"))).withColumn(
        "reason", F.expr("coalesce(reason, CASE WHEN interface_type IS NULL THEN 'no_interface' END)")
    )
    named = {"parm": "request AS parm"}
    for column, name in (("user_id", "userid"), ("longitude", "longitude"), ("latitude", "latitude")):
        named[column] = f"{W.url_param('request', W.text(name))} AS {column}"
    others = [c for c in cleaned.columns if c not in LOG_CLEAN_COLUMNS and c not in ("raw", "reason")]
    return with_labels(staged, fallback_to_city).selectExpr(
        *_named(others), *[named.get(c, f"`{c}`") for c in LOG_DETAIL_COLUMNS], "unmapped_interface", "raw", "reason"
    )


def detail_rows(parsed: DataFrame, fallback_to_city: bool = False) -> DataFrame:
    """Parsed lines to detail rows of GET requests, good and bad."""
    return enrich(only_get(clean(parsed)), fallback_to_city)


def label_modules(events: DataFrame, column: str = "json") -> DataFrame:
    """Add ``label`` and ``reason`` ('bad_json', 'unknown_module') to module events in JSON text."""
    parsed = _computed_once(events, _e=W.module_fields(column))
    labelled = _computed_once(parsed, _label=W.module_label("_e"))
    bad = "_e IS NULL OR _e._corrupt_record IS NOT NULL"
    return labelled.selectExpr(
        *_named(events.columns), f"CASE WHEN NOT ({bad}) THEN _label END AS label",
        f"CASE WHEN {bad} THEN 'bad_json' WHEN _label IS NULL THEN 'unknown_module' END AS reason",
    )
