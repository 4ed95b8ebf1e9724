"""Fixed schemas of the log and recommendation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and order of the log tables.
LOG_RAW_COLUMNS = [
    "ipaddress", "identity", "user", "time", "request", "status", "size", "referer", "agent",
]
LOG_CLEAN_COLUMNS = [
    "ipaddress", "time", "method", "request", "status", "size", "referer", "agent",
]
LOG_DETAIL_COLUMNS = [
    "ipaddress", "time", "method", "interface_type", "parm", "status", "size", "referer", "agent",
    "user_id", "action", "act", "detail", "location", "longitude", "latitude",
]


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


LOG_RAW = _strings(LOG_RAW_COLUMNS)
LOG_CLEAN = _strings(LOG_CLEAN_COLUMNS)
LOG_DETAIL = _strings(LOG_DETAIL_COLUMNS)


def select_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """View a table through a schema by column name; missing columns or other types are an error."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in schema.fields if found.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"missing or differently typed columns: {wrong}")
    return df.select(*schema.fieldNames())
