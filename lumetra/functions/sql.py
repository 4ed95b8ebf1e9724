"""The scalar log functions as SQL functions, for use from SQL text.

They are SQL expressions that the optimizer inlines, so there is no UDF boundary.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lumetra.functions import weblog as W


def sql_functions() -> dict[str, str]:
    """Signature -> body of each function."""
    return {
        "log_time_text(t STRING)": W.log_time_text("t"),
        "url_text(u STRING)": W.url_text("u"),
        "url_param(u STRING, n STRING)": W.url_param("u", "n"),
        "interface_of(p STRING)": W.interface_of("p"),
        "module_label(j STRING)": f"transform(array({W.module_fields('j')}), e -> {W.module_label('e')})[0]",
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions as temporary SQL functions of the session; returns their names."""
    names = []
    for signature, body in sql_functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS STRING RETURN {body}")
        names.append(signature.split("(")[0])
    return names
