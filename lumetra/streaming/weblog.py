"""The log jobs on a growing folder. The log steps keep no state, so the batch operators are used
as they are and every trigger reads only new files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from lumetra.operators import logs as L


def stream_detail(
    spark: SparkSession, input_glob: str, output: str, checkpoint: str, quarantine: bool = False
) -> StreamingQuery:
    """Detail rows (or the quarantined lines) of all files not yet read, appended to ORC; stops
    when the folder is read."""
    rows = L.detail_rows(L.parse_lines(spark.readStream.text(input_glob)))
    chosen = L.quarantine(rows) if quarantine else L.good_rows(rows)
    return (
        chosen.writeStream.format("orc").outputMode("append").option("path", output)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
