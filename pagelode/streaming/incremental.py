"""Incremental flattening: new canonical page files to lines, as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pagelode.sources.canonical import PAGE, flatten


def append_lines(spark: SparkSession, pages: str, lines: str, checkpoint: str) -> StreamingQuery:
    """Read page files not seen before from ``pages`` and append their lines to the table ``lines``; ends when none is left.

    Stateless, so there is no watermark; each file's lines are written once for each version of the file name.
    """
    source = spark.readStream.schema(T._parse_datatype_string(PAGE)).json(pages)

    def write(batch: DataFrame, _: int) -> None:
        flatten(batch).write.mode("append").parquet(lines)

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
