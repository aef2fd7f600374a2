"""Event time on a stream: watermarks need TIMESTAMP (not TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed setting of the source jobs: watermark = event time - 5 s; later rows
# for a closed window are dropped (no allowed lateness).
WATERMARK_DELAY = "5 seconds"


def with_event_time(df: DataFrame, col: str, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Cast ``col`` to TIMESTAMP (session zone UTC keeps the wall clock) and
    declare the watermark on it."""
    return df.withColumn(col, F.col(col).cast("timestamp")).withWatermark(col, delay)


def with_processing_time(df: DataFrame, col: str = "proctime") -> DataFrame:
    """Add the clock of the batch or micro-batch that reads the row."""
    return df.withColumn(col, F.current_timestamp())
