"""Window labels and clock helpers.

The source jobs label a window with ``max(substring(date_format(t), 1, n))``
over its rows.  Every row of an aligned tumbling window shares that prefix, so
the label equals the formatted window start: formatting once per group is the
same value without a per-row string aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed label formats of the result tables.
HOUR_LABEL = "yyyy-MM-dd HH"          # day_hour_time
MINUTE_LABEL = "yyyy-MM-dd HH:mm"     # day_time_str, per minute
TEN_MINUTE_LABEL = "yyyy-MM-dd HH:mm"  # per 10 minutes: start minute ends in 0


def window_label(window_col: str | Column, pattern: str) -> Column:
    """Format the start of a ``window`` struct column."""
    w = F.col(window_col) if isinstance(window_col, str) else window_col
    return F.date_format(w.getField("start"), pattern)


def hour_of_day(window_col: str | Column) -> Column:
    """``HOUR(TUMBLE_START(..))`` as BIGINT: the day is dropped on purpose."""
    w = F.col(window_col) if isinstance(window_col, str) else window_col
    return F.hour(w.getField("start")).cast("bigint")


def current_hour_label(now: Column | str | None = None, offset_hours: int = 8) -> Column:
    """``yyyy-MM-dd HH`` of ``now`` shifted by ``offset_hours`` (UTC+8 wall clock).

    ``now`` defaults to ``current_timestamp()``; tests pass a fixed literal so
    the filter is repeatable.
    """
    if now is None:
        ts = F.current_timestamp()
    elif isinstance(now, str):
        ts = F.lit(now).cast("timestamp")
    else:
        ts = now
    return F.date_format(F.timestamp_add("HOUR", F.lit(offset_hours), ts), HOUR_LABEL)
