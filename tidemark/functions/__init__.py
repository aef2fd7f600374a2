"""Scalar building blocks, all built-in Spark expressions (no Python UDFs)."""

from tidemark.functions.casts import try_cast_columns
from tidemark.functions.keys import full_md5_key, row_key
from tidemark.functions.labels import (
    HOUR_LABEL, MINUTE_LABEL, TEN_MINUTE_LABEL, current_hour_label, hour_of_day,
    window_label,
)

__all__ = [
    "HOUR_LABEL", "MINUTE_LABEL", "TEN_MINUTE_LABEL", "current_hour_label",
    "full_md5_key", "hour_of_day", "row_key", "try_cast_columns",
    "window_label",
]
