"""Typed projection of text columns.

Spark's default (ANSI) ``cast`` raises on bad text; the warehouse keeps the
row with a NULL field instead, so the projection uses ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def try_cast_columns(df: DataFrame, types: dict[str, str]) -> list[Column]:
    """One column per schema field, cast with ``try_cast`` where a type is given."""
    out = []
    for name in df.columns:
        if name in types:
            out.append(F.col(name).try_cast(types[name]).alias(name))
        else:
            out.append(F.col(name))
    return out
