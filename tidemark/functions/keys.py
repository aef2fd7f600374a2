"""Row keys of the keyed tables.

* ``row_key``: the salted composite key ``md5(j)[0:8] + '_' + j`` where ``j``
  joins the key values with ``|`` and a null value is the empty string.  The
  8-hex-digit prefix spreads consecutive ids over the key space.
* ``full_md5_key``: ``md5(v) || '_' || v``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def joined_key(values: Column) -> Column:
    """Join an array of key values with ``|``; nulls become ''.

    ``array_join`` with a null replacement keeps the position of a null part;
    ``concat_ws`` would drop it and give a different key.
    """
    return F.array_join(values, "|", "")


def salted(joined: Column) -> Column:
    return F.concat(F.substring(F.md5(joined), 1, 8), F.lit("_"), joined)


def row_key(cols: Sequence[str | Column]) -> Column:
    """Salted composite row key over columns (cast to string)."""
    parts = F.array(*[_col(c).cast("string") for c in cols])
    return salted(joined_key(parts))


def lower_names(names: Column) -> Column:
    return F.transform(names, lambda k: F.lower(k))


def value_at(data: Column, low: Column, low_name: Column) -> Column:
    """Value of a map's key ``low_name``; ``low`` has the map's key names, both in lower case (NULL if absent)."""
    return F.get(F.map_values(data), F.array_position(low, low_name).cast("int") - 1)  # of the first; 0: none


def map_value(data: Column, name: Column) -> Column:
    """Value of a map's key, the name matched without case (NULL if absent)."""
    return value_at(data, lower_names(F.map_keys(data)), F.lower(name))


def row_key_from_map(data: Column, key_names: Column) -> Column:
    """Salted row key of a string map, key names given as an array column (matched without case)."""
    return salted(joined_key(F.transform(key_names, lambda k: map_value(data, k))))


def full_md5_key(col: str | Column) -> Column:
    v = _col(col).cast("string")
    return F.concat(F.md5(v), F.lit("_"), v)
