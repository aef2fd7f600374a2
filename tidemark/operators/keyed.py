"""Keyed wide-column tables: ``rowkey`` + one family as a nested struct.

The source queries name family fields without a qualifier (``SELECT orderId
FROM t`` where ``t`` is ``rowkey, cf ROW<..>``).  Spark does not resolve into
a struct that way, so the family is expanded first.  Names are matched
case-insensitively: the CDC config may write family ``CF`` and upper-case
qualifiers while readers declare ``cf`` and camelCase.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.casts import try_cast_columns
from tidemark.functions.labels import current_hour_label

# Fixed field list of the order family, in the keyed table's declared order.
ORDER_FIELDS = ("createTime", "goodId", "goodsMoney", "orderId", "orderNo",
                "payFrom", "province", "realTotalMoney", "userId")

# Fixed column order and types of the typed order extract.
DWD_ORDER_COLUMNS = ("orderId", "orderNo", "userId", "goodId", "goodsMoney",
                     "realTotalMoney", "payFrom", "province", "createTime")
DWD_ORDER_TYPES = {
    "orderId": "bigint", "userId": "bigint", "goodId": "bigint",
    "goodsMoney": "double", "realTotalMoney": "double", "payFrom": "bigint",
    "createTime": "timestamp_ntz",
}


def to_keyed(df: DataFrame, key: Column, family: str, fields: Sequence[str | Column]) -> DataFrame:
    """``SELECT key AS rowkey, ROW(fields..) AS family``."""
    return df.select(key.alias("rowkey"), F.struct(*fields).alias(family))


def expand_family(kv: DataFrame, family: str = "cf",
                  fields: Sequence[str] | None = None) -> DataFrame:
    """``select(rowkey, family.*)`` with case-insensitive family and field names.

    When ``fields`` is given the output has exactly those names (canonical
    case); a field missing from the table comes out as a NULL string.
    """
    fam = _find(kv.columns, family)
    if fam is None:
        raise ValueError(f"no family {family!r} in {kv.columns}")
    key = _find(kv.columns, "rowkey") or "rowkey"
    struct = kv.schema[fam].dataType
    assert isinstance(struct, StructType)
    if fields is None:
        return kv.select(F.col(key).alias("rowkey"), f"`{fam}`.*")
    present = [f.name for f in struct.fields]
    cols = [F.col(key).alias("rowkey")]
    for name in fields:
        hit = _find(present, name)
        cols.append(F.col(f"`{fam}`.`{hit}`").alias(name) if hit
                    else F.lit(None).cast("string").alias(name))
    return kv.select(*cols)


def dwd_orders(orders_text: DataFrame, time_type: str = "timestamp_ntz") -> DataFrame:
    """Typed order extract: text fields to BIGINT / DOUBLE / TIMESTAMP.

    ``try_cast`` keeps a row whose text does not parse, with a NULL field.
    ``time_type`` is ``timestamp_ntz`` for storage or ``timestamp`` before a
    watermark (watermarks reject NTZ).
    """
    types = {**DWD_ORDER_TYPES, "createTime": time_type}
    df = orders_text.select(*DWD_ORDER_COLUMNS)
    return df.select(*try_cast_columns(df, types))


def failed_cast() -> Column:
    """Whether a non-null text of the row failed a cast of the typed extract."""
    bad = [F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in DWD_ORDER_TYPES.items()]
    return reduce(or_, bad)


def cast_rejects(orders_text: DataFrame) -> DataFrame:
    """Rows of which the typed extract loses a text."""
    return orders_text.where(failed_cast())


def current_hour(df: DataFrame, text_time_col: str = "createTime",
                 now: str | Column | None = None, offset_hours: int = 8) -> DataFrame:
    """Keep rows whose text time is in the current hour of the UTC+8 clock.

    ``substring(t, 1, 13) = date_format(now + 8h, 'yyyy-MM-dd HH')``, written
    as ``startswith`` (the label is always 13 characters, so the two agree):
    the label folds to a constant, and a prefix test on a stored column
    reaches the Parquet scan as a pushed filter that skips other hours' row
    groups.
    """
    return df.where(F.col(text_time_col).startswith(current_hour_label(now, offset_hours)))


def _find(names: Sequence[str], wanted: str) -> str | None:
    for n in names:
        if n == wanted:
            return n
    low = wanted.lower()
    for n in names:
        if n.lower() == low:
            return n
    return None
