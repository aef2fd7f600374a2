"""Keyed-table snapshots, JDBC dimensions and age-limited cached reads."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.operators.keyed import ORDER_FIELDS, expand_family
from tidemark.sinks.bucketed import BucketedTable
from tidemark.sinks.keyed_state import KIND, KeyedStateTable
from tidemark.sinks.upsert import UpsertTable

# Fixed name of the keyed order table in the routing config.
ORDERS_TABLE = "dwd:orders"


def keyed_table(spark: SparkSession, path: str, table: str = ORDERS_TABLE, family: str = "cf",
                fields: Sequence[str] = ORDER_FIELDS) -> DataFrame:
    """Current rows of a keyed table, whichever job wrote it.

    * a table of the CDC sync: ``rowkey, family STRUCT<fields>`` of its keyed
      table ``table`` (the sync may hold several);
    * an upsert table: its rows;
    * anything else: a plain Parquet directory.
    """
    if BucketedTable.exists(spark, path):
        if BucketedTable(spark, path).rule.get("kind") == KIND:
            return cdc.state_to_keyed(KeyedStateTable(spark, path).rows(), family, list(fields), table)
        return UpsertTable(spark, path).current()
    return spark.read.parquet(path)


def register(spark: SparkSession, tables: Mapping[str, str | tuple[str, str]]) -> None:
    """Name tables for SQL: ``name -> path`` of any table the jobs wrote, or
    ``name -> (schema, path)`` of a JSON topic.  A keyed table's family is expanded."""
    for name, where in tables.items():
        if isinstance(where, tuple):
            df = spark.read.schema(where[0]).option("recursiveFileLookup", "true").json(where[1])
        else:
            df = load_table(spark, where)
            if "cf" in df.columns:
                df = expand_family(df, "cf")
        df.createOrReplaceTempView(name)


def load_table(spark: SparkSession, where: str) -> DataFrame:
    """A small table by place: ``jdbc:<url>#<table>``, or a path for ``keyed_table``."""
    if where.startswith("jdbc:"):
        url, _, name = where.partition("#")
        return jdbc_table(spark, url, name)
    return keyed_table(spark, where)


def jdbc_table(spark: SparkSession, url: str, table: str, user_env: str = "JDBC_USER",
               password_env: str = "JDBC_PASSWORD", **options: str) -> DataFrame:
    """A JDBC table; credentials come from options or the environment, never code."""
    opts = {"url": url, "dbtable": table, **options}
    if "user" not in opts and os.environ.get(user_env):
        opts["user"] = os.environ[user_env]
    if "password" not in opts and os.environ.get(password_env):
        opts["password"] = os.environ[password_env]
    return spark.read.format("jdbc").options(**opts).load()


class CachedTable:
    """A small table re-read when older than ``max_age_s`` (config poll,
    dimension lookup cache).  The cached copy lives on the executors; a lost
    executor recomputes its part from the source."""

    def __init__(self, loader: Callable[[], DataFrame], max_age_s: float = 60.0):
        self.loader = loader
        self.max_age_s = max_age_s
        self._df: DataFrame | None = None
        self._loaded_at = 0.0

    def get(self) -> DataFrame:
        now = time.monotonic()
        if self._df is None or now - self._loaded_at >= self.max_age_s:
            old = self._df
            df = self.loader().cache()
            df.count()
            self._df, self._loaded_at = df, now
            if old is not None:
                old.unpersist()
        return self._df


class KeyedLookup:
    """Rows of a dimension, looked up by the keys that a batch holds.

    Only the keys not known yet are asked for: the filter on them reaches the
    dimension's scan (Parquet row groups, a JDBC ``WHERE``).  Rows are kept by key
    for ``max_age_s``, those of at most ``max_keys`` keys.  A batch with more
    keys than that joins the dimension itself.
    """

    def __init__(self, loader: Callable[[], DataFrame], key: str, max_keys: int = 5000, max_age_s: float = 600.0):
        self.loader, self.key, self.max_keys, self.max_age_s = loader, key, max_keys, max_age_s
        self.kept: dict[object, tuple[float, list[Row]]] = {}

    def asked(self, keys: list) -> DataFrame:
        """The scan of the dimension for some keys."""
        return self.loader().filter(F.col(self.key).isin(keys))

    def rows_for(self, keys: DataFrame) -> DataFrame:
        """The dimension's rows of the keys in the one column of ``keys``, and maybe others."""
        column = F.col(keys.columns[0])
        wanted = [r[0] for r in keys.filter(column.isNotNull()).distinct().limit(self.max_keys + 1).collect()]
        if len(wanted) > self.max_keys:
            return self.loader()
        now = time.monotonic()
        self.kept = {k: v for k, v in self.kept.items() if now - v[0] < self.max_age_s}
        missing = [k for k in wanted if k not in self.kept]
        dim = self.asked(missing)
        if missing:
            found: dict[object, list[Row]] = {k: [] for k in missing}
            for row in dim.collect():
                found[row[self.key]].append(row)
            self.kept.update({k: (now, rows) for k, rows in found.items()})
        rows = [r for k in wanted for r in self.kept[k][1]]
        while len(self.kept) > self.max_keys:
            self.kept.pop(next(iter(self.kept)))  # the one looked up longest ago
        return keys.sparkSession.createDataFrame(rows, dim.schema)
