"""Warehouse inputs derived from the shared test tables.

Each function reads the given Parquet tables and derives the source shapes
of the warehouse (behaviour log, orders with event time, keyed order table,
category dimension, CDC changelog), so every query's work grows with the
tables.  Fixed derivation constants are collected at the top.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import row_key
from tidemark.operators.keyed import ORDER_FIELDS, to_keyed

# Fixed derivation values (mirrored by the DuckDB oracle SQL).
ITEM_MODULUS = 500                # item_id = event_id % 500
PURCHASE_EVENT = "purchase"       # stands for the source's behaviour 'buy'
BUY = "buy"
GOOD_MODULUS = 1000               # goodId = o_orderkey % 1000
PAY_MODULUS = 3                   # payFrom = o_orderkey % 3
ORDER_KEY_COLUMNS = "orderId,orderNo"
CDC_DATABASE = "test"
CDC_BLOCK = 4                     # orders per changelog message
PHASE_STRIDE = 1_000_000_000_000  # offset = phase * stride + block


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def behavior(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """ods.user_behavior: user_id, item_id, category_id, behavior, ts (and event columns to ``keep``)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id"),
        (F.col("event_id") % ITEM_MODULUS).alias("item_id"),
        F.get_json_object("props", "$.k").try_cast("int").alias("category_id"),
        F.when(F.col("event_type") == PURCHASE_EVENT, F.lit(BUY))
         .otherwise(F.col("event_type")).alias("behavior"),
        F.col("ts"),
        *keep,
    )


def orders_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed orders with a real event time (events as orders)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("orderId"),
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("province"),
        F.col("value").alias("realTotalMoney"),
        F.col("ts").alias("createTime"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src.orders shape from orders x customer x nation (typed)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # One row per key on both lookup sides: a lookup never multiplies orders,
    # and because the side is provably distinct on the key, Catalyst drops
    # the join from queries that use no lookup column.  The customer
    # aggregate leaves that side hash-partitioned on the key, which the join
    # reuses; nation (25 rows) is broadcast by Catalyst's own size estimate.
    n = (table(spark, sf_dir, "nation").groupBy("n_nationkey")
         .agg(F.max("n_name").alias("n_name")))
    cn = (c.groupBy("c_custkey").agg(F.max("c_nationkey").alias("c_nationkey"))
          .join(n, F.col("c_nationkey") == n["n_nationkey"], "left")
          .select("c_custkey", "n_name"))
    j = o.join(cn, o["o_custkey"] == cn["c_custkey"], "left")
    money = F.col("o_totalprice").cast("decimal(11,2)")
    return j.select(
        F.col("o_orderkey").alias("orderId"),
        F.col("o_orderpriority").alias("orderNo"),
        F.col("o_custkey").alias("userId"),
        (F.col("o_orderkey") % GOOD_MODULUS).alias("goodId"),
        money.alias("goodsMoney"),
        money.alias("realTotalMoney"),
        (F.col("o_orderkey") % PAY_MODULUS).alias("payFrom"),
        F.col("n_name").alias("province"),
        F.col("o_orderdate").alias("createTime"),
    )


def text_fields(df: DataFrame) -> dict[str, Column]:
    """The order columns as the text a binlog carries."""
    return {
        "createTime": F.date_format("createTime", "yyyy-MM-dd HH:mm:ss"),
        "goodId": F.col("goodId").cast("string"),
        "goodsMoney": F.col("goodsMoney").cast("string"),
        "orderId": F.col("orderId").cast("string"),
        "orderNo": F.col("orderNo"),
        "payFrom": F.col("payFrom").cast("string"),
        "province": F.col("province"),
        "realTotalMoney": F.col("realTotalMoney").cast("string"),
        "userId": F.col("userId").cast("string"),
    }


def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed order table with its family expanded: rowkey + text fields.

    Flat columns, so a query of a few fields reads those alone (a struct in
    between would hold all of them, and the lookup join that feeds them)."""
    o = orders(spark, sf_dir)
    t = text_fields(o)
    return o.select(row_key(["orderId", "orderNo"]).alias("rowkey"),
                    *[t[name].alias(name) for name in ORDER_FIELDS])


def orders_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dwd.orders_kv: rowkey + family ``cf`` of text fields."""
    return to_keyed(orders_text(spark, sf_dir), F.col("rowkey"), "cf", list(ORDER_FIELDS))


def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim.category from nation x region; parents 1,3,5,7,9."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"], "left")
    return j.select(
        F.col("n_nationkey").alias("sub_category_id"),
        (F.col("n_regionkey") * 2 + 1).alias("parent_category_id"),
        F.col("r_name").alias("parent_category_name"),
    )


FLOW_SCHEMA = ("flowId int, mode int, databaseName string, tableName string, "
               "hbaseTable string, family string, uppercaseQualifier boolean, "
               "commitBatch int, rowKey string, status int")

# Fixed routing config rows: the seed flow (running), one flow that is only
# ready (must be filtered); the customer table has none (must be dropped).
FLOW_ROWS = [
    (1, 1, "test", "orders", "dwd:orders", "CF", True, 10, "orderId,orderNo", 2),
    (2, 0, "test", "nation", "dwd:nation", "cf", False, 10, "n_nationkey", 1),
]


def flow(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FLOW_ROWS, FLOW_SCHEMA)


def _text_map(row: Column, **changed: Column) -> Column:
    kv = []
    for name in ORDER_FIELDS:
        kv += [F.lit(name), changed.get(name, row[name])]
    return F.create_map(*kv)


def _by_pos(rows: Column) -> Column:
    """The rows of one message, ordered by their key."""
    return F.array_sort(F.collect_list(rows), lambda a, b: F.signum(a["pos_key"] - b["pos_key"]).cast("int"))


def key_shift(spark: SparkSession, sf_dir: str) -> int:
    """What a key change adds to an order key: beyond the greatest key, so no moved key meets another."""
    return (table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0] or 0) + 1


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A binlog-style JSON topic derived from ``orders`` (and two other tables).

    Phases, in offset order (``offset = phase * stride + orderId div 4``,
    rows of one message ordered by orderId):

    0. INSERT every order.
    1. UPDATE realTotalMoney + 1 where orderId % 3 = 0.
    2. UPDATE province to NULL where orderId % 7 = 0.
    3. Key change orderId -> orderId + ``key_shift`` where orderId % 50 = 0.
    4. DELETE where orderId % 10 = 1.
    5. ``insert`` (lower case) the original row again where orderId % 100 = 1.
    6. INSERT every customer (no routing config: dropped).
    7. INSERT every nation (config not running: dropped).

    Columns: ``partition``, ``offset``, ``value`` (JSON text).
    """
    o = orders(spark, sf_dir)
    shift = key_shift(spark, sf_dir)
    oid = F.col("orderId")
    # Each order is shuffled once, as text; a block of orders generates the messages of all phases.
    # A block holds CDC_BLOCK keys, so the collected group is bounded.
    row = F.struct(oid.alias("pos_key"), *[c.alias(name) for name, c in text_fields(o).items()],
                   (F.col("realTotalMoney") + 1).cast("string").alias("more"))
    blocks = o.groupBy(F.floor(oid / CDC_BLOCK).alias("block")).agg(_by_pos(row).alias("rows"))

    def t1(r: Column) -> Column:
        return F.when(r["pos_key"] % 3 == 0, r["more"]).otherwise(r["realTotalMoney"])

    def t2(r: Column) -> Column:
        return F.when(r["pos_key"] % 7 == 0, F.lit(None).cast("string")).otherwise(r["province"])

    def t3(r: Column) -> Column:
        return (r["pos_key"] + shift).cast("string")

    def of(phase: int, kind: str, rows: Column, data, old=None) -> Column:
        before = F.transform(rows, old) if old else F.lit(None).cast("array<map<string,string>>")
        return F.struct(F.lit(phase).alias("phase"), F.lit(kind).alias("type"), F.lit("orders").alias("table"),
                        F.transform(rows, data).alias("data"), before.alias("old"))

    def where(n: int, rest: int) -> Column:
        return F.filter("rows", lambda r: r["pos_key"] % n == rest)

    phases = F.array(
        of(0, "INSERT", F.col("rows"), lambda r: _text_map(r)),
        of(1, "UPDATE", where(3, 0), lambda r: _text_map(r, realTotalMoney=t1(r)),
           lambda r: F.create_map(F.lit("realTotalMoney"), r["realTotalMoney"])),
        of(2, "UPDATE", where(7, 0), lambda r: _text_map(r, realTotalMoney=t1(r), province=t2(r)),
           lambda r: F.create_map(F.lit("province"), r["province"])),
        of(3, "UPDATE", where(50, 0), lambda r: _text_map(r, realTotalMoney=t1(r), province=t2(r), orderId=t3(r)),
           lambda r: F.create_map(F.lit("orderId"), r["orderId"])),
        of(4, "DELETE", where(10, 1), lambda r: _text_map(r, realTotalMoney=t1(r), province=t2(r))),
        of(5, "insert", where(100, 1), lambda r: _text_map(r)))
    msgs = blocks.select("block", F.explode(F.filter(phases, lambda m: F.size(m["data"]) > 0)).alias("m")) \
        .select("m.phase", "block", "m.type", "m.table", "m.data", "m.old")

    cust = table(spark, sf_dir, "customer")
    cust_rows = cust.select(
        F.lit(6).alias("phase"), F.lit("INSERT").alias("type"), F.lit("customer").alias("table"),
        F.col("c_custkey").alias("block"), F.col("c_custkey").alias("pos_key"),
        F.create_map(F.lit("c_custkey"), F.col("c_custkey").cast("string"),
                     F.lit("c_name"), F.col("c_name")).alias("data_row"))
    nat = table(spark, sf_dir, "nation")
    nat_rows = nat.select(
        F.lit(7).alias("phase"), F.lit("INSERT").alias("type"), F.lit("nation").alias("table"),
        F.col("n_nationkey").cast("bigint").alias("block"), F.col("n_nationkey").cast("bigint").alias("pos_key"),
        F.create_map(F.lit("n_nationkey"), F.col("n_nationkey").cast("string"),
                     F.lit("n_name"), F.col("n_name")).alias("data_row"))
    others = cust_rows.unionByName(nat_rows).groupBy("phase", "block", "type", "table").agg(
        _by_pos(F.struct("pos_key", "data_row")).alias("rows"))
    msgs = msgs.unionByName(others.select(
        "phase", "block", "type", "table", F.col("rows.data_row").alias("data"),
        F.lit(None).cast("array<map<string,string>>").alias("old")))
    message = F.struct(F.lit(CDC_DATABASE).alias("database"), "table", "type", "data", "old")
    return msgs.select(
        F.lit(0).alias("partition"),
        (F.col("phase").cast("bigint") * PHASE_STRIDE + F.col("block")).alias("offset"),
        F.to_json(message).alias("value"),
    )
