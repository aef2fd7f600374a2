"""Golden values from the seed rows of the source system (FIXTURES.md §4)."""

import json

from pyspark.sql import functions as F

from tidemark.functions.keys import full_md5_key, row_key
from tidemark.operators import cdc
from tidemark.operators.aggregates import order_totals
from tidemark.operators.keyed import ORDER_FIELDS, expand_family
from tidemark.operators.lookup import enrich_category
from tidemark.plans import jobs
from tidemark.schemas import CATEGORY, USER_BEHAVIOR_TEXT, typed_behavior
from tidemark.sources.topic import parse_json

# Fixed seed rows: orderId, orderNo, goodsMoney, realTotalMoney, payFrom;
# goodId 4432, userId 3223, province 湖北, createTime 2020-04-06 14:31:48 in all.
SEED = [
    (3, "1", "9999.00", "7878787.00", 0),
    (66, "33232", "112.60", "3232.99", 1),
    (69, "33232", "112.60", "3232.99", 1),
    (90, "88", "112.60", "3232.99", 1),
    (3333, "33232", "444.00", "3232.99", 1),
    (5555, "6666", "112.60", "3232.99", 1),
]
FLOW = [(1, 1, "test", "orders", "dwd:orders", "CF", True, 10, "orderId,orderNo", 2)]
FLOW_SCHEMA = ("flowId int, mode int, databaseName string, tableName string, hbaseTable string, "
               "family string, uppercaseQualifier boolean, commitBatch int, rowKey string, status int")

# Fixed seed categories: 4580530..4580537 -> parents 1..8.
CATEGORIES = ["服饰鞋包", "家装家饰", "家电", "美妆", "母婴", "3C数码", "运动户外", "食品"]

KEYS_AFTER_INSERT = {"8ad811ba_3|1", "1462ccc4_66|33232", "6016c406_69|33232", "42d04913_90|88",
                     "579256f7_3333|33232", "6825165a_5555|6666"}
KEYS_AFTER_CHANGES = (KEYS_AFTER_INSERT - {"8ad811ba_3|1", "6825165a_5555|6666"}) | {"e3960465_888888|6666"}


def seed_row(o):
    oid, no, goods, real, pay = o
    return {"orderId": str(oid), "orderNo": no, "userId": "3223", "goodId": "4432",
            "goodsMoney": goods, "realTotalMoney": real, "payFrom": str(pay),
            "province": "湖北", "createTime": "2020-04-06 14:31:48"}


def messages(spark, with_changes):
    rows = [seed_row(o) for o in SEED]
    msgs = [(0, 0, json.dumps({"database": "test", "table": "orders", "type": "INSERT", "data": rows}))]
    if with_changes:
        moved = dict(rows[5], orderId="888888")
        msgs.append((0, 1, json.dumps({"database": "test", "table": "orders", "type": "UPDATE",
                                       "data": [moved], "old": [{"orderId": "5555"}]})))
        msgs.append((0, 2, json.dumps({"database": "test", "table": "orders", "type": "DELETE",
                                       "data": [rows[0]]})))
    return spark.createDataFrame(msgs, "partition int, offset bigint, value string")


def state(spark, with_changes):
    m, rejects = cdc.parse_changelog(messages(spark, with_changes))
    assert rejects.count() == 0
    ops = cdc.to_ops(cdc.route(m, spark.createDataFrame(FLOW, FLOW_SCHEMA)))
    return cdc.live_cells(cdc.fold(ops))


def test_row_keys_after_inserts(spark):
    keys = {r.rowkey for r in state(spark, False).select("rowkey").distinct().collect()}
    assert keys == KEYS_AFTER_INSERT


def test_row_keys_after_update_and_delete(spark):
    keys = {r.rowkey for r in state(spark, True).select("rowkey").distinct().collect()}
    assert keys == KEYS_AFTER_CHANGES


def test_uppercase_qualifiers(spark):
    quals = {r.qualifier for r in state(spark, False).select("qualifier").distinct().collect()}
    assert quals == {"ORDERID", "ORDERNO", "USERID", "GOODID", "GOODSMONEY", "REALTOTALMONEY",
                     "PAYFROM", "PROVINCE", "CREATETIME"}


def _user_totals(spark, with_changes):
    kv = cdc.state_to_keyed(state(spark, with_changes), "CF", [f.upper() for f in ORDER_FIELDS], "dwd:orders")
    text = expand_family(kv, "cf", list(ORDER_FIELDS))
    return order_totals(text, ["userId"]).collect()


def test_user_totals_after_inserts(spark):
    (r,) = _user_totals(spark, False)
    assert (r.userId, r.order_num, round(r.gmv, 2)) == ("3223", 6, 7894951.95)


def test_user_totals_after_changes(spark):
    (r,) = _user_totals(spark, True)
    assert (r.userId, r.order_num, round(r.gmv, 2)) == ("3223", 5, 16164.95)


def test_row_key_function_matches_golden(spark):
    df = spark.createDataFrame([(o[0], o[1]) for o in SEED] + [(888888, "6666")], "a bigint, b string")
    keys = {r.k for r in df.select(row_key(["a", "b"]).alias("k")).collect()}
    assert keys == KEYS_AFTER_INSERT | {"e3960465_888888|6666"}


def test_null_key_part_is_empty_string(spark):
    df = spark.createDataFrame([(66, None)], "a bigint, b string")
    (r,) = df.select(row_key(["a", "b"]).alias("k")).collect()
    assert r.k.endswith("_66|")


def test_full_md5_key(spark):
    (r,) = spark.createDataFrame([("3223",)], "u string").select(full_md5_key("u").alias("k")).collect()
    assert r.k == "df83971673de5c8e71ca1e2645718dad_3223"


def _typed_seed(spark):
    rows = [(o[0], 3223, "湖北", float(o[3]), "2020-04-06 14:31:48") for o in SEED]
    return (spark.createDataFrame(rows, "orderId bigint, userId bigint, province string, "
                                        "realTotalMoney double, createTime string")
            .withColumn("createTime", F.col("createTime").cast("timestamp_ntz")))


def test_orders_per_hour_and_minute(spark):
    o = _typed_seed(spark)
    assert [tuple(r) for r in jobs.orders_per_hour_app(jobs.orders_per_hour(o)).collect()] == [("2020-04-06 14", 6)]
    m = jobs.orders_per_minute_app(jobs.orders_per_minute(o)).collect()
    assert [tuple(r) for r in m] == [("2020-04-06", "2020-04-06 14:31", 6)]


def test_hour_of_day(spark):
    (r,) = jobs.user_province_hour(_typed_seed(spark)).collect()
    assert (r.hour_of_day, r.order_num, round(r.gmv, 2)) == (14, 6, 7894951.95)


def _behavior_sample(spark):
    sample = '{"user_id": "12331", "item_id":"310884", "category_id": "4580532", "behavior": "pv", "ts": "2017-11-27T00:00:00Z"}'
    raw = spark.createDataFrame([(sample,)], "value string")
    return typed_behavior(parse_json(raw, USER_BEHAVIOR_TEXT))


def _category_dim(spark):
    rows = [(4580530 + i, i + 1, name) for i, name in enumerate(CATEGORIES)]
    return spark.createDataFrame(rows, CATEGORY)


def test_behavior_sample_uv_label(spark):
    b = _behavior_sample(spark)
    assert [tuple(r) for r in jobs.uv_10min_app(jobs.uv_10min(b)).collect()] == [("2017-11-27 00:00", 1)]


def test_behavior_sample_category_and_not_a_purchase(spark):
    b = _behavior_sample(spark)
    (r,) = enrich_category(b, _category_dim(spark)).collect()
    assert r.category_name == "家电"
    assert jobs.category_counts(b, _category_dim(spark)).count() == 0


def test_unmatched_lookup_is_other(spark):
    b = _behavior_sample(spark).withColumn("category_id", F.lit(1).cast("bigint"))
    (r,) = enrich_category(b, _category_dim(spark)).collect()
    assert r.category_name == "其他"


def test_cast_rejects_keeps_rows_and_reports_bad_text(spark):
    from tidemark.operators.keyed import cast_rejects, dwd_orders
    rows = [seed_row(o) for o in SEED[:2]]
    rows[1] = dict(rows[1], realTotalMoney="12,5", createTime="not a time")
    df = spark.createDataFrame(rows).select(*ORDER_FIELDS)
    typed = dwd_orders(df).collect()
    assert len(typed) == 2 and typed[1].realTotalMoney is None and typed[1].createTime is None
    assert [r.orderId for r in cast_rejects(df).collect()] == ["66"]


def test_print_rows_batch(spark, capsys):
    from tidemark.sinks.topic import print_rows
    print_rows(spark.createDataFrame([("湖北", 6)], "province string, n bigint"))
    assert "湖北" in capsys.readouterr().out
