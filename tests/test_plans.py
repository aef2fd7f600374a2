"""Physical plan shape: pruning, pushdown, broadcast behind a size check,
partial aggregation before every shuffle."""

import re

from tidemark.operators.lookup import enrich_category
from tidemark.plans import fixtures as fx
from tidemark.plans import jobs
from tidemark.plans.registry import QUERIES

from compare import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hourly_scan_reads_two_columns(spark):
    p = plan(QUERIES["orders_per_hour"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_uv_scan_reads_two_columns(spark):
    p = plan(QUERIES["uv_10min"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p


def test_lookup_is_broadcast_and_counts_combine_before_shuffle(spark):
    p = plan(QUERIES["category_counts"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "partial_count" in p


def test_lookup_is_shuffled_beyond_the_byte_threshold(spark):
    """No forced hint: a dimension over the session's threshold is joined by shuffle."""
    b, dim = fx.behavior(spark, SF_SMALL), fx.category(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(enrich_category(b, dim))
        assert "SortMergeJoin [category_id" in p
        assert "BroadcastHashJoin [category_id" not in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def scans(df):
    """Columns read of each table, by its first column's prefix."""
    import re
    return sorted(re.findall(r"ReadSchema: struct<([^>]*)>", plan(df)))


def test_keyed_order_queries_read_their_columns_alone(spark):
    """Only the needed columns, and no customer scan where nothing of it is used."""
    totals = ["o_orderkey:bigint,o_custkey:bigint,o_totalprice:double"]
    assert scans(QUERIES["user_orders"](spark, SF_SMALL)) == totals
    assert scans(QUERIES["user_orders_md5"](spark, SF_SMALL)) == ["o_orderkey:bigint,o_custkey:bigint"]
    adhoc = scans(QUERIES["adhoc_sql"](spark, SF_SMALL))
    assert len(adhoc) == 1 and "c_custkey" not in adhoc[0] and "o_orderpriority" not in adhoc[0]
    by_province = scans(QUERIES["user_province_orders"](spark, SF_SMALL))
    assert totals[0] in by_province and "c_custkey:bigint,c_nationkey:int" in ",".join(by_province)


def test_distinct_window_counts_spread_by_id(spark):
    """The exact distinct first shuffles on (window, id), so a busy window is
    spread over tasks, and combines partially before each exchange."""
    p = plan(jobs.orders_per_hour(fx.orders_time(spark, SF_SMALL)))
    assert p.count("Exchange hashpartitioning") == 2
    assert "partial_count" in p


def test_top1_is_an_aggregate_not_a_ranking_window(spark):
    p = plan(QUERIES["user_top1"](spark, SF_SMALL))
    assert "Window" not in p.replace("window", "")


def test_current_hour_filter_is_one_comparison(spark):
    p = plan(QUERIES["dwd_current_hour"](spark, SF_SMALL))
    assert "1998-08-02 00" in p  # the clock side is folded to a constant


BAD_NODES = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
             "ArrowEvalPython", "SinglePartition")


def test_batch_queries_stay_distributed_and_jvm_side(spark):
    """No pair-emitting join, no Python in the hot path, nothing gathered
    into one partition, in any registered batch query."""
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        p = plan(fn(spark, SF_SMALL))
        found = [n for n in BAD_NODES if n in p]
        assert not found, (name, found)


def test_cdc_fold_combines_cells_before_the_shuffle(spark):
    """The fold's cell aggregate runs partially on the map side, so a hot
    cell's updates collapse before the exchange, and the row-key window sees
    only the reduced rows."""
    from tidemark.operators import cdc
    p = plan(cdc.fold(cdc.to_ops(cdc.route(cdc.parse_changelog(fx.changelog(spark, SF_SMALL))[0],
                                           fx.flow(spark)))))
    assert "partial_max(struct(seq, struct(offset" in p
    assert p.count("Window [") == 1


def test_changelog_shuffles_an_order_once(spark):
    """The messages of all phases are made after the shuffle of the orders, not before it."""
    p = plan(fx.changelog(spark, SF_SMALL))
    assert p.index("Generate explode") < p.index("ObjectHashAggregate")


def test_names_of_a_row_image_are_lowered_once(spark):
    """The row key looks its columns up in one lowered list of names, and the wide fold's explode compares no cells."""
    from tidemark.operators import cdc
    ops = cdc.to_ops(cdc.route(cdc.parse_changelog(fx.changelog(spark, SF_SMALL))[0], fx.flow(spark)), wide=True)
    assert len(re.findall(r"transform\(map_keys\(d#\d+\), lambdafunction\(lower\(", plan(ops))) == 1
    explodes = [line for line in plan(cdc.fold(ops)).splitlines() if "Generate explode(CASE WHEN whole" in line]
    assert len(explodes) == 1 and "lambdafunction" not in explodes[0]


def test_current_hour_prefix_reaches_the_parquet_scan(spark, scratch):
    """On a stored keyed table the hour test is a pushed prefix filter."""
    fx.orders_kv(spark, SF_SMALL).write.parquet(f"{scratch}/kv")
    p = plan(jobs.dwd_current_hour(spark.read.parquet(f"{scratch}/kv"), now="1998-08-01 16:30:00"))
    assert "StringStartsWith(cf.createTime,1998-08-02 00)" in p
