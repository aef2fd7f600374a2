"""Streaming: restart from checkpoint, idempotent upserts, late rows."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidemark.plans import fixtures as fx
from tidemark.plans import jobs
from tidemark.sinks.topic import append_topic
from tidemark.sinks.bucketed import BATCH
from tidemark.sinks.upsert import UpsertTable, combine, upsert_batch
from tidemark.sources.tables import keyed_table
from tidemark.sources.topic import json_topic
from tidemark.streaming import jobs as sj
from tidemark.streaming.event_time import with_event_time
from tidemark.streaming.replay import AVAILABLE_NOW, Replay, by_range, by_time, wait

from compare import SF_SMALL


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def _hourly_batch(spark):
    o = fx.orders_time(spark, SF_SMALL)
    return {tuple(r) for r in jobs.orders_per_hour_app(jobs.orders_per_hour(o)).collect()}


def test_restart_between_batches_gives_same_table(spark, scratch):
    """Stop after the first half of the input, restart from the checkpoint
    with the rest: the APP table equals the batch result for closed windows."""
    job = sj.ORDERS_PER_HOUR
    src = fx.orders_time(spark, SF_SMALL)
    halves = list(by_time(src, "createTime", 2))

    def run_once(stream):
        wait(sj.start_dws(job, stream, f"{scratch}/dws", f"{scratch}/ckpt", AVAILABLE_NOW))
        wait(sj.start_app(spark, f"{scratch}/dws", job.dws_schema, job.app, job.app_keys,
                          f"{scratch}/app", f"{scratch}/ckpt/app", AVAILABLE_NOW))

    run_once(halves[0])
    first = {tuple(r) for r in keyed_table(spark, f"{scratch}/app").collect()}
    run_once(halves[1])
    final = {tuple(r) for r in keyed_table(spark, f"{scratch}/app").select(*job.app_keys, "buy_cnt").collect()}

    batch = _hourly_batch(spark)
    assert first and first < final
    assert final <= batch
    assert len(batch - final) == 1  # only the last hour is still open
    dws_rows = spark.read.json(f"{scratch}/dws").count()
    assert dws_rows == len(final)  # each window emitted exactly once


def test_upsert_replay_is_idempotent(spark, scratch):
    path = f"{scratch}/t"
    b0 = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v bigint")
    b1 = spark.createDataFrame([("b", 5), ("c", 3)], "k string, v bigint")
    upsert_batch(spark, b0, 0, ["k"], path)
    upsert_batch(spark, b1, 1, ["k"], path)
    once = sorted(tuple(r) for r in keyed_table(spark, path).collect())
    upsert_batch(spark, b1, 1, ["k"], path)  # the same batch replayed after a failure
    twice = sorted(tuple(r) for r in keyed_table(spark, path).collect())
    assert once == twice == [("a", 1), ("b", 5), ("c", 3)]
    assert {p[2] for p in UpsertTable(spark, path).partitions()} == {0, 1}


def test_upsert_folds_keep_the_table(spark, scratch):
    """Many small batches with a fold every 3: only the latest row per key
    survives, and the files that a fold has read are gone."""
    path = f"{scratch}/t"
    for i in range(8):
        b = spark.createDataFrame([(f"k{i % 3}", i), (f"n{i}", -i)], "k string, v bigint")
        upsert_batch(spark, b, i, ["k"], path, fold_every=3)
    t = UpsertTable(spark, path)
    want = [("k0", 6), ("k1", 7), ("k2", 5)] + [(f"n{i}", -i) for i in range(8)]
    assert sorted(tuple(r) for r in t.current().collect()) == sorted(want)
    assert sorted({p[2] for p in t.partitions()}) == [5, 6, 7]  # batches 0 to 5 are one partition


def test_replay_after_a_fold(spark, scratch):
    """The batch that comes after a fold may be replayed; the folded one has finished."""
    path = f"{scratch}/t"
    batches = [spark.createDataFrame([("a", i), (f"b{i}", i)], "k string, v bigint") for i in range(5)]
    for i in (0, 1, 2, 3, 4, 4):
        upsert_batch(spark, batches[i], i, ["k"], path, fold_every=2)
    assert sorted(tuple(r) for r in keyed_table(spark, path).collect()) == \
        sorted([("a", 4)] + [(f"b{i}", i) for i in range(5)])


def test_a_replay_may_write_other_rows(spark, scratch, monkeypatch):
    """What the first attempt of a batch wrote to other buckets does not stay."""
    from tidemark.sinks import bucketed
    path = f"{scratch}/t"
    monkeypatch.setattr(bucketed, "BUCKET_BYTES", 2000)
    upsert_batch(spark, spark.range(500).selectExpr("id AS k", "id AS v"), 0, ["k"], path)
    UpsertTable(spark, path).fold_batches(0)
    upsert_batch(spark, spark.range(500, 540).selectExpr("id AS k", "id AS v"), 1, ["k"], path)
    upsert_batch(spark, spark.range(600, 601).selectExpr("id AS k", "id AS v"), 1, ["k"], path)
    assert len({p[1] for p in UpsertTable(spark, path).partitions()}) > 1
    assert sorted(r["k"] for r in keyed_table(spark, path).collect()) == [*range(500), 600]


def test_a_fold_that_did_not_delete(spark, scratch, monkeypatch):
    """A crash between a fold's write and its deletes: the next fold finds the same rows."""
    from tidemark.sinks import bucketed
    path = f"{scratch}/t"
    with monkeypatch.context() as m:
        m.setattr(bucketed, "delete_path", lambda *a: None)
        for i in range(5):
            upsert_batch(spark, spark.createDataFrame([("a", i), (f"b{i}", i)], "k string, v bigint"), i, ["k"], path,
                         fold_every=2)
    want = sorted([("a", 4)] + [(f"b{i}", i) for i in range(5)])
    assert sorted(tuple(r) for r in keyed_table(spark, path).collect()) == want
    UpsertTable(spark, path).fold_batches(4)
    assert sorted(tuple(r) for r in keyed_table(spark, path).collect()) == want
    assert {p[2] for p in UpsertTable(spark, path).partitions()} == {4}


def test_folds_leave_untouched_buckets_alone_and_split_large_ones(spark, scratch, monkeypatch):
    """Buckets grow in number with the table; a batch of one key makes only its bucket's files new."""
    from tidemark.sinks import bucketed
    path = f"{scratch}/t"
    many = spark.createDataFrame([(f"k{i}", i) for i in range(2000)], "k string, v bigint")
    monkeypatch.setattr(bucketed, "BUCKET_BYTES", 4000)
    upsert_batch(spark, many, 0, ["k"], path)
    t = UpsertTable(spark, path)
    assert {p[:2] for p in t.partitions()} == {(1, 0)}
    t.fold_batches(0)
    before = t.partitions()
    of = before[0][0]
    assert of > 4 and len(before) == of and {p[0] for p in before} == {of}
    monkeypatch.setattr(bucketed, "BUCKET_BYTES", 1 << 30)
    upsert_batch(spark, spark.createDataFrame([("k7", -1)], "k string, v bigint"), 1, ["k"], path)
    t.fold_batches(1)
    after = t.partitions()
    assert len(set(before) - set(after)) == 1 and [p[2] for p in set(after) - set(before)] == [1]
    want = sorted((f"k{i}", -1 if i == 7 else i) for i in range(2000))
    assert sorted(tuple(r) for r in keyed_table(spark, path).collect()) == want


def test_writes_have_more_tasks_than_buckets(spark, scratch):
    """One bucket, written by many tasks: rows are dealt by bucket and slice of the key hash."""
    t = UpsertTable(spark, f"{scratch}/t", ["id"])
    rows = spark.range(10_000).withColumn("batch", F.lit(0).cast("long"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = t._spread(rows, 1)
        tasks = spread.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert spread.select("bucket").distinct().count() == 1


def test_old_tombstones_are_purged(spark, scratch):
    """A delete is forgotten once no older change can be replayed; the table stays the same."""
    from tidemark.sinks.keyed_state import KeyedStateTable
    schema = "hbaseTable string, rowkey string, offset bigint, pos int, kind int, family string, qualifier string, value string"
    table = KeyedStateTable(spark, f"{scratch}/t", fold_every=2)
    put = lambda key, at: ("h", key, at, 0, 1, "cf", "q", f"v{at}")
    gone = lambda key, at: ("h", key, at, 0, 0, None, None, None)
    for i, ops in enumerate([[put("a", 0), put("b", 1)], [gone("a", 2), put("b", 3)],
                             [put("c", 4)], [put("c", 5), put("a", 6), gone("c", 7)], [put("d", 8)]]):
        table.apply_batch(spark.createDataFrame(ops, schema), i)
    assert sorted((r.rowkey, r.value) for r in table.cells().collect()) == [("a", "v6"), ("b", "v3"), ("d", "v8")]
    deletes = lambda: [(r.rowkey, r.offset) for r in table.state().collect() if r.kind == 0]
    assert deletes() == [("c", 7)]
    table.fold_batches(4)  # the delete now stands in the oldest files
    assert deletes() == [] and {r.rowkey for r in table.cells().collect()} == {"a", "b", "d"}


def test_combine_duplicate_keys_in_batch(spark):
    rows = spark.createDataFrame([("a", 4, 1), ("a", 9, 1), ("b", 1, 1), ("a", 2, 0)],
                                 f"k string, v bigint, {BATCH} bigint")
    got = sorted((r.k, r.v) for r in combine(rows, ["k"]).collect())
    assert got == [("a", 9), ("b", 1)]


def test_late_rows_are_dropped(spark, scratch):
    """A row older than watermark (max event time - 5 s) for a closed window is dropped."""
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows1 = [(1, 1, "p", 1.0, t0 + dt.timedelta(minutes=m)) for m in (1, 59)]
    rows2 = [(2, 1, "p", 1.0, t0 + dt.timedelta(hours=2))]
    rows3 = [(4, 1, "p", 1.0, t0 + dt.timedelta(hours=2, minutes=30))]
    late = [(3, 1, "p", 1.0, t0 + dt.timedelta(minutes=30))]  # hour 00 closed a batch ago
    schema = "orderId bigint, userId bigint, province string, realTotalMoney double, createTime timestamp_ntz"
    # The watermark moves once per micro-batch, so a row is late only for a
    # window closed in an earlier batch (one file per batch here).
    data = [(*r, i) for i, rows in enumerate([rows1, rows2, rows3, late]) for r in rows]
    df = spark.createDataFrame(data, schema + ", part int")
    queries = []

    def start(stream):
        dws = jobs.orders_per_hour(with_event_time(stream, "createTime"))
        queries.append(append_topic(dws, f"{scratch}/dws", f"{scratch}/ckpt", AVAILABLE_NOW))
        return queries[-1]

    Replay(df, F.col("part"), 4).run(start)
    q = queries[-1]
    got = {tuple(r) for r in spark.read.json(f"{scratch}/dws").select("day_hour_time", "order_num").collect()}
    assert got == {("2024-01-01 00", 1)}
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped >= 1


def test_cdc_sync_restart_and_replay(spark, scratch):
    """Sync half the changelog, stop, resume with the rest: the keyed state
    equals one batch fold of the whole log; re-applying a batch changes nothing."""
    from tidemark.operators import cdc
    from tidemark.sinks.keyed_state import KeyedStateTable
    from tidemark.streaming.cdc_apply import start_cdc_sync

    log = fx.changelog(spark, SF_SMALL)
    flow = fx.flow(spark)
    part = F.least(F.floor(F.col("offset") / fx.PHASE_STRIDE), F.lit(4))
    Replay(log, part, 5).run(lambda stream: start_cdc_sync(
        spark, stream, lambda: flow, f"{scratch}/table", f"{scratch}/ckpt", AVAILABLE_NOW, fold_every=2))
    table = KeyedStateTable(spark, f"{scratch}/table", fold_every=2)
    assert {p[2] for p in table.partitions()} == {3, 4}  # batches 0 to 3 have been folded

    def cells(df):
        return sorted(tuple(r) for r in df.select("rowkey", "qualifier", "value").collect())

    msgs, _ = cdc.parse_changelog(log)
    want = cells(cdc.live_cells(cdc.fold(cdc.to_ops(cdc.route(msgs, flow)))))
    assert cells(table.cells()) == want

    # Re-deliver the last batch's ops (at-least-once): same state.
    last = table.next_batch_id() - 1
    rows = table.stored().filter(F.col(BATCH) == last).select(*table.schema.names)
    again = spark.createDataFrame(rows.collect(), table.schema)
    table.apply_batch(again, last)
    assert cells(table.cells()) == want


def test_window_job_runs_both_queries_concurrently(spark, scratch):
    """The production runner: DWS and APP queries started together on
    processing-time triggers, fed while running, stopped after draining."""
    src = fx.behavior(spark, SF_SMALL)
    src.repartitionByRange(2, "ts").sortWithinPartitions("ts").write.json(f"{scratch}/src")
    stream = json_topic(spark, f"{scratch}/src", src.schema)
    q1, q2 = sj.start_window_job(spark, sj.UV_10MIN, stream, f"{scratch}/dws", f"{scratch}/app",
                                 f"{scratch}/ckpt", {"processingTime": "1 second"}, "uv_test")
    try:
        q1.processAllAvailable()
        q2.processAllAvailable()
        q1.processAllAvailable()
        q2.processAllAvailable()
        assert q1.isActive and q2.isActive
    finally:
        q1.stop()
        q2.stop()
    got = {tuple(r) for r in keyed_table(spark, f"{scratch}/app").collect()}
    batch = {tuple(r) for r in jobs.uv_10min_app(jobs.uv_10min(src)).collect()}
    assert got and got <= batch
    assert len(batch - got) == 1  # the last window is still open


def test_streaming_two_level_distinct_equals_batch(spark, scratch):
    """Null ids are not counted but their money is summed; duplicates count once."""
    t0 = dt.datetime(2024, 3, 1, 10, 0, 0)
    rows = [(1, 7, "p", 1.5, t0), (1, 7, "p", 1.5, t0 + dt.timedelta(minutes=5)),
            (None, 7, "p", 2.25, t0 + dt.timedelta(minutes=6)), (2, 7, "q", 4.0, t0),
            (3, 8, "p", 0.5, t0 + dt.timedelta(minutes=59)),
            (9, 9, "z", 1.0, t0 + dt.timedelta(hours=3))]  # closes the 10:00 windows
    schema = "orderId bigint, userId bigint, province string, realTotalMoney double, createTime timestamp_ntz"
    df = spark.createDataFrame(rows, schema)
    by_time(df, "createTime", 2).run(lambda stream: append_topic(
        jobs.user_province_hour(with_event_time(stream, "createTime")), f"{scratch}/dws", f"{scratch}/ckpt",
        AVAILABLE_NOW))
    got = sorted(tuple(r) for r in spark.read.schema(sj.USER_PROVINCE_HOUR.dws_schema)
                 .json(f"{scratch}/dws").collect())
    want = sorted(tuple(r) for r in jobs.user_province_hour(df).collect() if r.userId != 9)
    assert got == want
    assert (7, "p", 10, 1, 5.25) in got


def test_replay_slices_cover_every_row_once(spark):
    """Slices are ranges of the time column in order, nulls first, and hold all rows."""
    src = fx.orders_time(spark, SF_SMALL)
    src = src.unionByName(src.limit(3).withColumn("createTime", F.lit(None).cast("timestamp_ntz")))
    cut = src.select("createTime", by_range(src, "createTime", 4).alias("s"))
    got = cut.groupBy("s").agg(F.min("createTime").alias("low"), F.max("createTime").alias("high"),
                               F.count(F.lit(1)).alias("n")).orderBy("s").collect()
    assert [r.s for r in got] == [0, 1, 2, 3] and sum(r.n for r in got) == src.count()
    assert all(a.high < b.low for a, b in zip(got, got[1:]))


def test_replay_on_the_cluster_state_store(spark, scratch):
    """The cluster profile's RocksDB state store (changelog checkpointing)
    gives the same closed windows as batch."""
    from tidemark.session import CLUSTER_CONF
    from tidemark.streaming.replay import replay_window_job
    keys = [k for k in CLUSTER_CONF if k.startswith("spark.sql.streaming.stateStore.")]
    assert len(keys) == 3
    src = fx.orders_time(spark, SF_SMALL)
    for k in keys:
        spark.conf.set(k, CLUSTER_CONF[k])
    try:
        q = replay_window_job(spark, sj.ORDERS_PER_HOUR, src, 3, root=f"{scratch}/replay")
        got = {tuple(r) for r in q.collect()}
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert "RocksDBStateStoreProvider" in _first_offset_log(spark, f"{scratch}/replay/ckpt/dws")
    batch = {tuple(r) for r in jobs.orders_per_hour_app(jobs.orders_per_hour(src)).collect()}
    assert got and got <= batch and len(batch - got) == 1


def _first_offset_log(spark, checkpoint):
    """A query's first offset log entry (it records the session's state store
    provider)."""
    return "\n".join(r.value for r in spark.read.text(f"{checkpoint}/offsets/0").collect())


def _changes(*rows):
    """Changelog records (partition, offset, database, table, data) as JSON text."""
    return [(p, o, json.dumps({"database": d, "table": t, "type": "INSERT", "data": [x]})) for p, o, d, t, x in rows]


def _flow(spark, *tables):
    return spark.createDataFrame([(i + 1, 1, "d", t, f"h:{t}", "cf", False, 10, "id", 2) for i, t in enumerate(tables)],
                                 fx.FLOW_SCHEMA)


def _sync(spark, scratch, batches, loader, **options):
    """One micro-batch after the other through the sync's batch writer."""
    from tidemark.sinks.keyed_state import KeyedStateTable
    from tidemark.sources.tables import CachedTable
    from tidemark.streaming.cdc_apply import RoutingState, changelog_batch_writer
    table = KeyedStateTable(spark, f"{scratch}/table")
    write = changelog_batch_writer(table, RoutingState(spark, f"{scratch}/routing", CachedTable(loader, 0.0)))
    for i, rows in batches:
        write(spark.createDataFrame(rows, "partition int, offset bigint, value string"), i)
    return table


def test_tables_without_a_flow_may_come_from_anywhere(spark, scratch):
    """Only configured tables need one topic partition; others are dropped, and counted."""
    import pytest
    from tidemark.streaming.cdc_apply import cdc_progress
    rows = _changes((0, 0, "d", "other", {"id": "1"}), (1, 1, "d", "other", {"id": "2"}), (1, 2, "d", "t", {"id": "3"}),
                    (1, 3, "d", "t", {"no": "4"})) + [(0, 4, "no json")]
    table = _sync(spark, scratch, [(0, rows)], lambda: _flow(spark, "t"))
    assert {(r.hbaseTable, r.value) for r in table.cells().collect()} == {("h:t", "3")}
    assert [tuple(r) for r in cdc_progress(spark, table.path).collect()] == [(0, 5, 1, 2, 2)]
    with pytest.raises(ValueError, match="more than one topic partition"):
        _sync(spark, scratch, [(1, _changes((0, 5, "d", "t", {"id": "5"})))], lambda: _flow(spark, "t"))


def test_a_batch_keeps_its_routing(spark, scratch):
    """A replayed batch is routed as it first was, also by a new process; configs are only ever put."""
    now = ["a"]
    loader = lambda: _flow(spark, *now)
    first = _changes((0, 0, "d", "a", {"id": "1"}), (0, 1, "d", "b", {"id": "1"}))
    second = _changes((0, 2, "d", "a", {"id": "2"}), (0, 3, "d", "b", {"id": "2"}))
    table = _sync(spark, scratch, [(0, first)], loader)
    now[:] = ["b"]  # a disappears from the config, b appears
    _sync(spark, scratch, [(0, first), (1, second)], loader)
    now[:] = []
    _sync(spark, scratch, [(1, second)], loader)
    assert sorted((r.hbaseTable, r.value) for r in table.cells().collect()) == [("h:a", "1"), ("h:a", "2"), ("h:b", "2")]


def test_user_totals_agree_after_every_batch(spark, scratch):
    """Count and sum of a user come from the same batches, as of each of them."""
    rows = [(i % 7 if i % 5 else None, i % 3, float(i), i % 4) for i in range(60)]
    df = spark.createDataFrame(rows, "orderId long, userId long, realTotalMoney double, part int")
    Replay(df, F.col("part"), 4).run(lambda s: sj.start_user_totals_stream(
        spark, s, f"{scratch}/t", f"{scratch}/ckpt", AVAILABLE_NOW))
    for batch in range(4):
        got = {r["userId"]: (r["order_num"], r["gmv"]) for r in sj.read_user_totals(spark, f"{scratch}/t", batch).collect()}
        some = [r for r in rows if r[3] <= batch]
        assert got == {u: (len({r[0] for r in some if r[1] == u and r[0] is not None}),
                           sum(r[2] for r in some if r[1] == u)) for u in {r[1] for r in some}}


def test_a_dealt_replay_makes_each_row_once(spark, scratch):
    """Rows that lie over all tasks already are written where they are; more slices are ranged, and hold the same rows."""
    from pyspark.sql import functions as F
    from tidemark.streaming.replay import DIRECT, Replay
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b
    df = spark.range(300).repartition(4, "id").mapInArrow(seen, "id bigint")
    Replay(df, F.col("id") % 3, 3, f"{scratch}/few", dealt=True)
    assert made.value == 300
    Replay(df, F.col("id") % (DIRECT + 1), DIRECT + 1, f"{scratch}/many", dealt=True)
    for n, name in ((3, "few"), (DIRECT + 1, "many")):
        rows = spark.read.parquet(f"{scratch}/{name}/src").select("id", F.col("_slice").cast("int")).collect()
        assert sorted(map(tuple, rows)) == [(i, i % n) for i in range(300)]
