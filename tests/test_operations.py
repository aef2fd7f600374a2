"""Running jobs: dropped rows, supervision, start and size of micro-batches, lookups by key, inserts in SQL."""

import pytest
from pyspark.sql import functions as F

from compare import SF_SMALL
from tidemark import schemas
from tidemark.plans import fixtures as fx
from tidemark.plans import jobs
from tidemark.sinks.topic import append_topic
from tidemark.sources.tables import KeyedLookup
from tidemark.sources.topic import json_topic, kafka_options
from tidemark.sql import run_script
from tidemark.streaming import jobs as sj
from tidemark.streaming.progress import ProgressTable, dropped_rows, progress, supervise
from tidemark.streaming.replay import AVAILABLE_NOW, Replay, wait


def _range_job(spark, at, fail=lambda row: None, name="range"):
    """A job that appends the ids of a topic, or fails."""
    def write(batch, batch_id):
        fail(batch_id)
        batch.write.mode("overwrite").json(f"{at}/out/batch={batch_id}")
    stream = json_topic(spark, f"{at}/in", "id long", max_files_per_trigger=1)
    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{at}/ckpt-{name}").queryName(name)
            .trigger(**AVAILABLE_NOW).start())


def _topic(spark, at, files=4):
    spark.range(40).repartition(files).write.mode("append").json(f"{at}/in")


def test_progress_has_a_row_for_each_batch(spark, scratch):
    _topic(spark, scratch)
    with ProgressTable(spark, f"{scratch}/progress") as seen:
        seen.wait(_range_job(spark, scratch))
    rows = progress(spark, f"{scratch}/progress").collect()
    assert sorted(r["batch"] for r in rows) == [0, 1, 2, 3] and sum(r["input_rows"] for r in rows) == 40
    assert [tuple(r) for r in dropped_rows(spark, f"{scratch}/progress").collect()] == [("range", 0)]


def test_a_failing_insert_takes_its_siblings_along(spark, scratch):
    """One of two queries fails once: both start again, and both results are whole."""
    fails = [1]

    def once(batch_id):
        if batch_id == 2 and fails:
            fails.pop()
            raise ValueError("lost")

    for name in ("a", "b"):
        _topic(spark, f"{scratch}/{name}")
    starts = []

    def start():
        starts.append(1)
        return [_range_job(spark, f"{scratch}/a", once, "a"), _range_job(spark, f"{scratch}/b", name="b")]

    assert supervise(spark, start, pause_s=0.0) == 1 and len(starts) == 2
    for name in ("a", "b"):
        ids = [r["id"] for r in spark.read.schema("id long").json(f"{scratch}/{name}/out").collect()]
        assert sorted(ids) == list(range(40))
    assert not spark.streams.active


def test_supervision_gives_up(spark, scratch):
    _topic(spark, scratch)

    def always(batch_id):
        raise ValueError("broken for good")

    with pytest.raises(RuntimeError, match="after 1 restarts"):
        supervise(spark, lambda: [_range_job(spark, scratch, always)], restarts=1, pause_s=0.0)
    started = []

    def half():
        started.append(_range_job(spark, scratch, name="left"))
        raise ValueError("the second does not start")

    with pytest.raises(RuntimeError, match="does not start"):
        supervise(spark, half, restarts=0)
    assert not spark.streams.active


def test_a_supervised_window_job_equals_batch(spark, scratch):
    """The DWS query fails in its first run; the APP table of the job is the batch result in the end."""
    src = fx.behavior(spark, SF_SMALL)
    append_topic(src.withColumn("ts", F.col("ts").cast("timestamp")), f"{scratch}/in")
    broken = [1]

    def start():
        stream = json_topic(spark, f"{scratch}/in", schemas.USER_BEHAVIOR)
        if broken:
            broken.pop()
            stream = stream.withColumn("user_id", F.when(F.col("user_id") < 0, F.col("user_id"))
                                       .otherwise(F.raise_error(F.lit("lost")).cast("long")))
        return sj.start_window_job(spark, sj.UV_10MIN, stream, f"{scratch}/dws", f"{scratch}/app", f"{scratch}/ckpt",
                                   AVAILABLE_NOW)

    assert supervise(spark, start, pause_s=0.0) == 1
    wait(sj.start_app(spark, f"{scratch}/dws", sj.UV_10MIN.dws_schema, sj.UV_10MIN.app, sj.UV_10MIN.app_keys,
                      f"{scratch}/app", f"{scratch}/ckpt/app", AVAILABLE_NOW))
    from tidemark.sources.tables import keyed_table
    got = {tuple(r) for r in keyed_table(spark, f"{scratch}/app").collect()}
    batch = {tuple(r) for r in jobs.uv_10min_app(jobs.uv_10min(src)).collect()}
    assert got < batch and len(batch - got) == 1  # the last window is still open


def test_latest_start_survives_a_restart(spark, scratch):
    """The point is kept with the checkpoint: files that came between two runs are read."""
    spark.range(0, 5).write.json(f"{scratch}/in")

    def run(ckpt):
        stream = json_topic(spark, f"{scratch}/in", "id long", starting="latest", checkpoint=f"{scratch}/{ckpt}")
        wait(append_topic(stream, f"{scratch}/out-{ckpt}", f"{scratch}/{ckpt}", AVAILABLE_NOW))
        return sorted(r["id"] for r in spark.read.schema("id long").json(f"{scratch}/out-{ckpt}").collect())

    assert run("a") == []
    spark.range(5, 8).write.mode("append").json(f"{scratch}/in")
    assert run("a") == [5, 6, 7] and run("b") == []
    spark.range(8, 9).write.mode("append").json(f"{scratch}/in")
    assert run("a") == [5, 6, 7, 8] and run("b") == [8]
    with pytest.raises(ValueError):
        json_topic(spark, f"{scratch}/in", "id long", starting="latest")


def test_bytes_of_a_micro_batch(spark, scratch):
    """Each file is larger than the bound: one file a batch; a large bound takes all at once."""
    _topic(spark, scratch, 3)
    for bound, batches in ((1, 3), (1 << 30, 1)):
        stream = json_topic(spark, f"{scratch}/in", "id long", max_bytes_per_trigger=bound)
        sizes = []
        q = (stream.writeStream.foreachBatch(lambda b, i: sizes.append(b.count()))  # noqa: B023
             .option("checkpointLocation", f"{scratch}/ckpt-{bound}").trigger(**AVAILABLE_NOW).start())
        wait(q)
        assert len(sizes) == batches and sum(sizes) == 40


def test_kafka_batch_bounds():
    from tidemark.cli import _parser, kafka_bounds
    args = _parser().parse_args(["uv-10min", "--source", "t", "--app", "a", "--kafka", "h:1", "--max-per-trigger", "9",
                                 "--min-per-trigger", "5", "--max-delay", "2s"])
    got = kafka_options("h:1", "t", **kafka_bounds(args))
    assert (got["maxOffsetsPerTrigger"], got["minOffsetsPerTrigger"], got["maxTriggerDelay"]) == ("9", "5", "2s")


def test_lookup_asks_for_the_keys_of_a_batch_only(spark, scratch):
    """The keys reach the scan; known ones are not asked for again until they are old."""
    spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).write.parquet(f"{scratch}/dim")
    loads = []

    def load():
        loads.append(1)
        return spark.read.parquet(f"{scratch}/dim")

    look = KeyedLookup(load, "k", max_keys=4)
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "id long")
    plan = look.asked([3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(k, [3,5])]" in plan
    loads.clear()
    assert sorted(tuple(r) for r in look.rows_for(keys(3, 5, 3, None, -1)).collect()) == [(3, 6), (5, 10)]
    assert set(look.kept) == {3, 5, -1}  # that -1 is missing is known too
    asked = []
    look.asked = lambda k, asked_of=look.asked: asked.append(sorted(k)) or asked_of(k)
    assert sorted(tuple(r) for r in look.rows_for(keys(5, 7, -1)).collect()) == [(5, 10), (7, 14)]
    assert asked == [[7]]
    look.rows_for(keys(8, 9))
    assert len(look.kept) == 4
    assert look.rows_for(keys(*range(10))).count() == 100_000  # too many keys: the whole dimension is joined
    young = KeyedLookup(load, "k", max_age_s=0.0)
    loads.clear()
    young.rows_for(keys(1))
    young.rows_for(keys(1))
    assert len(loads) == 2


def test_a_failed_insert_leaves_nothing(spark, scratch):
    """A task that fails fails the statement; what it wrote is not in the topic, and the next insert is there once."""
    from tidemark.sinks.files import ensure_dir
    ensure_dir(spark, f"{scratch}/t")
    view = f"CREATE OR REPLACE TEMPORARY VIEW ins_t (id BIGINT) USING json OPTIONS (path '{scratch}/t')"
    insert = "INSERT INTO ins_t SELECT {} FROM range(0, 1000, 1, 4)"
    with pytest.raises(Exception, match="lost"):
        run_script(spark, f"{view}; {insert.format('if(id = 999, bigint(raise_error(\'lost\')), id)')}")
    assert run_script(spark, f"{view}; {insert.format('id')}; SELECT count(*) AS n, sum(id) AS s FROM ins_t").first() == \
        (1000, 499500)


def test_replayed_config_change_equals_one_run(spark, scratch):
    """Dropped and kept records of the config change, batch by batch."""
    from tidemark.plans.registry import _customers_and_suppliers
    from tidemark.streaming.cdc_apply import cdc_progress, start_cdc_sync
    log = _customers_and_suppliers(spark, SF_SMALL, 2)
    flow = spark.createDataFrame([(1, 1, "test", "supplier", "h", "cf", False, 10, "s_suppkey", 2)], fx.FLOW_SCHEMA)
    Replay(log.drop("part"), F.floor(F.col("offset") / fx.PHASE_STRIDE), 2).run(lambda s: start_cdc_sync(
        spark, s, lambda: flow, f"{scratch}/t", f"{scratch}/ckpt", AVAILABLE_NOW))
    got = cdc_progress(spark, f"{scratch}/t").agg(F.sum("read"), F.sum("kept"), F.sum("dropped"), F.sum("rejected")).first()
    suppliers, customers = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet").count() for t in ("supplier", "customer"))
    assert tuple(got) == (suppliers + customers, suppliers, customers, 0)


def test_print_rows(spark, scratch, capsys):
    """Every row of a batch is printed; a stream runs into the console sink."""
    from tidemark.sinks.topic import print_rows
    print_rows(spark.range(3))
    assert capsys.readouterr().out.splitlines() == ["Row(id=0)", "Row(id=1)", "Row(id=2)"]
    _topic(spark, scratch, 1)
    query = print_rows(json_topic(spark, f"{scratch}/in", "id long"), AVAILABLE_NOW)
    wait(query)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 40
