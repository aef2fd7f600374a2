"""The command line runs a job end to end and ad-hoc SQL."""

from pyspark.sql import functions as F

from tidemark.cli import main
from tidemark.plans import fixtures as fx
from tidemark.plans import jobs
from tidemark.plans.registry import QUERIES
from tidemark.sources.tables import keyed_table

from compare import SF_SMALL


def test_cli_uv_job_available_now(spark, scratch):
    src = fx.behavior(spark, SF_SMALL)
    src.write.json(f"{scratch}/src")
    assert main(["uv-10min", "--source", f"{scratch}/src", "--dws", f"{scratch}/dws",
                 "--app", f"{scratch}/app", "--checkpoint", f"{scratch}/ckpt",
                 "--available-now", "--max-per-trigger", "99", "--local"]) == 0
    got = {tuple(r) for r in keyed_table(spark, f"{scratch}/app").collect()}
    batch = {tuple(r) for r in jobs.uv_10min_app(jobs.uv_10min(src)).collect()}
    assert got and got <= batch and len(batch - got) == 1


def test_cli_order_path(spark, scratch, capsys):
    """cdc-sync, dwd-extract, user-totals and sql over one and the same table folder."""
    fx.changelog(spark, SF_SMALL).write.json(f"{scratch}/log")
    fx.flow(spark).write.parquet(f"{scratch}/flow")
    assert main(["cdc-sync", "--changelog", f"{scratch}/log", "--flow", f"{scratch}/flow", "--table",
                 f"{scratch}/table", "--checkpoint", f"{scratch}/ckpt", "--available-now", "--local"]) == 0
    now = "1998-08-01 16:30:00"
    assert main(["dwd-extract", "--keyed", f"{scratch}/table", "--out", f"{scratch}/dwd", "--now", now, "--local"]) == 0
    assert main(["user-totals", "--keyed", f"{scratch}/table", "--out", f"{scratch}/totals", "--local"]) == 0
    want = QUERIES["cdc_user_orders"](spark, SF_SMALL)
    got = keyed_table(spark, f"{scratch}/totals").select("rowkey", "cf.user_id", "cf.order_num",
                                                         F.round("cf.gmv", 2).alias("gmv"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    extract = jobs.dwd_current_hour(keyed_table(spark, f"{scratch}/table"), now=now).count()
    assert spark.read.text(f"{scratch}/dwd").count() == extract
    assert main(["sql", "SELECT user_id, order_num FROM totals", "--table", f"totals={scratch}/totals",
                 "--out", f"{scratch}/result", "--local"]) == 0
    assert spark.read.parquet(f"{scratch}/result").count() == want.count()


def test_cli_sql(spark, capsys):
    """Schema first, then every row (no silent limit)."""
    assert main(["sql", "SELECT orderId FROM keyed_orders", "--data", SF_SMALL, "--local"]) == 0
    out = capsys.readouterr().out.splitlines()
    n = fx.table(spark, SF_SMALL, "orders").count()
    assert any("orderId: string" in x for x in out) and out.index("orderId") == len(out) - n - 1
    assert main(["sql", "SELECT orderId FROM keyed_orders", "--data", SF_SMALL, "--rows", "5", "--local"]) == 0
    out = capsys.readouterr().out.splitlines()
    assert out.index("orderId") == len(out) - 6


def test_kafka_options_without_a_broker():
    """Start position and consumer group of each job, as reader options."""
    from tidemark.cli import _parser, kafka_start
    from tidemark.sources.topic import kafka_options

    def options(*argv):
        return kafka_options("host:9092", "t", **kafka_start(_parser().parse_args(list(argv))), max_offsets_per_trigger=7)
    plain = ["--source", "t", "--app", "a", "--kafka", "host:9092"]
    assert options("uv-10min", *plain)["startingOffsets"] == "earliest"
    late = options("orders-per-hour", *plain, "--group", "g")
    assert late == {"kafka.bootstrap.servers": "host:9092", "subscribe": "t", "startingOffsets": "latest",
                    "kafka.group.id": "g", "maxOffsetsPerTrigger": "7"}
    assert options("orders-per-hour", *plain, "--starting", "earliest")["startingOffsets"] == "earliest"
    cdc = ["cdc-sync", "--changelog", "t", "--flow", "f", "--table", "x"]
    assert options(*cdc)["startingOffsets"] == "latest" and "kafka.group.id" not in options(*cdc)


def test_cli_shuffle_partitions_flag(spark):
    try:
        assert main(["--shuffle-partitions", "3", "sql", "SELECT 1 AS x", "--data", SF_SMALL,
                     "--local"]) == 0
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
