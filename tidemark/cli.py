"""Command line: one sub-command per warehouse job, plus ad-hoc SQL.

    python -m tidemark orders-per-hour --source DIR --dws DIR --app DIR --checkpoint DIR
    python -m tidemark cdc-sync --changelog DIR --flow PARQUET --table DIR --checkpoint DIR
    python -m tidemark sql "SELECT .." --table orders=DIR --out DIR

Sources are JSON-lines topic directories (or Kafka with ``--kafka``); small
tables are Parquet, a table a job wrote, or ``jdbc:<url>#<table>``;
checkpoints default to a folder under ``spark.checkpoint.dir``.  Every job
runs until stopped; ``--available-now`` processes what is there and exits.
"""

from __future__ import annotations

import argparse
import sys
from contextlib import nullcontext

from tidemark.session import get_session, input_bytes, scratch_path, shuffle_partitions_for

# Where a Kafka job starts without a checkpoint: fixed settings of the source jobs.
STARTING = {"uv-10min": "earliest", "category-counts": "earliest"}

WINDOW_JOBS = {
    "orders-per-hour": ("ORDERS_PER_HOUR", "orders"),
    "orders-per-minute": ("ORDERS_PER_MINUTE", "orders"),
    "user-province-hour": ("USER_PROVINCE_HOUR", "orders"),
    "uv-10min": ("UV_10MIN", "behavior"),
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--shuffle-partitions", type=int,
                   help="shuffle partitions; for a streaming job this is also its number of "
                        "state partitions, fixed when its checkpoint is first created "
                        "(default: sized from the input for batch jobs on a cluster)")
    sub = p.add_subparsers(dest="job", required=True)

    def common(sp):
        sp.add_argument("--checkpoint", help="checkpoint folder (default: under spark.checkpoint.dir)")
        sp.add_argument("--trigger", default="5 seconds", help="processing-time trigger interval")
        sp.add_argument("--available-now", action="store_true", help="process what is there, then stop")
        sp.add_argument("--kafka", help="bootstrap servers: read the source from Kafka instead of files")
        sp.add_argument("--starting", choices=["earliest", "latest"],
                        help="where the source is read from without a checkpoint (Kafka: earliest for "
                             "uv-10min and category-counts, latest for all others; files: earliest)")
        sp.add_argument("--group", help="Kafka consumer group")
        sp.add_argument("--local", action="store_true", help="local[*] session with local defaults")
        sp.add_argument("--max-per-trigger", type=int,
                        help="bound on one micro-batch: Kafka offsets (maxOffsetsPerTrigger) "
                             "or topic files (maxFilesPerTrigger); keeps a backlog from "
                             "arriving as one batch")
        sp.add_argument("--max-bytes-per-trigger", type=int, help="bound on the bytes of topic files in one micro-batch")
        sp.add_argument("--min-per-trigger", type=int, help="Kafka: records that a micro-batch waits for")
        sp.add_argument("--max-delay", help="Kafka: how long it waits for them at most, such as '2s'")
        sp.add_argument("--progress", help="folder for a row per micro-batch: rows read, rows dropped as late")
        sp.add_argument("--restarts", type=int, default=3, help="how often a failed job is started again")

    for name in WINDOW_JOBS:
        sp = sub.add_parser(name)
        sp.add_argument("--source", required=True, help="topic directory (or Kafka topic with --kafka)")
        sp.add_argument("--dws", help="DWS topic directory")
        sp.add_argument("--dws-topic", help="DWS topic in Kafka instead (with --kafka)")
        sp.add_argument("--app", required=True)
        common(sp)
    for name, text in (("item-counts", "behaviour topic"), ("user-totals-stream", "typed order topic"),
                       ("user-top1", "DWS topic of user-province-hour")):
        sp = sub.add_parser(name)
        sp.add_argument("--source", required=True, help=text)
        sp.add_argument("--out", required=True, help="upserted table")
        common(sp)
    sp = sub.add_parser("category-counts")
    sp.add_argument("--source", required=True)
    sp.add_argument("--dim", required=True, help="category dimension")
    sp.add_argument("--dim-age", type=float, default=600.0, help="seconds after which it is read again")
    sp.add_argument("--dws", required=True)
    sp.add_argument("--app", required=True)
    common(sp)
    sp = sub.add_parser("cdc-sync")
    sp.add_argument("--changelog", required=True, help="topic of partition, offset, value records")
    sp.add_argument("--flow", required=True, help="routing config table")
    sp.add_argument("--table", required=True)
    sp.add_argument("--fold-every", type=int, default=10, help="batches between folds of the table's files")
    common(sp)
    sp = sub.add_parser("dwd-extract")
    sp.add_argument("--keyed", required=True, help="keyed order table")
    sp.add_argument("--out", required=True, help="DWD topic directory")
    sp.add_argument("--now", help="clock for the current hour (default: now)")
    sp.add_argument("--local", action="store_true")
    sp = sub.add_parser("user-totals")
    sp.add_argument("--keyed", required=True)
    sp.add_argument("--out", required=True)
    sp.add_argument("--local", action="store_true")
    sp = sub.add_parser("sql")
    sp.add_argument("query")
    sp.add_argument("--data", help="folder of the source tables (registers the warehouse views)")
    sp.add_argument("--table", action="append", default=[], metavar="NAME=PLACE",
                    help="register any table a job wrote; a JSON topic is NAME=PATH::SCHEMA")
    sp.add_argument("--out", help="write the whole result there as Parquet instead of printing it")
    sp.add_argument("--rows", type=int, help="print at most this many rows (default: all)")
    sp.add_argument("--local", action="store_true")
    return p


def kafka_start(args) -> dict:
    """Start position and consumer group of a job's Kafka source."""
    return {"starting": args.starting or STARTING.get(args.job, "latest"), "group_id": args.group}


def _tables(given: list[str]) -> dict:
    """``NAME=PLACE`` and ``NAME=PATH::SCHEMA`` arguments as ``sources.tables.register`` takes them."""
    out = {}
    for item in given:
        name, _, place = item.partition("=")
        path, found, schema = place.partition("::")
        out[name] = (schema, path) if found else place
    return out


def _print_all(df, limit: int | None) -> None:
    """Every row as it is read, partition by partition."""
    print("\t".join(df.columns))
    for row in (df.limit(limit) if limit is not None else df).toLocalIterator():
        print("\t".join("NULL" if v is None else str(v) for v in row))


def kafka_bounds(args) -> dict:
    """Size and delay of a job's micro-batches on Kafka."""
    return {"max_offsets_per_trigger": args.max_per_trigger, "min_offsets_per_trigger": args.min_per_trigger,
            "max_trigger_delay": args.max_delay}


def file_options(args, ckpt: str) -> dict:
    """Start and bounds of a job's micro-batches on a file topic."""
    return {"starting": args.starting or "earliest", "checkpoint": ckpt,
            "max_files_per_trigger": args.max_per_trigger, "max_bytes_per_trigger": args.max_bytes_per_trigger}


def _source(spark, args, schema: str, ckpt: str):
    from tidemark.sources.topic import json_topic, kafka_topic
    if args.kafka:
        return kafka_topic(spark, args.kafka, args.source, schema, **kafka_start(args), **kafka_bounds(args))
    return json_topic(spark, args.source, schema, **file_options(args, ckpt))


def _app_step(job: str):
    """``(dws_schema, app_fn, keys, recursive)`` of a job's APP query, if any."""
    from tidemark.plans import jobs
    from tidemark.streaming import jobs as sj
    if job in WINDOW_JOBS:
        w = getattr(sj, WINDOW_JOBS[job][0])
        return w.dws_schema, w.app, w.app_keys, False
    if job == "category-counts":
        return sj.CATEGORY_DWS, jobs.category_counts_app, ["category_name"], True
    return None


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_session(master="local[*]" if args.local else None, app=f"tidemark-{args.job}",
                        cluster=not args.local, shuffle_partitions=args.shuffle_partitions)
    if args.shuffle_partitions is None and not args.local:
        # Batch jobs: one shuffle partition per 256 MB of input (AQE
        # coalesces small stages down from there).
        inputs = {"dwd-extract": "keyed", "user-totals": "keyed", "sql": "data"}
        if args.job in inputs and getattr(args, inputs[args.job]):
            size = input_bytes(spark, [getattr(args, inputs[args.job])])
            spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions_for(size)))

    if args.job == "sql":
        from tidemark.plans.registry import register_warehouse
        from tidemark.sources.tables import register
        if args.data:
            register_warehouse(spark, args.data)
        register(spark, _tables(args.table))
        df = spark.sql(args.query)
        df.printSchema()
        if args.out:
            df.write.parquet(args.out)
        else:
            _print_all(df, args.rows)
        return 0
    if args.job == "dwd-extract":
        from tidemark.sources.tables import keyed_table
        from tidemark.streaming.jobs import run_dwd_extract
        counts = run_dwd_extract(keyed_table(spark, args.keyed), args.out, args.now)
        print(" ".join(f"{k}={v}" for k, v in counts.items()))
        return 0
    if args.job == "user-totals":
        from tidemark.sources.tables import keyed_table
        from tidemark.streaming.jobs import run_user_totals
        run_user_totals(keyed_table(spark, args.keyed), args.out)
        return 0

    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
    ckpt = args.checkpoint or scratch_path(spark, "jobs", args.job)

    from tidemark.streaming.progress import ProgressTable, supervise
    with ProgressTable(spark, args.progress) if args.progress else nullcontext():
        supervise(spark, lambda: _start(spark, args, trigger, ckpt), args.restarts)
        app = _app_step(args.job)
        if args.available_now and app is not None and args.dws:
            # The APP query may have started before the DWS query's last
            # batch: run it once more over everything the DWS query wrote.
            from tidemark.streaming import jobs as sj
            schema, fn, keys, recursive = app
            supervise(spark, lambda: [sj.start_app(spark, args.dws, schema, fn, keys, args.app, f"{ckpt}/app", trigger,
                                                   args.job, recursive=recursive)], args.restarts)
    return 0


def _start(spark, args, trigger: dict, ckpt: str) -> list:
    """The queries of a streaming job, started."""
    from tidemark import schemas
    from tidemark.streaming import jobs as sj
    if args.job in WINDOW_JOBS:
        job_name, kind = WINDOW_JOBS[args.job]
        schema = schemas.DWD_ORDERS if kind == "orders" else schemas.USER_BEHAVIOR
        source, job, label = _source(spark, args, schema, ckpt), getattr(sj, job_name), args.job.replace("-", "_")
        if args.dws_topic:
            queries = sj.start_window_job_kafka(spark, job, source, args.kafka, args.dws_topic, args.app, ckpt,
                                                trigger, label)
        else:
            queries = sj.start_window_job(spark, job, source, args.dws, args.app, ckpt, trigger, label)
    elif args.job == "category-counts":
        from tidemark.sources.tables import load_table
        queries = sj.start_category_job(spark, _source(spark, args, schemas.USER_BEHAVIOR, ckpt),
                                        lambda: load_table(spark, args.dim), args.dws, args.app, ckpt,
                                        args.dim_age, trigger)
    elif args.job == "item-counts":
        queries = [sj.start_item_counts(spark, _source(spark, args, schemas.USER_BEHAVIOR, ckpt), args.out, ckpt, trigger)]
    elif args.job == "user-totals-stream":
        queries = [sj.start_user_totals_stream(spark, _source(spark, args, schemas.DWD_ORDERS, ckpt), args.out, ckpt, trigger)]
    elif args.job == "user-top1":
        dws = _source(spark, args, sj.USER_PROVINCE_HOUR.dws_schema, ckpt)
        queries = [sj.start_user_top1(spark, dws, args.out, ckpt, trigger)]
    elif args.job == "cdc-sync":
        from tidemark.sources.tables import load_table
        from tidemark.sources.topic import json_topic, kafka_records
        from tidemark.streaming.cdc_apply import start_cdc_sync
        if args.kafka:
            raw = kafka_records(spark, args.kafka, args.changelog, **kafka_start(args), **kafka_bounds(args))
        else:
            raw = json_topic(spark, args.changelog, schemas.CHANGELOG_TOPIC, **file_options(args, ckpt))
        queries = [start_cdc_sync(spark, raw, lambda: load_table(spark, args.flow), args.table,
                                  ckpt, trigger, args.fold_every)]
    else:
        raise SystemExit(f"unknown job {args.job}")
    return queries


if __name__ == "__main__":
    sys.exit(main())
