"""Runs one of the jobs: ``spark-submit --py-files keyfold.zip run.py documents --root ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.operators import progress, signals
from keyfold.operators.merge import LOG_ORDER, TIME_ORDER
from keyfold.session import SESSION_CONF
from keyfold.sources import message_log
from keyfold.sources.positions import stream_positions
from keyfold.streaming import bulk, jobs

ORDERS = {"time": TIME_ORDER, "log": LOG_ORDER}
JOBS = {"documents": jobs.document_job, "keep-last": jobs.keep_last_job, "profiles": jobs.profile_job}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="keyfold")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="folder of the output tables")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--messages", help="folder of Parquet message files, in place of Kafka")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic")
    parser.add_argument("--partitions", type=int, help="partitions of the topic; needed once the ledger has positions")
    parser.add_argument("--start", choices=progress.START_POLICIES, default="latest", help="where no position is stored")
    parser.add_argument("--rate", type=int, help="messages per Kafka partition and second at most")
    parser.add_argument("--max-files", type=int, help="files of --messages per batch at most")
    parser.add_argument("--max-positions", type=int, help="positions of --messages per partition and batch at most; reads from the ledger on")
    parser.add_argument("--expire", type=int, default=0, metavar="SECONDS", help=f"forget a ledger that was idle so long (originally {progress.TTL_SECONDS}); 0: never")
    parser.add_argument("--committed", action="store_true", help="one commit a batch for all tables, and a store in levels")
    parser.add_argument("--interval", type=float, help="seconds between batches; without it the backlog is worked off once")
    parser.add_argument("--prefix", default="app")
    parser.add_argument("--group", default="g1")
    parser.add_argument("--queue", default=signals.TASK_QUEUE)
    parser.add_argument("--null-policy", choices=["overwrite", "ignore"], default="overwrite")
    parser.add_argument("--order", choices=ORDERS, default="time", help="what makes a message the newer one")
    parser.add_argument("--flat", action="store_true", help="replace nested objects as a whole")
    parser.add_argument("--unquoted-names", action="store_true", help="accept {id:1}")
    parser.add_argument("--compact-every", type=int, default=0, help="batches between snapshots of the store")
    parser.add_argument("--buckets", type=int, default=16, help="buckets of the first snapshot")
    parser.add_argument("--sink", help="module:factory of a transport that gets the documents in bulks")
    parser.add_argument("--sink-option", action="append", default=[], metavar="NAME=VALUE")
    parsed = parser.parse_args(argv)
    if bool(parsed.messages) == bool(parsed.servers and parsed.topic):
        parser.error("give either --messages, or --servers and --topic")
    if parsed.messages and parsed.rate:
        parser.error("--rate caps Kafka partitions; use --max-files with --messages")
    if parsed.max_positions and (not parsed.messages or parsed.max_files):
        parser.error("--max-positions goes with --messages, in place of --max-files")
    if parsed.rate and not parsed.partitions:
        parser.error("--rate is per partition; give --partitions too")
    if [option for option in parsed.sink_option if "=" not in option]:
        parser.error("--sink-option takes NAME=VALUE")
    return parsed


def kafka_source_options(tables: jobs.JobTables, args: argparse.Namespace) -> dict[str, str]:
    """Start positions from the ledger, else by policy (S2), and the rate cap (S3).

    The topic's partitions are whatever the source finds, until there are stored positions: then it
    wants one for each, and a ledger that knows more partitions than were given is an error.
    """
    spark = tables.ledger.spark
    stored = stored_positions(tables, args, args.topic)
    count = progress.checked_partitions(stored, args.partitions)
    start = args.start
    if count is not None:
        partitions = spark.range(count).select(F.col("id").cast("int").alias("part"))
        start = progress.starting_offsets(args.topic, progress.start_positions(partitions, stored, args.start))
    cap = args.rate and message_log.offsets_per_trigger(args.rate, args.partitions, args.interval or 1)
    return message_log.kafka_options(args.servers, args.topic, args.group, start, cap)


def stored_positions(tables: jobs.JobTables, args: argparse.Namespace, topic: str | None, as_of: Column | None = None) -> DataFrame:
    """``part, until_pos`` of the ledger (T3), nothing of it once it was idle for ``--expire`` seconds (T5). Without a topic, the one the
    ledger knows."""
    ledger = progress.current_ledger(tables.ledger.read())
    if args.expire:
        ledger = progress.live_ledger(ledger, F.current_timestamp() if as_of is None else as_of, args.expire)
    mine = ledger.filter((F.col("prefix") == args.prefix) & (F.col("group_id") == args.group))
    return (mine if topic is None else mine.filter(F.col("topic") == topic)).select("part", "until_pos")


def position_stream(spark: SparkSession, tables: jobs.JobTables, args: argparse.Namespace) -> DataFrame:
    """The files as a stream of positions, a new checkpoint starting where the ledger ends."""
    starting = {r.part: r.until_pos for r in stored_positions(tables, args, args.topic).collect()}
    return stream_positions(spark, args.messages, args.checkpoint, starting, "earliest", args.max_positions)


def job_config(args: argparse.Namespace) -> jobs.JobConfig:
    sinks = ()
    if args.sink:
        sinks = (bulk.bulk_sink({"transport": args.sink, **dict(o.split("=", 1) for o in args.sink_option)}),)
    return jobs.JobConfig(
        args.root,
        args.prefix,
        args.group,
        args.queue,
        ORDERS[args.order],
        args.null_policy,
        not args.flat,
        sinks,
        args.compact_every,
        args.buckets,
        args.unquoted_names,
        args.committed,
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    builder = SparkSession.builder.appName(f"keyfold-{args.job}")
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    config = job_config(args)
    if args.max_positions:
        stream = position_stream(spark, jobs.JobTables(spark, config), args)
    elif args.messages:
        stream = message_log.stream_log(spark, args.messages, args.max_files)
    else:
        stream = message_log.stream_kafka(spark, kafka_source_options(jobs.JobTables(spark, config), args))
    if config.sinks:
        bulk.register(spark)
    if args.max_positions and args.interval is None:
        jobs.work_off(stream, JOBS[args.job](config), args.checkpoint, f"keyfold-{args.job}")
        return
    jobs.start(stream, JOBS[args.job](config), args.checkpoint, args.interval, f"keyfold-{args.job}").awaitTermination()


if __name__ == "__main__":
    main()
