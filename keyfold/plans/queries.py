"""The registered queries. Each takes ``(spark, sf_dir)`` and reads the given tables in full."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.functions import text_of
from keyfold.operators import lookup, merge, messages, profiles, progress, signals
from keyfold.plans.fixtures import BURST_COLUMNS, NESTED_COLUMNS, NUMBER_COLUMNS, TOPIC, message_log, table
from keyfold.session import scratch_path
from keyfold.sources.message_log import spread, stream_log
from keyfold.sources.positions import stream_positions
from keyfold.streaming import bulk, jobs, monitor
from keyfold.streaming.commits import CommitLog
from keyfold.streaming.levels import LeveledStore
from keyfold.streaming.tables import DIRECT, BatchTable, DocumentStore

PREFIX, GROUP = "app", "g1"


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.parse_messages(message_log(spark, sf_dir))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.documents(_parsed(spark, sf_dir))


def _slots(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _append(log: DataFrame, path: str) -> None:
    """Adds messages to a log that a job streams, a file a slot at most: the job cuts its batches itself."""
    log.coalesce(_slots(log.sparkSession)).write.mode("append").parquet(path)


def documents_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("id", "part", "pos", "value")


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    rejected = messages.rejects(
        parsed,
        document=messages.document_reason(),
        signal=signals.signal_reason(),
        profile=profiles.profile_reason(),
    )
    return messages.reject_counts(rejected)


def text_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of the other tables offered as a message: why is it no document?"""
    texts = {
        "documents": ("doc_id", "text"),
        "pages": ("page_id", "html"),
        "conversations": ("conv_id", "text"),
        "benchmark": ("item_id", "text"),
        "events": ("event_id", "props"),
    }
    logs = [
        table(spark, sf_dir, name).select(
            F.lit(name).alias("topic"),
            F.lit(0).alias("part"),
            F.col(key).alias("pos"),
            F.lit(None).cast("timestamp").alias("ts"),
            F.col(text).alias("value"),
        )
        for name, (key, text) in texts.items()
    ]
    parsed = messages.parse_messages(messages.union_logs(*logs))
    reason = F.coalesce(messages.document_reason(), F.lit("document"))
    return parsed.groupBy("topic", reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def signal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = signals.signals(_parsed(spark, sf_dir))
    return found.select(
        "part", "pos", "data_source", "is_last_batch", "tag_id", "batch_id", "operate_source", "task_status"
    )


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.queue_rows(signals.signals(_parsed(spark, sf_dir)))


def queue_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.with_place(_queue(spark, sf_dir)).select("queue_name", "place", "payload", "part", "pos")


def queue_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue's order when all signals come in one minute, some have no time, and all were read twice."""
    found = signals.signals(messages.parse_messages(message_log(spark, sf_dir, BURST_COLUMNS)))
    queue = signals.queue_rows(found)
    once = signals.distinct_pushes(queue.unionByName(queue))
    return signals.with_place(once).select("queue_name", "place", "payload", "part", "pos")


def user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.profiles(_parsed(spark, sf_dir)).select(*profiles.PROFILE_COLUMNS, "pos")


def profile_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.profile_json(profiles.profiles(_parsed(spark, sf_dir))).select("id", "source", "pos")


def profile_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.profile_upsert(profiles.profiles(_parsed(spark, sf_dir)))


def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("id", "value", "part", "pos", "ts")
    return merge.keep_last(docs).select("id", "value", "part", "pos")


def conversation_last_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-last with the turns of a conversation as messages about one document."""
    turns = table(spark, sf_dir, "conversations")
    log = turns.select(
        F.lit("conversations").alias("topic"),
        F.lit(0).alias("part"),
        F.col("turn").alias("pos"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.to_json(F.struct(F.col("conv_id").alias("id"), "role", "text")).alias("value"),
    )
    docs = messages.documents(messages.parse_messages(spread(log, _slots(spark), "pos")))
    last = merge.keep_last(docs.select("id", "pos", "part", "ts", "fields"), merge.LOG_ORDER)
    return last.select(
        "id",
        "pos",
        text_of(F.col("fields"), "role").alias("role"),
        text_of(F.col("fields"), "text").alias("text"),
    )


def field_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.field_text(merge.field_merge(_documents(spark, sf_dir)))


def field_merge_ignore_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.field_text(merge.field_merge(_documents(spark, sf_dir), null_policy="ignore"))


def document_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merged_documents(merge.field_merge(_documents(spark, sf_dir)))


def exact_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose numbers have more digits than any number type."""
    docs = messages.documents(messages.parse_messages(message_log(spark, sf_dir, NUMBER_COLUMNS)))
    store = DocumentStore(spark, scratch_path(spark, "numbers"))
    store.write_batch(docs, 0)
    fields = merge.field_text(merge.field_merge(docs)).filter("field <> 'w'")
    return fields.join(store.documents(), "id").select("id", "field", "val", "source")


def bulk_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a job's bulk sink hands them to an external store, read back from there."""
    bulk.register(spark)
    root = scratch_path(spark, "bulk")
    sink = bulk.bulk_sink({"transport": "keyfold.streaming.bulk:FileTransport", "path": f"{root}/sent"})
    _append(message_log(spark, sf_dir), f"{root}/log")
    job = jobs.document_job(jobs.JobConfig(f"{root}/tables", PREFIX, GROUP, sinks=(sink,)))
    jobs.start(stream_log(spark, f"{root}/log"), job, f"{root}/checkpoint").awaitTermination()
    written = spark.read.schema("id string, doc string").json(f"{root}/sent/bulk-*.jsonl")
    return written.withColumnRenamed("doc", "source")


def bulk_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last update of every nested document that a bulk sink hands over: what follows its resets."""
    bulk.register(spark)
    path = scratch_path(spark, "bulk")
    sink = bulk.bulk_sink({"transport": "keyfold.streaming.bulk:FileTransport", "path": path})
    tables = jobs.JobTables(spark, jobs.JobConfig(scratch_path(spark, "tables")))
    tables.store.write_batch(messages.documents(messages.parse_messages(message_log(spark, sf_dir, NESTED_COLUMNS))), 0)
    sink(jobs.Written(tables, DIRECT, 0))
    lines = spark.read.schema("id string, doc string").json(f"{path}/bulk-*.jsonl").withColumnRenamed("doc", "source")
    # a reset holds nothing but nulls, and no id
    return lines.filter(F.get_json_object("source", "$.id").isNotNull())


def store_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a store with batches, a snapshot, more batches, another snapshot and some more."""
    return _store(spark, sf_dir).documents()


def _store(spark: SparkSession, sf_dir: str) -> DocumentStore:
    store = DocumentStore(spark, scratch_path(spark, "store"))
    docs = _documents(spark, sf_dir)
    for batch_id in range(5):
        store.write_batch(docs.filter(F.pmod("pos", F.lit(5)) == batch_id), batch_id)
        if batch_id in (1, 3):
            store.compact(buckets=8)
            store.clean()
    return store


BATCHES = 9


def store_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a store in levels that nine batches went into, with folds between them and buckets that split."""
    path = scratch_path(spark, "batches")
    docs = _documents(spark, sf_dir).withColumn("batch", F.pmod("pos", F.lit(BATCHES)))
    docs.write.partitionBy("batch").parquet(path)
    store = LeveledStore(CommitLog(spark, scratch_path(spark, "levels")), buckets=2, fan=3, bucket_rows=10_000)
    for number in range(BATCHES):
        store.write(spark.read.schema(docs.schema).parquet(path).filter(F.col("batch") == number).drop("batch"))
        if number < BATCHES - 1:
            store.fold()
    return store.documents()


def document_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["nick_name", "phone", "user_from", "tag_id", "batch_id"]
    return merge.wide_state(_documents(spark, sf_dir), names)


def corpus_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text corpus sent as two partial messages per document and merged back."""
    docs = table(spark, sf_dir, "documents")
    doc_id = F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id")

    def log(pos: int, *columns: str) -> DataFrame:
        return docs.select(
            F.lit("documents").alias("topic"),
            F.lit(0).alias("part"),
            (F.col("doc_id") * 2 + pos).alias("pos"),
            F.lit(None).cast("timestamp").alias("ts"),
            F.to_json(F.struct(doc_id, *columns)).alias("value"),
        )

    both = messages.union_logs(log(0, "lang", "text"), log(1, "source", "n_chars"))
    parsed = messages.parse_messages(spread(both, _slots(spark), "pos"))
    names = ["text", "lang", "source", "n_chars"]
    return merge.wide_state(messages.documents(parsed), names, order=merge.LOG_ORDER)


def nested_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = messages.documents(messages.parse_messages(message_log(spark, sf_dir, NESTED_COLUMNS)))
    # reading documents looks at the state rows more than once, so they are stored first
    store = DocumentStore(spark, scratch_path(spark, "nested"))
    store.write_batch(docs, 0)
    return store.documents()


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger entry per partition and batch of 1,000 positions, stamped with the batch's time."""
    batch = F.floor(F.col("pos") / 1000)
    log = message_log(spark, sf_dir).groupBy(batch.alias("batch_id"), "topic", "part").agg(
        (F.max("pos") + 1).alias("until_pos"), F.max("ts").alias("updated_at")
    )
    return log.select(
        F.lit(PREFIX).alias("prefix"), F.lit(GROUP).alias("group_id"), "topic", "part", "until_pos", "updated_at", "batch_id"
    )


def offset_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = message_log(spark, sf_dir)
    entries = progress.ledger_entries(
        progress.offset_ranges(log), PREFIX, GROUP, F.lit("2024-01-01").cast("timestamp"), 0
    )
    return progress.ledger_keys(progress.current_ledger(entries))


def ledger_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = progress.ledger_keys(progress.current_ledger(_ledger(spark, sf_dir)))
    return progress.parse_ledger_keys(keys, PREFIX, GROUP, TOPIC)


def ledger_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch entries still alive at a fixed moment late in the log."""
    as_of = F.lit("2024-01-25 12:00:00").cast("timestamp")
    return progress.live_ledger(_ledger(spark, sf_dir), as_of).select("topic", "part", "until_pos", "batch_id")


def start_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All partitions of the log and two that are new."""
    ledger = progress.load_ledger(_ledger(spark, sf_dir), PREFIX, GROUP, TOPIC)
    top = message_log(spark, sf_dir).agg(F.max("part").alias("top"))
    partitions = top.select(F.explode(F.sequence(F.lit(0), F.col("top") + 2)).alias("part"))
    return progress.start_positions(partitions, ledger)


def point_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document read from the store: a bucket of its snapshot and the changes since."""
    return _store(spark, sf_dir).get("u5", ("nick_name", "phone"))


def multi_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged documents of all users that had an error."""
    events = table(spark, sf_dir, "events")
    ids = events.filter(F.col("event_type") == "error").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id")
    )
    found = lookup.multi_get(_documents(spark, sf_dir), ids)
    return merge.merged_documents(merge.field_merge(found))


def key_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = progress.ledger_keys(progress.current_ledger(_ledger(spark, sf_dir)))
    return lookup.pattern_get(keys, f"{PREFIX}:{GROUP}:{TOPIC}:[13]")


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    reasons = {
        "document": messages.document_reason(),
        "signal": signals.signal_reason(),
    }
    batch = F.floor(F.col("pos") / 1000).alias("batch_id")
    return jobs.batch_metrics(_parsed(spark, sf_dir), reasons, [batch])


PIECES = 5


def _piece(spark: SparkSession, sf_dir: str):
    """Which of five pieces a message is in, by position; one without goes to the first."""
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    at = F.floor(F.col("pos") * PIECES / (last + 1))
    return F.coalesce(F.least(F.greatest(at, F.lit(0)), F.lit(PIECES - 1)), F.lit(0))


def _streamed(
    spark: SparkSession,
    sf_dir: str,
    job,
    checkpoints: int = 1,
    compact_every: int = 0,
    replays: bool = False,
    window: str | None = None,
) -> jobs.JobTables:
    """Writes the log in pieces and restarts the job after each of them, some time with a new checkpoint and a
    new log if there are to be several. With ``replays`` a piece brings the one before along again; with a ``window`` the
    stream drops it."""
    root = scratch_path(spark, "stream")
    log, piece = message_log(spark, sf_dir), _piece(spark, sf_dir)
    config = jobs.JobConfig(f"{root}/tables", PREFIX, GROUP, compact_every=compact_every, buckets=8)
    for number in range(PIECES):
        life = number * checkpoints // PIECES
        wanted = piece.between(number - 1, number) if replays else piece == number
        _append(log.filter(wanted), f"{root}/log{life}")
        stream = stream_log(spark, f"{root}/log{life}")
        stream = jobs.without_replays(stream, window) if window else stream
        jobs.start(stream, job(config), f"{root}/checkpoint{life}").awaitTermination()
    return jobs.JobTables(spark, config)


def stream_field_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document job over a streamed log: the store's fields as JSON text."""
    return _streamed(spark, sf_dir, jobs.document_job).store.fields()


def stream_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document job that loses its checkpoint halfway and goes on with a new one, on the same tables, with
    snapshots taken in between."""
    return _streamed(spark, sf_dir, jobs.document_job, checkpoints=2, compact_every=2).store.fields()


def stream_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document job with one commit a batch, which fails in every second batch after its documents were written and is
    started again: the store's fields."""
    root = scratch_path(spark, "stream")
    log, piece = message_log(spark, sf_dir), _piece(spark, sf_dir)
    failed = set()

    def fails(written: jobs.Written) -> None:
        if written.batch_id % 2 == 1 and written.batch_id not in failed:
            failed.add(written.batch_id)
            raise RuntimeError("the store is down")

    config = jobs.JobConfig(f"{root}/tables", PREFIX, GROUP, sinks=(fails,), compact_every=2, buckets=4, committed=True)
    for number in range(PIECES):
        _append(log.filter(piece == number), f"{root}/log")
        job = jobs.start(stream_log(spark, f"{root}/log"), jobs.document_job(config), f"{root}/checkpoint")
        try:
            job.awaitTermination()
        except StreamingQueryException as error:
            if "the store is down" not in str(error):
                raise
            # what was written is not seen
            seen = jobs.JobTables(spark, config)
            assert len(seen.metrics.batches()) == len(seen.ledger.batches()) == number
            jobs.start(stream_log(spark, f"{root}/log"), jobs.document_job(config), f"{root}/checkpoint").awaitTermination()
    return jobs.JobTables(spark, config).store.fields()


def stream_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keep-last job over a streamed log that brings most messages twice: its signal queue."""
    queue = _streamed(spark, sf_dir, jobs.keep_last_job, replays=True).queue.read()
    return signals.distinct_pushes(queue).select("queue_name", "payload", "part", "pos")


def stream_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile job over a streamed log, capped at a few files a batch: its documents."""
    root = scratch_path(spark, "stream")
    log, piece = message_log(spark, sf_dir), _piece(spark, sf_dir)
    for number in range(PIECES):
        _append(log.filter(piece == number), f"{root}/log")
    config = jobs.JobConfig(f"{root}/tables", PREFIX, GROUP)
    stream = stream_log(spark, f"{root}/log", max_files_per_trigger=2 * _slots(spark))
    jobs.start(stream, jobs.profile_job(config), f"{root}/checkpoint").awaitTermination()
    return jobs.JobTables(spark, config).store.documents()


def stream_from_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keep-last job over positions of the log, a third of each partition's a batch at most. Halfway the checkpoint is lost; a new one
    starts at the positions in the ledger. The signal queue as it was written, in which no message may stand twice."""
    root = scratch_path(spark, "stream")
    log, piece = message_log(spark, sf_dir), _piece(spark, sf_dir)
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    config = jobs.JobConfig(f"{root}/tables", PREFIX, GROUP, buckets=4, committed=True)
    for life, pieces in enumerate((piece < PIECES // 2, piece >= PIECES // 2)):
        ordered = log.filter(pieces).repartition("part").sortWithinPartitions("part", "pos")
        ordered.write.mode("append").parquet(f"{root}/log")
        stored = progress.load_ledger(jobs.JobTables(spark, config).ledger.read(), PREFIX, GROUP, TOPIC)
        starting = {r.part: r.until_pos for r in stored.collect()}
        checkpoint = f"{root}/checkpoint{life}"
        stream = stream_positions(spark, f"{root}/log", checkpoint, starting, positions_per_trigger=max(1, last // 3))
        jobs.work_off(stream, jobs.keep_last_job(config), checkpoint)
    return jobs.JobTables(spark, config).queue.read().select("queue_name", "payload", "part", "pos")


def stream_no_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keep-last job over a streamed log that brings most messages twice and drops what comes again: its queue as it was written."""
    return _streamed(spark, sf_dir, jobs.keep_last_job, replays=True, window="10 days").queue.read().select(
        "queue_name", "payload", "part", "pos"
    )


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of the profile job over positions, a third of each partition's a batch at most, as a listener saw them."""
    root = scratch_path(spark, "stream")
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    message_log(spark, sf_dir).repartition("part").sortWithinPartitions("part", "pos").write.parquet(f"{root}/log")
    seen = BatchTable(spark, f"{root}/progress", monitor.PROGRESS_SCHEMA)
    name = f"keyfold-{uuid.uuid4().hex}"
    listener = monitor.ProgressListener({name: seen}.get)
    spark.streams.addListener(listener)
    try:
        stream = stream_positions(spark, f"{root}/log", f"{root}/checkpoint", positions_per_trigger=max(1, last // 3))
        jobs.work_off(stream, jobs.profile_job(jobs.JobConfig(f"{root}/tables", PREFIX, GROUP)), f"{root}/checkpoint", name)
        monitor.settled(spark)
    finally:
        spark.streams.removeListener(listener)
    return seen.read().select("batch_id", "messages", "reached")


def multi_get_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of all users that had an error, read from a store in levels: ids go to the buckets, stored rows stay."""
    store = LeveledStore(CommitLog(spark, scratch_path(spark, "levels")), buckets=8, fan=2, bucket_rows=50_000)
    for half in (0, 1):
        store.write(_documents(spark, sf_dir).filter(F.pmod("pos", F.lit(2)) == half))
        store.fold(every=True)
    events = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    return store.get_joined(events.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "documents_valid": documents_valid,
    "rejects": rejects,
    "text_audit": text_audit,
    "signals": signal_rows,
    "queue_newest_first": queue_newest_first,
    "queue_burst": queue_burst,
    "user_profiles": user_profiles,
    "profile_sources": profile_sources,
    "profile_upsert": profile_upsert,
    "keep_last": keep_last,
    "conversation_last_turn": conversation_last_turn,
    "field_merge": field_merge,
    "field_merge_ignore_null": field_merge_ignore_null,
    "document_sources": document_sources,
    "exact_numbers": exact_numbers,
    "bulk_written": bulk_written,
    "bulk_nested": bulk_nested,
    "store_snapshot": store_snapshot,
    "store_levels": store_levels,
    "document_state": document_state,
    "corpus_state": corpus_state,
    "nested_merge": nested_merge,
    "offset_ledger": offset_ledger,
    "ledger_load": ledger_load,
    "ledger_live": ledger_live,
    "start_positions": start_positions,
    "point_get": point_get,
    "multi_get": multi_get,
    "multi_get_store": multi_get_store,
    "key_glob": key_glob,
    "batch_metrics": batch_metrics,
    "stream_field_merge": stream_field_merge,
    "stream_new_checkpoint": stream_new_checkpoint,
    "stream_commit": stream_commit,
    "stream_queue": stream_queue,
    "stream_profiles": stream_profiles,
    "stream_from_positions": stream_from_positions,
    "stream_no_replays": stream_no_replays,
    "stream_progress": stream_progress,
}
