from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from keyfold.__main__ import main
from keyfold.operators import deep_merge, lookup, merge, messages, progress, signals
from keyfold.plans import fixtures
from keyfold.plans.queries import QUERIES
from keyfold.sources import message_log
from keyfold.sources.message_log import read_log, stream_log
from keyfold.streaming import jobs
from keyfold.streaming.tables import DIRECT, DocumentStore
from tests.test_merge import brute_force, random_messages


def behaviour(count, seed=5):
    rng = random.Random(seed)
    values = []
    for at, message in enumerate(random_messages(rng, count, nested=True)):
        kind = at % 10
        if kind == 0:
            values.append("{broken")
        elif kind == 1:
            values.append(json.dumps({"data_source": "tag_operate_queue", "is_last_batch": at % 2, "n": at}))
        elif kind == 2:
            values.append(json.dumps({"data_source": "s", "app_id": "a", "user_id": str(at % 4), "nick_name": f"n{at}"}))
        else:
            values.append(json.dumps(message))
    return [(at % 3, at // 3, value) for at, value in enumerate(values)]


def pieces(frame, path, bounds):
    for low, high in bounds:
        frame.filter(F.col("seq").between(low, high - 1)).drop("seq").coalesce(1).write.mode("append").parquet(path)


def numbered(frame):
    return frame.withColumn("seq", F.unix_seconds("ts") - 1_700_000_000)


def documents_of(frame):
    return {r.id: json.loads(r.source) for r in frame.collect()}


def run(spark, job, log_path, root, **options):
    stream = stream_log(spark, log_path, **options)
    jobs.start(stream, job(jobs.JobConfig(f"{root}/tables")), f"{root}/checkpoint").awaitTermination()
    return jobs.JobTables(spark, jobs.JobConfig(f"{root}/tables"))


def test_streamed_equals_batch_over_restarts_and_replays(spark, log, tmp_path):
    sent = behaviour(200)
    frame = numbered(log(*sent)).cache()
    path = f"{tmp_path}/log"
    # the second run reads some messages again, as after a restart from old positions
    pieces(frame, path, [(0, 60), (60, 120)])
    run(spark, jobs.document_job, path, tmp_path, max_files_per_trigger=1)
    pieces(frame, path, [(90, 150), (150, 200)])
    tables = run(spark, jobs.document_job, path, tmp_path, max_files_per_trigger=1)

    parsed = messages.parse_messages(frame.drop("seq"))
    whole = documents_of(deep_merge.state_documents(deep_merge.state_rows(messages.documents(parsed))))
    valid = [json.loads(v) for _, _, v in sent if v != "{broken"]
    assert whole == brute_force([m for m in valid if m.get("id")], nested=True)
    assert documents_of(tables.store.documents()) == whole

    metrics = tables.metrics.read().orderBy("batch_id").collect()
    assert [m.messages for m in metrics] == [60, 60, 60, 50]
    quarantined = tables.quarantine.read().groupBy("branch", "reason").count().collect()
    assert ("document", "malformed", 23) in {tuple(r) for r in quarantined}

    queue = tables.queue.read()
    assert signals.distinct_pushes(queue).count() == signals.signals(parsed).count() < queue.count()
    ledger = progress.load_ledger(tables.ledger.read(), "app", "g1", "t").collect()
    assert {r.part: r.until_pos for r in ledger} == {0: 67, 1: 67, 2: 66}

    # nothing new: a restart writes nothing
    run(spark, jobs.document_job, path, tmp_path)
    assert tables.metrics.read().count() == 4
    frame.unpersist()


def test_ledger_entries_are_complete_in_every_batch(spark, log, tmp_path):
    path = f"{tmp_path}/log"
    frame = numbered(log((0, 0, '{"id":"a"}'), (1, 0, '{"id":"a"}'), (0, 1, '{"id":"a"}')))
    pieces(frame, path, [(0, 2), (2, 3)])
    tables = run(spark, jobs.document_job, path, tmp_path, max_files_per_trigger=1)
    rows = {(r.batch_id, r.part): r.until_pos for r in tables.ledger.read().collect()}
    assert rows == {(0, 0): 1, (0, 1): 1, (1, 0): 2, (1, 1): 1}


def test_keep_last_job_replaces_within_a_batch_and_merges_across(spark, log, tmp_path):
    path = f"{tmp_path}/log"
    values = ['{"id":"a","x":1}', '{"id":"a","y":2}', '{"id":"a","z":3}']
    pieces(numbered(log(*values)), path, [(0, 2), (2, 3)])
    tables = run(spark, jobs.keep_last_job, path, tmp_path, max_files_per_trigger=1)
    assert documents_of(tables.store.documents()) == {"a": {"id": "a", "y": 2, "z": 3}}


def test_repeated_nested_keys_need_no_setting_in_a_job(spark, log, tmp_path):
    log('{"id":"a","o":{"x":1,"x":2}}').write.parquet(f"{tmp_path}/log")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        tables = run(spark, jobs.document_job, f"{tmp_path}/log", tmp_path)
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    assert documents_of(tables.store.documents()) == {"a": {"id": "a", "o": {"x": 2}}}


def test_profile_job(spark, log, tmp_path):
    path = f"{tmp_path}/log"
    user = {"data_source": "s", "app_id": "a", "user_id": "1"}
    values = [json.dumps({**user, "nick_name": "n", "user_from": 2}), json.dumps({**user, "phone": "5"}), "{}"]
    pieces(numbered(log(*values)), path, [(0, 1), (1, 3)])
    tables = run(spark, jobs.profile_job, path, tmp_path, max_files_per_trigger=1)
    assert documents_of(tables.store.documents()) == {
        "a|1": {"id": "a|1", "app_id": "a", "user_id": "1", "nick_name": "n", "phone": "5", "user_created_at": 0, "user_from": 0}
    }
    assert [r.reason for r in tables.quarantine.read().collect()] == ["data_source_missing"]
    assert tables.queue.read().count() == 0


def test_a_failing_sink_leaves_no_ledger_entry_and_the_batch_is_repeated(spark, log, tmp_path):
    path = f"{tmp_path}/log"
    pieces(numbered(log('{"id":"a"}', '{"id":"b"}')), path, [(0, 2)])
    calls = []

    def failing_once(written):
        assert written.changes().count() == 2
        calls.append(written.batch_id)
        if len(calls) == 1:
            raise RuntimeError("store is down")

    config = jobs.JobConfig(f"{tmp_path}/tables", sinks=(failing_once,))
    tables = jobs.JobTables(spark, config)
    with pytest.raises(Exception, match="store is down"):
        jobs.start(stream_log(spark, path), jobs.document_job(config), f"{tmp_path}/cp").awaitTermination()
    assert tables.ledger.read().count() == 0
    jobs.start(stream_log(spark, path), jobs.document_job(config), f"{tmp_path}/cp").awaitTermination()
    assert calls == [0, 0]
    assert tables.ledger.read().count() == 1
    assert tables.store.documents().count() == 2


def test_compaction_changes_nothing_but_the_files(spark, log, tmp_path):
    sent = [m for m in random_messages(random.Random(3), 240, nested=True)]
    docs = messages.documents(messages.parse_messages(log(*map(json.dumps, sent)))).cache()
    store = DocumentStore(spark, f"{tmp_path}/documents")
    cuts = [(0, 80), (60, 130), (10, 100), (130, 200), (200, 240)]
    for batch_id, (low, high) in enumerate(cuts):
        store.write_batch(docs.filter(F.col("pos").between(low, high - 1)), batch_id)
        if batch_id in (1, 3):
            assert store.compact(buckets=4)
    assert documents_of(store.documents()) == brute_force(sent, nested=True)
    assert documents_of(store.documents({DIRECT: 0})) == brute_force(sent[:80], nested=True)
    assert documents_of(store.documents({DIRECT: 3})) == brute_force(sent[:200], nested=True)
    assert len(store._snapshots()) == 2
    # a session that does not know the table finds it by its folder
    newest = store._snapshots()[0]
    spark.sql(f"DROP TABLE {store._table_name(newest.name)}")
    assert documents_of(DocumentStore(spark, f"{tmp_path}/documents").documents()) == brute_force(sent, nested=True)

    # the snapshot is read once and not shuffled, in all that is made of it: the only exchange is that of the changes
    for frame in (store.state(), store.documents(), store.fields(), deep_merge.drop_overwritten(store.state())):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") == 1 and plan.count("Exchange") == 1 and "BroadcastExchange" not in plan
        assert plan.count("FileScan") == 2
    one = store.get("a", ("id",))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert [r.token for r in one.collect()] == ['"a"']
    assert plan.count("EqualTo(id,a)") == plan.count("FileScan") == 2 and "SelectedBucketsCount: 1 out of 4" in plan
    assert lookup.point_get(store.fields(), "a", ("id",)).collect() == one.collect()
    docs.unpersist()


def test_a_new_checkpoint_goes_on_with_the_same_tables(spark, log, tmp_path):
    config = jobs.JobConfig(f"{tmp_path}/tables")
    tables = jobs.JobTables(spark, config)
    frame = numbered(log((0, 0, '{"id":"a"}'), (1, 0, '{"id":"b"}'), (0, 1, '{"id":"c"}'), (0, 2, '{"id":"a","x":1}')))
    for life, (low, high) in enumerate([(0, 2), (2, 3), (3, 4)]):
        pieces(frame, f"{tmp_path}/log{life}", [(low, high)])
        stream = stream_log(spark, f"{tmp_path}/log{life}")
        jobs.start(stream, jobs.document_job(config), f"{tmp_path}/checkpoint{life}").awaitTermination()
        if life == 1:
            assert sorted(documents_of(tables.store.documents())) == ["a", "b", "c"]
            assert tables.store.compact(buckets=2) and not tables.store.compact()
            tables.store.clean(keep=1)
            assert sorted(documents_of(tables.store.documents())) == ["a", "b", "c"]
    assert documents_of(tables.store.documents()) == {"a": {"id": "a", "x": 1}, "b": {"id": "b"}, "c": {"id": "c"}}
    ledger = progress.load_ledger(tables.ledger.read(), "app", "g1", "t").collect()
    assert {r.part: r.until_pos for r in ledger} == {0: 3, 1: 1}
    assert tables.metrics.read().count() == 3


def test_upkeep_leaves_the_snapshot_and_what_came_since(spark, log, tmp_path):
    store = DocumentStore(spark, f"{tmp_path}/documents")
    sent = random_messages(random.Random(4), 60, nested=True)
    docs = messages.documents(messages.parse_messages(log(*map(json.dumps, sent)))).cache()
    for batch_id in range(12):
        store.write_batch(docs.filter(F.col("pos").between(5 * batch_id, 5 * batch_id + 4)), batch_id)
        if batch_id % 3 == 2 and batch_id < 11:
            assert store.compact(buckets=2)
            store.clean(keep=2)
    # three snapshots were taken: the two newest are there, and the changes since the older of them
    assert [s.seq for s in store._snapshots()] == [2, 1]
    assert store.changes.folders().batches() == [(DIRECT, b) for b in range(6, 12)]
    files = store.state().inputFiles()
    assert not [f for f in files if "batch_id=8" in f] and [f for f in files if "batch_id=9" in f]
    assert documents_of(store.documents()) == brute_force(sent, nested=True)
    docs.unpersist()


def test_a_job_keeps_up_its_store(spark, log, tmp_path):
    path = f"{tmp_path}/log"
    pieces(numbered(log(*[json.dumps({"id": "a", f"f{i}": i}) for i in range(6)])), path, [(i, i + 1) for i in range(6)])
    config = jobs.JobConfig(f"{tmp_path}/tables", compact_every=2, buckets=2)
    jobs.start(stream_log(spark, path, 1), jobs.document_job(config), f"{tmp_path}/cp").awaitTermination()
    store = jobs.JobTables(spark, config).store
    assert [s.seq for s in store._snapshots()] == [2, 1]
    assert documents_of(store.documents()) == {"a": {"id": "a", **{f"f{i}": i for i in range(6)}}}


def test_writing_a_batch_twice_replaces_it(spark, log, tmp_path):
    store = DocumentStore(spark, f"{tmp_path}/documents")
    docs = messages.documents(messages.parse_messages(log('{"id":"a","x":1}')))
    store.write_batch(docs, 0)
    store.write_batch(docs, 0)
    assert store.changes.read().count() == 2


def test_an_empty_store_can_be_read(spark, tmp_path):
    tables = jobs.JobTables(spark, jobs.JobConfig(f"{tmp_path}/nothing"))
    assert tables.store.documents().count() == 0
    assert tables.queue.read().count() == 0


def test_runner(spark, log, tmp_path):
    log('{"id":"a","x":1}', "junk").write.parquet(f"{tmp_path}/log")
    main(["documents", "--messages", f"{tmp_path}/log", "--root", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/cp"])
    tables = jobs.JobTables(spark, jobs.JobConfig(f"{tmp_path}/out"))
    assert documents_of(tables.store.documents()) == {"a": {"id": "a", "x": 1}}
    assert read_log(spark, f"{tmp_path}/log").count() == 2


def test_wide_state_reads_the_same_as_the_store(spark, log, tmp_path):
    docs = messages.documents(messages.parse_messages(log('{"id":"a","x":"1"}', '{"id":"a","y":"2"}')))
    row = merge.wide_state(docs, ["x", "y"]).first()
    assert (row.x, row.y) == ("1", "2")


@pytest.mark.parametrize("numbers", [(0, 0), (5, 3)])
def test_writes_outside_a_stream_are_kept_whatever_their_number(spark, log, tmp_path, numbers):
    """The number of a write says nothing about what was folded: a folder written after a fold is new."""
    store = DocumentStore(spark, f"{tmp_path}/documents")
    for name, number in zip("ab", numbers):
        store.write_batch(messages.documents(messages.parse_messages(log(f'{{"id":"{name}"}}'))), number)
        assert store.compact(buckets=2)
        store.clean(keep=1)
        assert not store.compact()
    assert sorted(documents_of(store.documents())) == ["a", "b"]
    store.write_batch(messages.documents(messages.parse_messages(log('{"id":"c"}'))), min(numbers))
    assert sorted(documents_of(store.documents())) == ["a", "b", "c"]
    store.clean(keep=1)
    assert sorted(documents_of(store.documents())) == ["a", "b", "c"]


def test_a_large_log_is_parsed_as_it_was_split(spark, tmp_path):
    """No exchange between scan and parse where the input has as many splits as the cluster has slots."""
    slots = spark.sparkContext.defaultParallelism
    rows = spark.range(800).selectExpr("id AS event_id", "timestamp_seconds(id) AS ts", "id % 9 AS user_id", "'click' AS event_type")
    for name, parts in (("small", 1), ("large", 2 * slots)):
        rows.repartition(parts).write.parquet(f"{tmp_path}/{name}/events.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
    try:
        for query, exchanges in (("documents_valid", 0), ("field_merge", 2)):
            plans = {
                name: QUERIES[query](spark, f"{tmp_path}/{name}")._jdf.queryExecution().executedPlan().toString() for name in ("small", "large")
            }
            assert "REPARTITION_BY_NUM" in plans["small"] and "REPARTITION" not in plans["large"]
            assert plans["large"].count("Exchange hashpartitioning") == exchanges
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_few_splits_of_many_rows_are_spread_by_rows(spark, tmp_path, monkeypatch):
    """A file of one row group lies in one split, however many splits the scan has."""
    slots = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(message_log, "TASK_ROWS", 500, raising=False)
    rows = spark.range(10_000).selectExpr("id AS event_id", "timestamp_seconds(id) AS ts", "id % 9 AS user_id", "'click' AS event_type")
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    size = sum(f.stat().st_size for f in (tmp_path / "events.parquet").glob("part-*"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // (2 * slots)))
    try:
        log = fixtures.message_log(spark, str(tmp_path))
        held = [r["count"] for r in log.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(held) == 10_000 and max(held) <= 1_000


def test_a_batch_of_one_split_is_cached_in_pieces(spark, log, tmp_path, monkeypatch):
    rows = spark.range(20_000).selectExpr(
        "'t' AS topic", "0 AS part", "id AS pos", "timestamp_seconds(id) AS ts", """concat('{"id":"u', id, '"}') AS value"""
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/log")
    pieces = getattr(jobs, "_PIECES", {})
    monkeypatch.setitem(pieces, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    monkeypatch.setitem(pieces, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "1KB")
    held, metrics = [], jobs.batch_metrics

    def looked_at(parsed, *more):
        held.extend(r["count"] for r in parsed.groupBy(F.spark_partition_id()).count().collect())
        return metrics(parsed, *more)

    monkeypatch.setattr(jobs, "batch_metrics", looked_at)
    tables = run(spark, jobs.document_job, f"{tmp_path}/log", tmp_path)
    assert sum(held) == tables.store.documents().count() == 20_000 and max(held) <= 10_000
    # a small batch is not cut
    held.clear()
    log('{"id":"a"}', '{"id":"b"}').write.parquet(f"{tmp_path}/small")
    run(spark, jobs.document_job, f"{tmp_path}/small", tmp_path / "two")
    assert sum(held) == 2 and len(held) <= 2


def test_a_piece_of_a_batch_is_a_few_megabytes(spark, tmp_path, monkeypatch):
    text = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"x{k}")), 512) for k in range(18)])
    value = F.concat(F.lit('{"id":"u'), F.col("id").cast("string"), F.lit('","t":"'), text, F.lit('"}'))
    rows = spark.range(20_000).select(
        F.lit("t").alias("topic"), F.lit(0).alias("part"), F.col("id").alias("pos"), F.timestamp_seconds("id").alias("ts"), value.alias("value")
    )
    rows.repartition(16).write.parquet(f"{tmp_path}/log")
    held, metrics = [], jobs.batch_metrics

    def looked_at(parsed, *more):
        held.extend(r["count"] for r in parsed.groupBy(F.spark_partition_id()).count().collect())
        return metrics(parsed, *more)

    monkeypatch.setattr(jobs, "batch_metrics", looked_at)
    run(spark, jobs.document_job, f"{tmp_path}/log", tmp_path)
    # 2.3 KB a message, none of which compresses well
    assert sum(held) == 20_000 and max(held) <= 2_000
