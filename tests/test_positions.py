"""The log as a stream of positions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keyfold.__main__ import arguments, main, stored_positions
from keyfold.operators import progress
from keyfold.sources.message_log import stream_log
from keyfold.sources.positions import stream_positions
from keyfold.streaming import jobs, monitor
from keyfold.streaming.tables import BatchTable


def message(part: int, pos: int) -> tuple[int, int, str]:
    return part, pos, f'{{"id":"p{part}-{pos}"}}'


def work_off(spark, path, root, checkpoint, **options):
    config = jobs.JobConfig(f"{root}/tables", committed=True)
    stream = stream_positions(spark, path, checkpoint, **options)
    query = jobs.start(stream, jobs.document_job(config), checkpoint, interval_seconds=0)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return jobs.JobTables(spark, config)


def read_so_far(tables):
    return sorted(r.id for r in tables.store.documents().collect())


def batches_of(tables):
    return [r.messages for r in tables.metrics.read().orderBy("run", "batch_id").collect()]


def test_each_partition_is_capped_by_itself(spark, log, tmp_path):
    hot = [message(0, i) for i in range(50)]
    log(*hot, message(1, 0), message(1, 1), message(2, 7)).repartition(3).write.parquet(f"{tmp_path}/log")
    tables = work_off(spark, f"{tmp_path}/log", tmp_path, f"{tmp_path}/cp", positions_per_trigger=20)
    # the hot partition takes three batches, the others are done in the first: 20 and 2 and 1 messages
    assert batches_of(tables) == [23, 20, 10]
    assert len(read_so_far(tables)) == 53
    ledger = progress.load_ledger(tables.ledger.read(), "app", "g1", "t").collect()
    assert {r.part: r.until_pos for r in ledger} == {0: 50, 1: 2, 2: 8}


def test_a_checkpoint_goes_on_under_the_cap(spark, log, tmp_path):
    path, checkpoint = f"{tmp_path}/log", f"{tmp_path}/cp"
    log(*[message(0, i) for i in range(30)]).write.parquet(path)
    work_off(spark, path, tmp_path, checkpoint, positions_per_trigger=10)
    # a new partition, and old positions again
    more = [message(0, i) for i in range(25, 45)] + [message(3, i) for i in range(12)]
    log(*more).write.mode("append").parquet(path)
    tables = work_off(spark, path, tmp_path, checkpoint, positions_per_trigger=10)
    assert batches_of(tables) == [10, 10, 10, 20, 7]
    assert len(read_so_far(tables)) == 57


def test_a_new_checkpoint_starts_at_the_ledger(spark, log, tmp_path):
    path = f"{tmp_path}/log"
    log(*[message(p, i) for p in range(2) for i in range(10)]).write.parquet(path)
    tables = work_off(spark, path, tmp_path, f"{tmp_path}/cp0")
    stored = progress.load_ledger(tables.ledger.read(), "app", "g1", "t")
    starting = {r.part: r.until_pos for r in stored.collect()}
    log(*[message(p, i) for p in range(3) for i in range(10, 15)]).write.mode("append").parquet(path)
    tables = work_off(spark, path, tmp_path, f"{tmp_path}/cp1", starting=starting)
    # the third partition is new and read from its beginning; nothing was read twice
    assert sorted(batches_of(tables)) == [15, 20]
    assert len(read_so_far(tables)) == 35


def test_latest_leaves_out_what_is_there(spark, log, tmp_path):
    path = f"{tmp_path}/log"
    log(*[message(0, i) for i in range(10)]).write.parquet(path)
    tables = work_off(spark, path, tmp_path, f"{tmp_path}/cp", policy="latest")
    assert batches_of(tables) == []
    log(message(0, 10)).write.mode("append").parquet(path)
    tables = work_off(spark, path, tmp_path, f"{tmp_path}/cp", policy="latest")
    assert read_so_far(tables) == ["p0-10"]


@pytest.mark.parametrize("parts", [1, 4])
def test_a_range_is_read_from_the_row_groups_it_needs(spark, log, tmp_path, parts):
    path = f"{tmp_path}/log"
    frame = log(*[message(p, i) for p in range(4) for i in range(25)])
    frame.repartitionByRange(parts, "part").sortWithinPartitions("part", "pos").write.parquet(path)
    starting = {0: 20, 1: 25, 2: 0, 3: 24}
    tables = work_off(spark, path, tmp_path, f"{tmp_path}/cp", starting=starting)
    want = frame.filter(F.expr("pos >= element_at(map(0, 20, 1, 25, 2, 0, 3, 24), part)"))
    assert batches_of(tables) == [31] and len(read_so_far(tables)) == want.count()


def runner(tmp_path, checkpoint, *more):
    return ["documents", "--messages", f"{tmp_path}/log", "--root", f"{tmp_path}/out", "--checkpoint", checkpoint, "--max-positions", "10", "--committed", *more]


def test_the_runner_reads_positions(spark, log, tmp_path):
    log(*[message(p, i) for p in range(2) for i in range(15)]).write.parquet(f"{tmp_path}/log")
    main(runner(tmp_path, f"{tmp_path}/cp0"))
    log(*[message(p, i) for p in range(2) for i in range(15, 18)]).write.mode("append").parquet(f"{tmp_path}/log")
    main(runner(tmp_path, f"{tmp_path}/cp1"))
    tables = jobs.JobTables(spark, jobs.JobConfig(f"{tmp_path}/out", committed=True))
    assert sorted(batches_of(tables)) == [6, 10, 20] and len(read_so_far(tables)) == 36


def test_an_idle_ledger_is_forgotten(spark, log, tmp_path):
    """Three days without a batch: with an age of two, a new checkpoint starts as if there were no ledger."""
    tables = jobs.JobTables(spark, jobs.JobConfig(f"{tmp_path}/out", committed=True))
    idle = spark.sql("SELECT 'app' prefix, 'g1' group_id, 't' topic, 0 part, 8L until_pos, timestamp'2024-01-01 00:00:00' updated_at")
    tables.ledger.write(idle)
    for expire, days, want in (("172800", 3, {}), ("172800", 1, {0: 8}), ("0", 3, {0: 8})):
        args = arguments(runner(tmp_path, "c", "--expire", expire))
        as_of = F.lit(f"2024-01-0{1 + days} 00:00:01").cast("timestamp")
        assert {r.part: r.until_pos for r in stored_positions(tables, args, "t", as_of).collect()} == want
    log(*[message(0, i) for i in range(10)]).write.parquet(f"{tmp_path}/log")
    main(runner(tmp_path, f"{tmp_path}/cp", "--expire", "172800"))
    assert len(read_so_far(jobs.JobTables(spark, jobs.JobConfig(f"{tmp_path}/out", committed=True)))) == 10


def test_replays_are_dropped_while_streaming(spark, log, tmp_path):
    path = f"{tmp_path}/log"
    signal = '{"data_source":"tag_operate_queue","is_last_batch":1,"n":%d}'
    config = jobs.JobConfig(f"{tmp_path}/tables")
    for batch in ([(0, i, signal % i) for i in range(6)], [(0, i, signal % i) for i in range(3, 9)] * 2, [(1, 3, signal % 3), (0, 0, signal % 0)]):
        log(*batch).write.mode("append").parquet(path)
        stream = jobs.without_replays(stream_log(spark, path), "1 day")
        jobs.start(stream, jobs.document_job(config), f"{tmp_path}/cp").awaitTermination()
    queue = jobs.JobTables(spark, config).queue.read()
    assert sorted((r.part, r.pos) for r in queue.collect()) == [*((0, i) for i in range(9)), (1, 3)]


def test_messages_without_a_position_are_no_replays(spark, tmp_path):
    rows = spark.sql("SELECT 't' topic, CAST(null AS int) part, 1L pos, timestamp'2024-01-01' ts, '{\"id\":\"a\"}' value FROM range(3)")
    rows.write.parquet(f"{tmp_path}/log")
    stream = jobs.without_replays(stream_log(spark, f"{tmp_path}/log"), "1 day")
    seen = []
    jobs.start(stream, lambda batch, _: seen.append(batch.count()), f"{tmp_path}/cp").awaitTermination()
    assert sum(seen) == 3


def test_a_listener_writes_what_each_batch_did(spark, log, tmp_path):
    log(*[message(0, i) for i in range(25)], message(1, 0)).write.parquet(f"{tmp_path}/log")
    table = BatchTable(spark, f"{tmp_path}/progress", monitor.PROGRESS_SCHEMA)
    listener = monitor.ProgressListener({"watched": table}.get)
    spark.streams.addListener(listener)
    try:
        for name in ("watched", "other"):
            stream = stream_positions(spark, f"{tmp_path}/log", f"{tmp_path}/{name}", positions_per_trigger=10)
            jobs.work_off(stream, jobs.document_job(jobs.JobConfig(f"{tmp_path}/tables-{name}")), f"{tmp_path}/{name}", name)
        monitor.settled(spark)
    finally:
        spark.streams.removeListener(listener)
    rows = table.read().orderBy("batch_id").collect()
    assert [(r.name, r.batch_id, r.messages) for r in rows] == [("watched", 0, 11), ("watched", 1, 10), ("watched", 2, 5)]
    assert all(r.ms >= r.write_ms > 0 and r.messages_per_second > 0 for r in rows)


@pytest.mark.parametrize(
    "reached, latest, lag",
    [
        ('{"0": 5, "1": 7}', '{"0": 9, "1": 7, "2": 1}', 5),
        ('{"t":{"0":5}}', '{"t":{"0":8,"1":2}}', 5),
        ('{"0": 5}', None, None),
        ('{"logOffset":3}', "no json", None),
        ("{}", '{"0": 1}', None),
    ],
)
def test_lag_in_positions(reached, latest, lag):
    assert monitor.lag_of(reached, latest) == lag
