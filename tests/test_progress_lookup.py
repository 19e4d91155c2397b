from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from keyfold.__main__ import arguments, job_config, kafka_source_options
from keyfold.operators import lookup, merge, messages, progress
from keyfold.sources import message_log
from keyfold.streaming import jobs


def entries(spark, rows, batch_id=0, at="2024-01-01 00:00:00"):
    ranges = spark.createDataFrame(rows, "topic string, part int, from_pos bigint, until_pos bigint")
    return progress.ledger_entries(ranges, "app", "g1", F.lit(at).cast("timestamp"), batch_id)


def test_offset_ranges(log):
    frame = log((0, 5, "a"), (0, 9, None), (1, 0, ""))
    rows = {(r.topic, r.part): (r.from_pos, r.until_pos) for r in progress.offset_ranges(frame).collect()}
    assert rows == {("t", 0): (5, 10), ("t", 1): (0, 1)}


def test_last_write_wins_and_load_filters(spark):
    log = entries(spark, [("t", 0, 0, 10), ("t", 1, 0, 5)]).unionByName(
        entries(spark, [("t", 0, 10, 12)], 1, "2024-01-02 00:00:00")
    )
    loaded = {r.part: r.until_pos for r in progress.load_ledger(log, "app", "g1", "t").collect()}
    assert loaded == {0: 12, 1: 5}
    assert progress.load_ledger(log, "app", "g2", "t").count() == 0


def test_idle_partitions_are_carried_forward(spark):
    before = entries(spark, [("t", 0, 0, 10), ("t", 1, 0, 5)])
    now = entries(spark, [("t", 0, 10, 12)], 3, "2024-01-02 00:00:00")
    rows = {r.part: (r.until_pos, str(r.updated_at), r.batch_id) for r in progress.carry_forward(before, now).collect()}
    assert rows == {0: (12, "2024-01-02 00:00:00", 3), 1: (5, "2024-01-02 00:00:00", 3)}


def test_text_keys(spark):
    store = spark.createDataFrame(
        [("app:g1:t:0", "10"), ("app:g1:t:1", ""), ("app:g1:t:x", "3"), ("app:g1:t2:4", "7")], "key string, value string"
    )
    rows = {r.part: r.until_pos for r in progress.parse_ledger_keys(store, "app", "g1", "t").collect()}
    assert rows == {0: 10, 1: None}
    keys = progress.ledger_keys(entries(spark, [("t", 3, 0, 10)])).first()
    assert (keys.key, keys.value) == ("app:g1:t:3", "10")


def test_expiry_is_two_days_after_the_last_write(spark):
    ledger = entries(spark, [("t", 0, 0, 10)])

    def alive(at):
        return progress.live_ledger(ledger, F.lit(at).cast("timestamp")).count()

    assert alive("2024-01-02 23:59:59") == 1
    assert alive("2024-01-03 00:00:00") == 0


@pytest.mark.parametrize(("policy", "missing"), [("latest", -1), ("earliest", -2)])
def test_start_positions(spark, policy, missing):
    partitions = spark.range(3).select(F.col("id").cast("int").alias("part"))
    stored = spark.createDataFrame([(0, 10), (1, None)], "part int, until_pos bigint")
    positions = progress.start_positions(partitions, stored, policy)
    assert json.loads(progress.starting_offsets("t", positions)) == {"t": {"0": 10, "1": missing, "2": missing}}


def test_kafka_options_from_the_ledger(spark, tmp_path):
    # The broker itself cannot run here; what is passed to the source is checked instead.
    args = arguments(
        ["documents", "--root", str(tmp_path), "--checkpoint", "c", "--servers", "h:1", "--topic", "t"]
        + ["--partitions", "2", "--rate", "100", "--interval", "5"]
    )
    tables = jobs.JobTables(spark, jobs.JobConfig(str(tmp_path)))
    tables.ledger.write(entries(spark, [("t", 1, 0, 8)]), 0)
    assert kafka_source_options(tables, args) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": '{"t": {"0": -1, "1": 8}}',
        "kafka.group.id": "g1",
        "maxOffsetsPerTrigger": "1000",
    }
    with pytest.raises(progress.UnknownPartitions, match="partition 1, beyond the 1 given"):
        kafka_source_options(tables, arguments([*KAFKA, "--partitions", "1"]))
    with pytest.raises(progress.UnknownPartitions, match="say how many"):
        kafka_source_options(tables, arguments(KAFKA))
    # a ledger without positions needs no number: the source takes whatever partitions there are
    nothing = jobs.JobTables(spark, jobs.JobConfig(f"{tmp_path}/nothing"))
    assert kafka_source_options(nothing, arguments([*KAFKA, "--start", "earliest"]))["startingOffsets"] == "earliest"


KAFKA = ["documents", "--root", "r", "--checkpoint", "c", "--servers", "h:1", "--topic", "t"]


@pytest.mark.parametrize(
    "wrong",
    [
        ["documents", "--root", "r", "--checkpoint", "c"],
        [*KAFKA, "--messages", "m"],
        [*KAFKA, "--rate", "5"],
        ["documents", "--root", "r", "--checkpoint", "c", "--messages", "m", "--rate", "5"],
        [*KAFKA, "--sink", "m:f", "--sink-option", "path"],
    ],
)
def test_arguments_that_would_be_ignored_are_errors(wrong):
    with pytest.raises(SystemExit):
        arguments(wrong)


def test_runner_options():
    args = arguments([*KAFKA, "--order", "log", "--flat", "--unquoted-names", "--compact-every", "5", "--sink", "m:f", "--sink-option", "path=/x=y"])
    config = job_config(args)
    assert (config.order, config.nested, config.unquoted_names, config.compact_every) == (merge.LOG_ORDER, False, True, 5)
    assert config.sinks[0].options == {"transport": "m:f", "path": "/x=y"}


def test_kafka_records_become_messages(spark):
    schema = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
    records = spark.createDataFrame([(None, bytearray("é".encode()), "t", 2, 7, None)], schema)
    row = message_log.from_kafka(records).first()
    assert (row.topic, row.part, row.pos, row.value) == ("t", 2, 7, "é")


def test_triggers_and_caps():
    assert message_log.trigger(None) == {"availableNow": True}
    assert message_log.trigger(5) == {"processingTime": "5 seconds"}
    assert message_log.offsets_per_trigger(10, 4, 0.5) == 20


def test_lookups(spark, log):
    docs = messages.documents(
        messages.parse_messages(log('{"id":"a","latest_days_visited_at":3,"x":1}', '{"id":"b","visited_products":[1]}'))
    )
    fields = merge.field_text(merge.field_merge(docs))
    assert [(r.field, r.val) for r in lookup.point_get(fields, "a").collect()] == [("latest_days_visited_at", "3")]
    assert lookup.point_get(fields, "nobody").count() == 0
    ids = spark.createDataFrame([("a",), ("a",), ("nobody",)], "id string")
    sources = merge.merged_documents(merge.field_merge(docs))
    assert [r.id for r in lookup.multi_get(sources, ids).collect()] == ["a"]


def test_pattern_get_returns_each_key_once(spark):
    store = spark.createDataFrame([("k:1", "a"), ("k:1", "a"), ("k:2", "b"), ("x", "c")], "key string, value string")
    found = lookup.pattern_get(store, "k:*")
    assert sorted((r.key, r.value) for r in found.collect()) == [("k:1", "a"), ("k:2", "b")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "StartsWith" in plan
