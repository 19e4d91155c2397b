from __future__ import annotations

import json

from pyspark.sql import functions as F

from keyfold.operators import messages, profiles, signals


def parsed(log, *values):
    return messages.parse_messages(log(*values))


def signal(flag, **more):
    return json.dumps({"data_source": "tag_operate_queue", "is_last_batch": flag, **more})


def test_last_batch_flag(log):
    values = [signal(f) for f in (1, "1", 1.0, 1.9, True)]
    assert signals.signals(parsed(log, *values)).count() == len(values)
    none = [signal(f) for f in (0, None, "", "0", 2, False, "abc", {"a": 1})]
    assert signals.signals(parsed(log, *none)).count() == 0


def test_bad_flag_is_quarantined_and_null_source_is_no_fault(log):
    frame = parsed(
        log,
        signal("abc"),
        '{"id":"a","data_source":null,"is_last_batch":1}',
        '{"id":"a","data_source":"other","is_last_batch":"abc"}',
        '{"data_source":"tag_operate_queue"}',
        None,
    )
    rejected = messages.rejects(frame, document=messages.document_reason(), signal=signals.signal_reason()).collect()
    assert {(r.pos, r.branch, r.reason) for r in rejected} == {
        (0, "document", "id_missing_or_null"),
        (0, "signal", "bad_int"),
        (3, "document", "id_missing_or_null"),
        (4, "document", "empty"),
        (4, "signal", "empty"),
    }
    assert signals.signals(frame).count() == 0
    assert messages.documents(frame).count() == 2


def test_enrichment_overrides_and_keeps_types(log):
    value = signal(1, tag_id=7, batch_id=None, task_status=9, operate_source="x", n=1, s="1", z=None)
    row = signals.queue_rows(signals.signals(parsed(log, value))).first()
    assert row.queue_name == "tags:task:queue"
    assert json.loads(row.payload) == {
        "data_source": "tag_operate_queue",
        "is_last_batch": 1,
        "n": 1,
        "s": "1",
        "tag_id": "7",
        "operate_source": "tag_system_operate",
        "task_status": 0,
    }


def test_a_signal_with_an_id_is_a_document_too(log):
    frame = parsed(log, signal(1, id="d"))
    assert messages.documents(frame).count() == signals.signals(frame).count() == 1


def test_place_counts_from_the_newest(log):
    values = [signal(1, n=i) for i in range(150)]  # two and a half minutes of signals
    queue = signals.queue_rows(signals.signals(parsed(log, *values)))
    placed = signals.with_place(queue).collect()
    assert sorted((r.place, r.pos) for r in placed) == [(i + 1, 149 - i) for i in range(150)]
    assert [r.pos for r in signals.newest_first(queue).collect()] == list(range(149, -1, -1))


def test_a_burst_is_spread_and_rows_without_a_time_come_last(spark, log):
    values = [signal(1, n=i) for i in range(60)]
    queue = signals.queue_rows(signals.signals(parsed(log, *values)))
    at = F.when(F.col("pos") % 3 != 0, F.lit("2024-01-01").cast("timestamp"))
    queue = queue.withColumn("ts", at).withColumn("part", F.col("pos").cast("int") % 2)
    other = queue.filter("pos < 7").withColumn("queue_name", F.lit("other"))
    twice = signals.distinct_pushes(queue.unionByName(queue).unionByName(other))
    placed = {(r.queue_name, r.pos): r.place for r in signals.with_place(twice).collect()}
    for name, n in ((signals.TASK_QUEUE, 60), ("other", 7)):
        order = sorted(range(n), key=lambda p: (p % 3 == 0, -(p % 2), -p))
        assert {p: placed[name, p] for p in range(n)} == {p: i + 1 for i, p in enumerate(order)}
    assert len(placed) == 67
    plan = signals.with_place(queue)._jdf.queryExecution().optimizedPlan().toString()
    assert "date_trunc" not in plan


def user(**more):
    return json.dumps({"data_source": "s", "app_id": "a", "user_id": "1", **more})


def test_profile_projection(log):
    rows = profiles.profiles(parsed(log, user(nick_name="n", user_created_at="12", user_from=3, other=1, phone=5)))
    row = profiles.profile_json(rows).first()
    assert json.loads(row.source) == {
        "id": "a|1",
        "app_id": "a",
        "user_id": "1",
        "nick_name": "n",
        "user_created_at": 12,
        "user_from": 3,
        "phone": "5",
    }
    assert [f.dataType.simpleString() for f in rows.schema if f.name in ("user_created_at", "user_from")] == ["bigint", "int"]


def test_profile_rejects(log):
    frame = parsed(
        log,
        user(),
        user(data_source=""),
        user(app_id=None),
        '{"data_source":"s","app_id":"a"}',
        user(user_from="x"),
        "[]",
    )
    rejected = messages.rejects(frame, profile=profiles.profile_reason()).collect()
    assert {(r.pos, r.reason) for r in rejected} == {
        (1, "data_source_missing"),
        (2, "app_id_missing"),
        (3, "user_id_missing"),
        (4, "bad_int"),
        (5, "malformed"),
    }
    assert profiles.profiles(frame).count() == 1


def test_profile_upsert(log):
    frame = parsed(log, user(nick_name="n", user_from=3), user(phone="p"), user(app_id="b", nick_name="m"))
    rows = {r.id: r for r in profiles.profile_upsert(profiles.profiles(frame)).collect()}
    assert set(rows) == {"a|1", "b|1"}
    assert (rows["a|1"].nick_name, rows["a|1"].phone, rows["a|1"].user_from) == ("n", "p", 0)
