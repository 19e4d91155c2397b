"""The commit log and the store in levels."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from keyfold.operators import messages
from keyfold.sources.message_log import stream_log
from keyfold.streaming import jobs
from keyfold.streaming.commits import Changes, CommitLog, CommittedTable, Conflict, Transaction
from keyfold.streaming.levels import Buckets, LeveledStore, _runs
from tests.test_merge import brute_force, random_messages


def documents_of(frame):
    return {r.id: json.loads(r.source) for r in frame.collect()}


def docs_of(log, sent):
    return messages.documents(messages.parse_messages(log(*map(json.dumps, sent))))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_the_log_names_what_is_there(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    assert log.state().version == -1
    for number in range(40):
        changes = Changes()
        changes.put("t", f"t/{number}", n=number)
        if number >= 3:
            changes.drop("t", [f"t/{number - 3}"])
        assert log.commit(changes) == number
    for reader in (log, CommitLog(spark, str(tmp_path))):
        assert list(reader.state().entries("t")) == ["t/37", "t/38", "t/39"]
        assert list(reader.state(20).entries("t")) == ["t/18", "t/19", "t/20"]
    log.clean(keep=2)
    assert len(log._names()) < 15
    assert list(CommitLog(spark, str(tmp_path)).state().entries("t")) == ["t/37", "t/38", "t/39"]


def test_two_writers(spark, tmp_path):
    one, two = CommitLog(spark, str(tmp_path)), CommitLog(spark, str(tmp_path))
    first, second, third = Changes(), Changes(), Changes()
    first.put("t", "t/a")
    second.put("t", "t/b")
    assert (one.commit(first), two.commit(second)) == (0, 1)
    first, second = Changes(), Changes()
    first.drop("t", ["t/a"])
    second.drop("t", ["t/a"])
    one.commit(first)
    with pytest.raises(Conflict):
        two.commit(second)
    # the number is taken although the writer does not know yet
    real, two.state = two.state, lambda version=None, calls=[]: real(1) if not calls and not calls.append(1) else real(version)
    third.put("t", "t/c")
    assert two.commit(third) == 3
    assert sorted(one.state().entries("t")) == ["t/b", "t/c"]


def test_a_batch_counts_once_and_direct_writes_always(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    rows = spark.createDataFrame([(1,)], "x int")
    for batch_id in (0, 0, 1, 1, 0):
        transaction = Transaction(log, "r", batch_id)
        table = CommittedTable(log, "t", "x int", lambda transaction=transaction: transaction)
        table.write(rows, batch_id, "r")
        assert table.read_batch(batch_id, "r").count() == 1
        transaction.commit()
    assert table.batches() == [("r", 0), ("r", 1)]
    direct = CommittedTable(log, "t", "x int")
    for number in (5, 3, 3):
        direct.write(rows, number)
    assert direct.read().count() == 5


def test_linear_hashing():
    buckets, seen = Buckets(2), []
    while buckets.base < 16:
        seen.append((buckets.count, buckets.moduli()))
        ids = range(1000)
        # the address of an id: one of count buckets
        addresses = {i % m for i in ids for m in buckets.moduli() if (i % buckets.base < buckets.pointer) == (m != buckets.base)}
        assert len(addresses) == buckets.count
        assert all(buckets.modulus_of(b) in buckets.moduli() for b in addresses)
        buckets = buckets.split()
    assert [c for c, _ in seen] == list(range(2, 16)) and all(len(m) <= 2 for _, m in seen)


@pytest.mark.parametrize("every", [False, True])
def test_folding_changes_nothing_but_the_files(spark, log, tmp_path, every):
    sent = random_messages(random.Random(3), 240, nested=True)
    docs = docs_of(log, sent).cache()
    store = LeveledStore(CommitLog(spark, str(tmp_path)), buckets=2, fan=2, bucket_rows=12)
    cuts = [(0, 60), (40, 90), (80, 120), (20, 50), (120, 160), (160, 200), (200, 240)]
    versions = {}
    for number, (low, high) in enumerate(cuts):
        store.write_batch(docs.filter(F.col("pos").between(low, high - 1)), number)
        store.fold(every)
        versions[number] = store.log.state().version
    assert documents_of(store.documents()) == brute_force(sent, nested=True)
    assert documents_of(store.documents(versions[2])) == brute_force(sent[:120], nested=True)
    assert store.buckets().count > 2
    store.clean(keep=1)
    again = LeveledStore(CommitLog(spark, str(tmp_path)), fan=2)
    assert documents_of(again.documents()) == brute_force(sent, nested=True)
    assert {r.id for r in again.state().collect()} == {m["id"] for m in sent}
    ids = sorted({m["id"] for m in sent})[:3]
    want = {i: brute_force(sent, nested=True)[i] for i in ids}
    assert documents_of(again.get_many([*ids, "no such id"])) == want
    assert documents_of(again.get_joined(spark.createDataFrame([(i,) for i in [*ids, *ids, "none"]], "id string"))) == want
    docs.unpersist()


def test_buckets_split_under_load_and_reads_do_not_shuffle(spark, log, tmp_path):
    sent = [{"id": f"d{i}", "x": i} for i in range(400)]
    docs = docs_of(log, sent).cache()
    store = LeveledStore(CommitLog(spark, str(tmp_path)), buckets=2, fan=2, bucket_rows=50)
    counts = []
    for number in range(8):
        store.write_batch(docs.filter(F.col("pos").between(50 * number, 50 * number + 49)), number)
        store.fold(every=True)
        counts.append(store.buckets().count)
    assert counts[0] == 2 and counts == sorted(counts) and counts[-1] == 16
    assert documents_of(store.documents()) == {m["id"]: m for m in sent}
    # an id is in one bucket of each run, the one its hash says
    for run in _runs(store.log.state()):
        rows = spark.read.parquet(f"{tmp_path}/{run.entry}").select(F.pmod(F.hash("id"), F.lit(run.modulus)).alias("b"))
        assert {r.b for r in rows.collect()} == {run.bucket}
    assert "Exchange" not in plan_of(store.documents()) and "Bucketed: true" in plan_of(store.documents())
    store.write(docs_of(log, [{"id": "d7", "y": 1}]))
    moduli = len(store.buckets().moduli())
    assert plan_of(store.documents()).count("Exchange") == moduli and "BroadcastExchange" not in plan_of(store.documents())
    # of a few ids only the buckets are read
    one = store.get_many(["d7"])
    files = [f for f in one.inputFiles() if "/runs/" in f]
    assert {f.rsplit("/bucket=", 1)[1].split("/")[0] for f in files} == {str(r.bucket) for r in _runs(store.log.state()) if f"{r.entry}/" in "".join(files)}
    assert len(files) <= len({r.folder for r in _runs(store.log.state())})
    assert documents_of(one) == {"d7": {"id": "d7", "x": 7, "y": 1}}
    assert [r.token for r in store.get("d7", ("y",)).collect()] == ["1"]
    docs.unpersist()


def test_a_changed_id_writes_its_bucket_alone(spark, log, tmp_path):
    store = LeveledStore(CommitLog(spark, str(tmp_path)), buckets=8, fan=2)
    store.write(docs_of(log, [{"id": f"d{i}", "x": i} for i in range(200)]))
    store.fold(every=True)
    before = store.log.state().entries("runs")
    assert len(before) == 8
    store.write(docs_of(log, [{"id": "d5", "y": 2}]))
    store.fold(every=True)
    after = store.log.state().entries("runs")
    # the bucket of that id was merged, seven are the files they were
    assert len(set(before) & set(after)) == 7 and len(after) == 8
    assert {after[e]["level"] for e in set(after) - set(before)} == {2}


def test_rows_are_written_as_often_as_the_logarithm_says(spark, log, tmp_path):
    batches, fan = 27, 3
    docs = docs_of(log, [{"id": f"d{i}", "x": i} for i in range(batches * 4)]).cache()
    store = LeveledStore(CommitLog(spark, str(tmp_path)), buckets=1, fan=fan)
    written = 0
    for number in range(batches):
        store.write_batch(docs.filter(F.col("pos").between(4 * number, 4 * number + 3)), number)
        known = set()
        store.fold()
        log_ = store.log
        for version in range(log_.state().version + 1):
            known |= {(e, p["rows"]) for e, p in log_.state(version).entries("runs").items()}
    written = sum(n for _, n in known)
    # two rows a document; each is written once a level: 27 batches make 3 levels of runs
    assert written == 2 * 4 * batches * 3
    docs.unpersist()


def test_writes_at_any_time_are_kept(spark, log, tmp_path):
    """Numbers of writes outside a stream mean nothing: whatever was folded before, later writes count."""
    store = LeveledStore(CommitLog(spark, str(tmp_path)), fan=2, buckets=2)
    for number, name in ((5, "a"), (0, "b"), (3, "c"), (0, "d")):
        store.write_batch(docs_of(log, [{"id": name}]), number)
        store.fold(every=True)
        store.clean(keep=1)
    assert sorted(documents_of(store.documents())) == ["a", "b", "c", "d"]


def test_an_empty_store(spark, tmp_path):
    store = LeveledStore(CommitLog(spark, f"{tmp_path}/none"))
    assert store.documents().count() == 0 and not store.fold(every=True)
    assert store.get_many(["a"]).collect() == []


def test_a_job_that_fails_after_any_write_shows_nothing(spark, log, tmp_path, monkeypatch):
    """After each single write of a batch the job is stopped: all tables stay at the batch before."""
    sent = [(0, 0, '{"id":"a","x":1}'), (1, 0, "junk"), (0, 1, '{"data_source":"tag_operate_queue","is_last_batch":1}')]
    more = [(0, 2, '{"id":"a","y":2}'), (1, 1, "[]"), (0, 3, '{"data_source":"tag_operate_queue","is_last_batch":1,"n":2}')]
    config = jobs.JobConfig(f"{tmp_path}/tables", committed=True, buckets=2)
    names = ("store", "queue", "quarantine", "metrics", "ledger")

    def start():
        stream = stream_log(spark, f"{tmp_path}/log")
        jobs.start(stream, jobs.document_job(config), f"{tmp_path}/checkpoint").awaitTermination()

    def seen():
        tables = jobs.JobTables(spark, config)
        whole = [tables.store.documents(), *(getattr(tables, n).read().drop("updated_at", "ms") for n in names[1:])]
        return [sorted(map(str, frame.collect())) for frame in whole], tables.log.state().version

    log(*sent).write.parquet(f"{tmp_path}/log")
    start()
    before = seen()
    assert [len(rows) for rows in before[0]] == [1, 1, 3, 1, 2]
    log(*more).write.mode("append").parquet(f"{tmp_path}/log")
    real, left = CommittedTable.write, [0]

    def write(self, *args):
        real(self, *args)
        left[0] -= 1
        if left[0] == 0:
            raise RuntimeError("stopped")

    monkeypatch.setattr(CommittedTable, "write", write)
    for after in range(1, 6):
        left[0] = after
        with pytest.raises(Exception, match="stopped"):
            start()
        assert seen() == before
    left[0] = -1
    start()
    rows, version = seen()
    assert [len(r) for r in rows] == [1, 2, 6, 2, 4] and version == before[1] + 1
    # a batch whose acknowledgement was lost is not written twice
    tables = jobs.JobTables(spark, config)
    run, batch_id = tables.metrics.batches()[-1]
    with tables.batch(run, batch_id) as fresh:
        assert not fresh


def test_a_batch_outside_a_stream_is_no_job(spark, log, tmp_path):
    with pytest.raises(RuntimeError, match="streaming query"):
        jobs.document_job(jobs.JobConfig(f"{tmp_path}/tables"))(log('{"id":"a"}'), 0)
