from __future__ import annotations

import glob
import json
import random

import pytest

from keyfold.operators import messages
from keyfold.sources.message_log import stream_log
from keyfold.streaming import bulk, jobs
from keyfold.streaming.tables import DIRECT
from tests.test_merge import brute_force, random_messages, upsert

FLAKY = '''
from pyarrow import fs
from keyfold.streaming.bulk import Busy, FileTransport

def flaky(options):
    return Flaky(options)

class Flaky(FileTransport):
    """Busy for the first sends, refuses ids that start with x."""
    def __init__(self, options):
        super().__init__(options)
        self.left = int(options["busy"])

    def send(self, rows):
        if self.left:
            self.left -= 1
            raise Busy()
        super().send([r for r in rows if not r[0].startswith("x")])
        return [(i, "no x") for i, _ in rows if i.startswith("x")]

class Broken(FileTransport):
    """Dies once, halfway through."""
    def send(self, rows):
        super().send(rows)
        marker = f"{self.path}/died"
        if self.files.get_file_info(marker).type == fs.FileType.NotFound:
            self.files.open_output_stream(marker).close()
            raise RuntimeError("connection lost")
        return []
'''


@pytest.fixture
def transport(spark, tmp_path):
    module = tmp_path / "flaky_transport.py"
    module.write_text(FLAKY)
    spark.sparkContext.addPyFile(str(module))
    bulk.register(spark)
    return "flaky_transport"


def sent(path):
    lines = []
    for name in glob.glob(f"{path}/bulk-*.jsonl"):
        with open(name, encoding="utf-8") as handle:
            lines.append([json.loads(line) for line in handle])
    return lines


def outcome(path):
    (name,) = glob.glob(f"{path}/outcome-*.jsonl")
    with open(name, encoding="utf-8") as handle:
        return json.loads(handle.read())


def rows(spark, ids):
    return spark.createDataFrame([(i, json.dumps({"id": i})) for i in ids], "id string, source string").coalesce(1)


def write(frame, path, **options):
    options = {"path": str(path), "transport": "keyfold.streaming.bulk:FileTransport", **options}
    frame.write.format("keyfold_bulk").options(**options).mode("append").save()


def test_bulks_are_cut_by_rows_and_bytes(spark, transport, tmp_path):
    write(rows(spark, [str(i) for i in range(25)]), tmp_path / "a", max_rows="10")
    assert sorted(map(len, sent(tmp_path / "a"))) == [5, 10, 10]
    assert {k: v for k, v in outcome(tmp_path / "a").items() if k in ("rows", "bulks", "failed")} == {
        "rows": 25,
        "bulks": 3,
        "failed": 0,
    }
    write(rows(spark, ["1", "2", "3"]), tmp_path / "b", max_bytes="12")
    assert sorted(map(len, sent(tmp_path / "b"))) == [1, 2]


def test_busy_store_is_asked_again_and_refused_items_are_counted(spark, transport, tmp_path):
    ids = ["a", "x1", "b", "x2"]
    write(rows(spark, ids), tmp_path / "a", transport=f"{transport}:flaky", busy="2", backoff_ms="1")
    assert outcome(tmp_path / "a")["failed"] == 2
    assert sorted(item["id"] for lines in sent(tmp_path / "a") for item in lines) == ["a", "b"]
    with pytest.raises(Exception, match="Busy"):
        write(rows(spark, ids), tmp_path / "b", transport=f"{transport}:flaky", busy="4", backoff_ms="1")


def test_a_repeated_batch_only_repeats_upserts(spark, log, transport, tmp_path):
    log('{"id":"a","x":1}', '{"id":"b","y":2}').write.parquet(f"{tmp_path}/log")
    options = {"path": f"{tmp_path}/out", "transport": f"{transport}:Broken"}
    config = jobs.JobConfig(f"{tmp_path}/tables", sinks=(bulk.bulk_sink(options),))

    def start():
        stream = stream_log(spark, f"{tmp_path}/log")
        jobs.start(stream, jobs.document_job(config), f"{tmp_path}/cp").awaitTermination()

    with pytest.raises(Exception, match="connection lost"):
        start()
    start()
    stored = {}
    for lines in sent(tmp_path / "out"):
        for item in lines:
            upsert(stored.setdefault(item["id"], {}), item["doc"], nested=True, nulls=True)
    assert stored == {"a": {"id": "a", "x": 1}, "b": {"id": "b", "y": 2}}


def written(spark, tmp_path, docs, batch_id=0):
    tables = jobs.JobTables(spark, jobs.JobConfig(f"{tmp_path}/tables"))
    tables.store.write_batch(docs, batch_id)
    return jobs.Written(tables, DIRECT, batch_id)


def in_order(path):
    """The lines of each id in the order they were sent."""
    names = sorted(glob.glob(f"{path}/bulk-*.jsonl"), key=lambda n: int(n.rsplit("-", 1)[1].split(".")[0]))
    for name in names:
        with open(name, encoding="utf-8") as handle:
            yield from map(json.loads, handle)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_partial_updates_leave_an_external_store_with_the_same_documents(spark, log, transport, tmp_path, seed):
    everything = random_messages(random.Random(seed), 160, nested=True)
    docs = messages.documents(messages.parse_messages(log(*map(json.dumps, everything)))).cache()
    stored = {}
    for batch_id, low in enumerate(range(0, 160, 40)):
        path = tmp_path / f"batch{batch_id}"
        sink = bulk.bulk_sink({"path": str(path), "transport": "keyfold.streaming.bulk:FileTransport"})
        sink(written(spark, tmp_path, docs.filter(f"pos BETWEEN {low} AND {low + 39}"), batch_id))
        for item in in_order(path):
            upsert(stored.setdefault(item["id"], {}), item["doc"], nested=True, nulls=True)
    assert stored == brute_force(everything, nested=True)
    docs.unpersist()


def test_resets_are_sent_outer_paths_first_and_only_where_they_still_count(spark, log, transport, tmp_path):
    sent_ = [{"b": 1}, {"b": {"x": 1}}, None, {"c": 1}, {"c": {"d": 2}}, {"c": 3}, {"c": {"e": 4}}]
    docs = messages.documents(messages.parse_messages(log(*[json.dumps({"id": "i", "a": a}) for a in sent_])))
    sink = bulk.bulk_sink({"path": f"{tmp_path}/out", "transport": "keyfold.streaming.bulk:FileTransport"})
    sink(written(spark, tmp_path, docs))
    lines = [item["doc"] for item in in_order(tmp_path / "out")]
    assert lines == [{"a": None}, {"a": {"c": None}}, {"id": "i", "a": {"c": {"e": 4}}}]
    docs = messages.documents(messages.parse_messages(log(*[json.dumps({"id": "i", "a": a}) for a in sent_[:4]])))
    sink = bulk.bulk_sink({"path": f"{tmp_path}/few", "transport": "keyfold.streaming.bulk:FileTransport"})
    sink(written(spark, tmp_path / "few-tables", docs))
    assert [item["doc"] for item in in_order(tmp_path / "few")] == [{"a": None}, {"id": "i", "a": {"c": 1}}]


def test_refused_items_and_their_reasons_are_kept(spark, log, transport, tmp_path):
    log('{"id":"a"}', '{"id":"x1"}', '{"id":"x2"}').write.parquet(f"{tmp_path}/log")
    options = {"path": f"{tmp_path}/out", "transport": f"{transport}:flaky", "busy": "0"}
    config = jobs.JobConfig(f"{tmp_path}/tables", sinks=(bulk.bulk_sink(options, "search"),))
    jobs.start(stream_log(spark, f"{tmp_path}/log"), jobs.document_job(config), f"{tmp_path}/cp").awaitTermination()
    tables = jobs.JobTables(spark, config)
    metrics = tables.metrics.read().first()
    assert (metrics.failed, metrics.sinks, metrics.documents) == (2, ["search"], 3)
    refused = tables.outcome.read().filter("id IS NOT NULL").collect()
    assert sorted((r.sink, r.id, r.reason) for r in refused) == [("search", "x1", "no x"), ("search", "x2", "no x")]
    assert tables.outcome.read().agg({"rows": "sum"}).first()[0] == 3


def test_a_repeated_batch_writes_the_same_files(spark, log, transport, tmp_path):
    docs = messages.documents(messages.parse_messages(log('{"id":"a"}', '{"id":"b"}')))
    batch = written(spark, tmp_path, docs)
    sink = bulk.bulk_sink({"path": f"{tmp_path}/out", "transport": "keyfold.streaming.bulk:FileTransport"})
    sink(batch)
    once = sorted(glob.glob(f"{tmp_path}/out/bulk-*.jsonl"))
    sink(batch)
    assert sorted(glob.glob(f"{tmp_path}/out/bulk-*.jsonl")) == once
    assert sorted(item["id"] for item in in_order(tmp_path / "out")) == ["a", "b"]


def test_as_a_streaming_sink(spark, log, transport, tmp_path):
    log('{"id":"a"}', '{"id":"b"}').write.parquet(f"{tmp_path}/log")
    docs = messages.documents(messages.parse_messages(stream_log(spark, f"{tmp_path}/log")))
    query = (
        docs.selectExpr("id", "value AS source")
        .writeStream.format("keyfold_bulk")
        .options(path=f"{tmp_path}/out", transport="keyfold.streaming.bulk:FileTransport")
        .option("checkpointLocation", f"{tmp_path}/cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(item["id"] for lines in sent(tmp_path / "out") for item in lines) == ["a", "b"]
    assert outcome(tmp_path / "out")["batch_id"] == 0
