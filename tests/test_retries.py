"""Refused items that are sent again."""

from __future__ import annotations

import json
import random

import pytest

from keyfold.operators import messages
from keyfold.sources.message_log import stream_log
from keyfold.streaming import bulk, jobs
from keyfold.streaming.tables import DIRECT
from tests.test_bulk import upsert
from tests.test_merge import brute_force, random_messages

CHOOSY = '''
import json
import os
import time
import uuid

class Choosy:
    """Refuses each item the first ``times`` times it comes; ids that start with z always."""
    def __init__(self, options):
        self.path, self.times = options["path"], int(options["times"])
        os.makedirs(self.path, exist_ok=True)

    def send(self, rows):
        refused = []
        for at, (doc_id, source) in enumerate(rows):
            if doc_id in refused:
                continue
            folder = f"{self.path}/seen-{doc_id}"
            os.makedirs(folder, exist_ok=True)
            if doc_id.startswith("z") or len(os.listdir(folder)) < self.times:
                open(f"{folder}/{uuid.uuid4().hex}", "w").close()
                refused.append(doc_id)
                continue
            with open(f"{self.path}/{time.time_ns()}-{at:06d}.json", "w") as out:
                json.dump([doc_id, json.loads(source)], out)
        return [(doc_id, f"not yet {doc_id}") for doc_id in refused]

    def close(self):
        pass
'''


@pytest.fixture
def choosy(spark, tmp_path):
    module = tmp_path / "choosy_transport.py"
    module.write_text(CHOOSY)
    spark.sparkContext.addPyFile(str(module))
    bulk.register(spark)
    return {"transport": "choosy_transport:Choosy", "path": f"{tmp_path}/out"}


def stored(tmp_path):
    out = {}
    for file in sorted((tmp_path / "out").glob("*.json"), key=lambda f: tuple(map(int, f.stem.split("-")))):
        doc_id, source = json.loads(file.read_text())
        upsert(out.setdefault(doc_id, {}), source, nested=True, nulls=True)
    return out


@pytest.mark.parametrize("committed", [False, True])
def test_a_store_that_refuses_twice_ends_up_complete_and_in_order(spark, log, tmp_path, choosy, committed):
    everything = random_messages(random.Random(5), 90, nested=True)
    docs = messages.documents(messages.parse_messages(log(*map(json.dumps, everything)))).cache()
    sink = bulk.retrying_sink({**choosy, "times": "2"}, limit=9, backoff_seconds=0.0)
    tables = jobs.JobTables(spark, jobs.JobConfig(f"{tmp_path}/tables", committed=committed))
    refused = []
    for batch_id, low in enumerate(range(0, 90, 30)):
        tables.store.write_batch(docs.filter(f"pos BETWEEN {low} AND {low + 29}"), batch_id)
        refused.append(sink(jobs.Written(tables, DIRECT, batch_id)))
    while sink.drain(tables):
        pass
    ids = {m["id"] for m in everything}
    assert refused[0] == refused[1] == len(ids) and refused[2] == 0
    assert stored(tmp_path) == brute_force(everything, nested=True)
    assert tables.dead.read().count() == 0
    docs.unpersist()


def test_what_is_refused_too_often_is_given_up(spark, log, tmp_path, choosy):
    sink = bulk.retrying_sink({**choosy, "times": "1"}, limit=3, backoff_seconds=0.0)
    config = jobs.JobConfig(f"{tmp_path}/tables", sinks=(sink,), committed=True)
    for number in range(4):
        log((0, 10 * number, f'{{"id":"zz","n":{number}}}'), (0, 10 * number + 1, f'{{"id":"a{number}"}}')).write.mode("append").parquet(f"{tmp_path}/log")
        jobs.start(stream_log(spark, f"{tmp_path}/log"), jobs.document_job(config), f"{tmp_path}/cp").awaitTermination()
    tables = jobs.JobTables(spark, config)
    dead = tables.dead.read().collect()
    assert [(r.sink, r.id, json.loads(r.source), r.reason, r.attempts) for r in dead] == [("bulk", "zz", {"id": "zz", "n": 2}, "not yet zz", 3)]
    # given up, it begins anew with its next update
    assert stored(tmp_path) == {f"a{n}": {"id": f"a{n}"} for n in range(3)}
    assert [m.failed for m in tables.metrics.read().orderBy("batch_id").collect()] == [2, 2, 2, 2]


def test_items_wait_their_time(spark, log, tmp_path, choosy):
    sink = bulk.retrying_sink({**choosy, "times": "1"}, limit=5, backoff_seconds=3600.0)
    tables = jobs.JobTables(spark, jobs.JobConfig(f"{tmp_path}/tables"))
    tables.store.write_batch(messages.documents(messages.parse_messages(log('{"id":"a","x":1}', '{"id":"b"}'))), 0)
    assert sink(jobs.Written(tables, DIRECT, 0)) == 2
    # not due, and not sent; an update of one of them takes it along
    assert sink.drain(tables) == 0 and stored(tmp_path) == {}
    tables.store.write_batch(messages.documents(messages.parse_messages(log((0, 5, '{"id":"a","y":2}')))), 1)
    assert sink(jobs.Written(tables, DIRECT, 1)) == 0
    assert stored(tmp_path) == {"a": {"id": "a", "x": 1, "y": 2}}
