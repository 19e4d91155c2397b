from __future__ import annotations

import os
from collections import Counter

import pytest

import corpus_pipeline
from keyfold.llm import packing, quality
from keyfold.llm.common import documents
from keyfold.llm.queries import ORACLES, QUERIES
from tests.llm.tables import counted, messy_rows, normal, split, weighted_similarity, written
from tests.oracle_check import compare, duck

GIVEN = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]


@pytest.fixture
def tables(spark, tmp_path):
    if not os.path.isdir(GIVEN):
        pytest.skip("no given tables")
    rows = [(None if r[0] is None else r[0] + 10_000, *r[1:]) for r in messy_rows()]
    given = documents(spark, GIVEN)
    docs = given.unionByName(spark.createDataFrame(rows, given.schema))
    written(docs, tmp_path / "documents.parquet")
    written(spark.read.parquet(f"{GIVEN}/labels.parquet"), tmp_path / "labels.parquet")
    return str(tmp_path)


def test_each_stage_does_its_work_on_what_it_gets(spark, tables, tmp_path):
    docs = documents(spark, tables)
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = written(stage(spark, docs, tables), tmp_path / f"out-{name}")
        seen[name] = before, docs.collect()
        if name != "packing":
            assert docs.columns == columns

    before, after = seen["quality"]
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    model = quality.fit(*quality.labelled_sample(documents(spark, tables), labels))
    scores = quality.scored(documents(spark, tables), model)
    assert counted(after) == counted(tuple(r.kept) for r in scores.filter("score >= 0.3").collect())
    assert 0 < len(after) < len(before)

    before, after = seen["exact_dedup"]
    best = {}
    for r in before:
        key = normal(r.text)
        rank = (-len(r.text or ""), r.doc_id is None, r.doc_id or 0)
        best[key] = min(best.get(key, (rank,)), (rank,))
    assert sorted((-len(r.text or ""), r.doc_id is None, r.doc_id or 0) for r in after) == sorted(b[0] for b in best.values())
    assert not counted(after) - counted(before)

    before, after = seen["near_dedup"]
    assert not counted(after) - counted(before)
    kept = [r.text or "" for r in after]
    lost = list((Counter(r.text or "" for r in before) - Counter(kept)).elements())
    assert all(weighted_similarity(a, b) < 0.8 for i, a in enumerate(kept) for b in kept[:i] if split(a) and split(b))
    pool = [r.text or "" for r in before]
    assert all(any(t is not o and weighted_similarity(t, o) >= 0.8 for o in pool) for t in lost if split(t))

    before, after = seen["mixing"]
    times, there = counted(after), counted(before)
    assert set(times) <= set(there) and all(times[r] <= 3 * there[r] for r in times)
    sizes = sum(len(split(r.text)) for r in before)
    assert abs(sum(len(split(r.text)) for r in after) - sizes) < 0.2 * sizes

    before, after = seen["packing"]
    assert sum(r.length for r in after) == sum(
        r.doc_tokens for r in packing.packed(docs_of(spark, tmp_path)).filter("start = 0").collect()
    )
    assert len({r.sequence_id for r in after}) == len(after)


def docs_of(spark, folder):
    return spark.read.parquet(str(folder / "out-mixing"))


def test_run(spark, tables):
    assert corpus_pipeline.run(spark, tables).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_duckdb(spark, name):
    if not os.path.isdir(GIVEN):
        pytest.skip("no given tables")
    rows, differing = compare(spark, duck(GIVEN), name, QUERIES[name], ORACLES[name], GIVEN)
    assert rows == documents(spark, GIVEN).count() and differing == []
