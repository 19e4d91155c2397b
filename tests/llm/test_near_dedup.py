from __future__ import annotations

import random
import sys

import numpy as np
import pytest
import zstandard

from keyfold.llm import near_dedup
from keyfold.llm.components import components
from tests.llm.tables import SCHEMA, changed, counted, messy, messy_rows, near_classes, prose, shingles, split, weighted_similarity, written


def expected_groups(rows):
    roots = near_classes(rows)
    members = {}
    for at, root in enumerate(roots):
        members.setdefault(root, []).append(at)
    out = []
    for own in members.values():
        ids = [rows[i][0] for i in own]
        smallest = min((d for d in ids if d is not None), default=None)
        out += [(d, smallest, len(own)) for d in ids]
    return counted(out), len(members)


def check(found, rows):
    groups, n = expected_groups(rows)
    assert counted((r.doc_id, r.class_id, r.group_size) for r in found) == groups
    assert sum(r.kept for r in found) == n
    assert all(r.doc_id == r.class_id for r in found if r.kept)


def test_groups(spark):
    check(near_dedup.near_groups(messy(spark)).collect(), messy_rows())


def cluster_rows(n: int = 130) -> list[tuple]:
    """A large group around one text at all similarities, copies of copies, and a passage in many other texts."""
    rng = random.Random(9)
    base = prose(50, 260)
    texts = [base, *(changed(base, 500 + i, rng.randrange(1, 22)) for i in range(n))]
    texts += [changed(rng.choice(texts[1:]), 900 + i, 2) for i in range(20)]
    passage = prose(51, 60)
    texts += [prose(2000 + i, 60) + " " + passage for i in range(90)]
    texts += [changed(texts[-1 - i], 990 + i, 1) for i in range(5)]
    return [(i, t, None, "s", 0) for i, t in enumerate(texts)]


@pytest.mark.parametrize("small", [64, 4])
def test_a_large_group_loses_no_link(spark, monkeypatch, small):
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", small)
    rows = cluster_rows()
    check(near_dedup.near_groups(messy(spark, rows=rows)).collect(), rows)


def form_rows(n: int = 260, pairs: int = 60) -> list[tuple]:
    """One form filled in by many, 0.75 to 0.79 alike, and pairs at 0.80 to 0.85 that have some of the filling
    in common. Row ``2 i`` and ``2 i + 1`` are a pair, as far as there are pairs."""
    rng = random.Random(17)
    form = " ".join(f"form{i}" for i in range(304))
    texts = []
    for i in range(n):
        own = [f"own{i}x{j}" for j in range(rng.randrange(40, 49))]
        if i < pairs:
            common = len(own) - 36 + i % 6
            texts += [form + " " + " ".join(own[:common] + [f"{side}{w}" for w in own[common:]]) for side in "ab"]
        else:
            texts.append(form + " " + " ".join(own))
    return [(i, t, None, "s", 0) for i, t in enumerate(texts)]


@pytest.mark.parametrize("crowd", [1024, 16])
def test_a_crowd_hides_no_pair(spark, monkeypatch, crowd):
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    rows = form_rows()
    own = [shingles(t) for _, t, *_ in rows]
    alike = {}
    for i, a in enumerate(own):
        for j in range(i):
            common = sum((a & own[j]).values())
            alike[j, i] = common / (sum(a.values()) + sum(own[j].values()) - common)
    linked = {p for p, x in alike.items() if x >= 0.8}
    assert linked == {(i, i + 1) for i in range(0, 120, 2)}
    assert all(x < 0.86 if p in linked else 0.74 < x < 0.8 for p, x in alike.items())
    found = near_dedup.near_groups(messy(spark, rows=rows)).collect()
    assert {(r.doc_id, r.class_id) for r in found if r.doc_id != r.class_id} == {(b, a) for a, b in linked}


def test_rare_shingles_bring_all_similar_pairs_together(spark):
    rows = cluster_rows(60) + [(1000, "x y " * 40, None, "s", 0), (1001, "x y " * 45, None, "s", 0), (1002, "x y " * 60, None, "s", 0)]
    texts = spark.createDataFrame(
        [(i, i, zstandard.ZstdCompressor().compress(r[1].lower().encode())) for i, r in enumerate(rows)],
        "row bigint, label bigint, packed binary",
    )
    own = [shingles(r[1]) for r in rows]
    similar = set()
    for i, a in enumerate(own):
        for j in range(i):
            common = sum((a & own[j]).values())
            if common >= 0.8 * (sum(a.values()) + sum(own[j].values()) - common):
                similar.add((j, i))
    pairs = [tuple(r) for r in near_dedup._sharing_rare(texts).collect()]
    assert len(similar) > 100 and similar <= set(pairs) and len(pairs) == len(set(pairs))


def test_one_document_of_each_group_stays(spark, tmp_path):
    docs = written(messy(spark), tmp_path / "docs")
    found = near_dedup.without_near_copies(docs)
    assert found.columns == docs.columns
    assert found.count() == expected_groups(messy_rows())[1]
    texts = [r.text or "" for r in found.collect()]
    assert all(
        weighted_similarity(a, b) < 0.8 for i, a in enumerate(texts) for b in texts[:i] if split(a) and split(b)
    )


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(3)
    for overlap in (0.3, 0.8):
        same = int(400 * overlap)
        first = {i: float(rng.integers(1, 9)) for i in range(400)}
        second = {i if i < same else i + 1000: w if i % 3 else w + 0.5 for i, w in first.items()}
        common = sum(min(w, second.get(i, 0.0)) for i, w in first.items())
        truth = common / (sum(first.values()) + sum(second.values()) - common)
        rows = np.repeat([0, 1], [len(first), len(second)])
        elements = np.array([*first, *second], np.uint64)
        weights = np.array([*first.values(), *second.values()])
        found = near_dedup.signatures(rows, elements * np.uint64(0x9E3779B97F4A7C15), weights, 2, 1024)
        assert abs((found[0] == found[1]).mean() - truth) < 0.06


def test_signatures_do_not_depend_on_company():
    texts = [prose(i, 5 + 40 * i).encode() for i in range(6)] + [b"", b"one"]

    def signed(some):
        row, shingle, count = near_dedup.weighted_shingles(some)
        return near_dedup.signatures(row, shingle, count.astype(float), len(some))

    together = signed(texts)
    for at, text in enumerate(texts):
        assert (signed([text])[0] == together[at]).all()
    assert not together[6].any() and together[7].any()


def test_exact_similarity():
    for a, b in ((prose(1, 80), changed(prose(1, 80), 2, 3)), ("a b", "a b"), ("a", "b"), ("x y " * 40, "x y " * 50)):
        assert near_dedup.similarity(a.encode(), b.encode()) == pytest.approx(weighted_similarity(a, b))
    assert sum(shingles("a b c d e f").values()) == 2


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200 + rng.randrange(60), 200 + rng.randrange(60)) for _ in range(40)]
    root = {n: n for p in pairs for n in p}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    found = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert counted(found) == counted((n, find(n)) for n in linked)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_go_on_from_what_is_known(spark, monkeypatch):
    def linked(*pairs):
        return spark.createDataFrame(pairs, "a bigint, b bigint") if pairs else spark.createDataFrame([], "a bigint, b bigint")

    first = [(5, 6), (6, 7), (10, 11), (20, 21)]
    known = components(linked(*first))
    for new in ([], [(6, 7), (21, 20)], [(7, 10), (11, 3), (30, 31)], [(2, 9), (9, 8)]):
        assert counted(components(linked(*new), known).collect()) == counted(components(linked(*first, *new)).collect())
    # what is a star as it stands is written once, and again with its roots
    module, written = sys.modules[components.__module__], []
    monkeypatch.setattr(module, "stored", lambda rows, name, write=module.stored: written.append(name) or write(rows, name))
    assert components(linked(*[(100, 101 + i) for i in range(9)])).count() == 10
    assert written == ["links", "labels"]


def test_shingles_are_counted_in_few_rows(spark):
    texts = [prose(700 + i % 250, 60) for i in range(300)]
    rows = spark.createDataFrame([(zstandard.ZstdCompressor().compress(t.encode()),) for t in texts], "packed binary")
    expected = np.bincount((near_dedup.weighted_shingles([t.encode() for t in texts])[1] % np.uint64(near_dedup.SLOTS)).astype(int), minlength=near_dedup.SLOTS)
    assert (near_dedup._shingle_counts(rows.repartition(3)) == expected).all() and expected.sum() > 10_000
    # the rows of a task do not follow its texts
    assert near_dedup._blocks(expected).num_rows <= near_dedup.SLOTS // near_dedup.BLOCK < np.count_nonzero(expected)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_dedup.near_groups(empty).count() == 0 and near_dedup.without_near_copies(empty).count() == 0


def test_parities_rule_out_no_similar_pair():
    """Texts of some words, many of them repeated: the slots that differ are no more than the shingles that do."""
    texts = [prose(70, 120)]
    texts += [changed(texts[0], 700 + i, 1 + i) for i in range(25)] + ["x y " * 40, "x y " * 45, "a", "", prose(71, 3000)]
    weighted = near_dedup.weighted_shingles([t.encode() for t in texts])
    found = near_dedup.parities(*weighted, len(texts))
    own = [shingles(t) for t in texts]
    ruled_out = 0
    for i, a in enumerate(own):
        for j in range(i):
            differ = sum(int(x).bit_count() for x in (found[i] ^ found[j]).view(np.uint64))
            assert differ <= sum(((a - own[j]) + (own[j] - a)).values())
            room = (1 - 0.8) / (1 + 0.8) * (sum(a.values()) + sum(own[j].values()))
            ruled_out += differ > room
    assert ruled_out > 200
