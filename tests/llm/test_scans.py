from __future__ import annotations

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyfold.llm import fingerprints, licenses, quality, token_counts
from keyfold.llm.common import documents
from keyfold.llm.tokens import vocabulary_path, word_tokenizer
from tests.llm.tables import SCHEMA, counted, messy, messy_rows, prose, shingles, split
from tests.llm.test_tokens_packing import whole_ids

SMALL = "/root/testdata/sf0.01"


def plain_licenses(text: str | None) -> tuple:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    starts, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES:
        wanted = phrase.split()
        for i in range(len(words) - len(wanted) + 1):
            if words[i : i + len(wanted)] == wanted:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def plain_labels(text: str | None, index: licenses.RareWordIndex, known: list) -> tuple[str, float]:
    """Labels and score by holding every template against every place of a text, with its weights."""
    own = licenses.words((text or "").encode())
    scores = {}
    for template in known:
        for start in range(-len(template.words), len(own)):
            if template.base:
                if start >= 0 and own[start : start + len(template.words)] == template.words:
                    scores[template.label] = 1.0
                continue
            near = [
                any(0 <= start + i + d < len(own) and own[start + i + d] == w for d in range(-licenses.DRIFT, licenses.DRIFT + 1))
                for i, w in enumerate(template.words)
            ]
            share = sum(x for x, there in zip(template.weights, near) if there) / sum(template.weights)
            region = own[max(0, start - licenses.DRIFT) : max(0, start) + len(template.words) + licenses.DRIFT]
            stands = all(any(region[i : i + len(p)] == p for i in range(len(region))) for p in template.phrases)
            if share >= licenses.MIN_COVERAGE and stands:
                scores[template.label] = max(scores.get(template.label, 0.0), min(1.0, share))
    return ",".join(sorted(scores)), max(scores.values(), default=0.0)


def notices() -> list[str]:
    """Templates as they are, with words put in, left out and replaced, the rarest of them too, inside other text."""
    out = []
    for number, (_, text, keys) in enumerate(licenses.TEMPLATES):
        rng = random.Random(number)
        own = text.split()
        key = " ".join(keys)
        out += [text, text.upper(), f"{prose(number, 12)} {text} {prose(number + 50, 9)}", f"{text} {text}"]
        for _ in range(4):
            changed_ = list(own)
            for _ in range(1 + len(own) // 12):
                at = rng.randrange(len(changed_))
                if changed_[at].strip(".,").lower() not in key.lower():
                    changed_[at : at + 1] = rng.choice(([], ["other"], [changed_[at], "more"]))
            out.append(" ".join([prose(number, 3), *changed_]))
    return out


def test_labels_and_scores_of_licenses(spark):
    """The index finds what holding every template against every place finds, wherever a key phrase is left."""
    rows = [(i, t, None, None, None) for i, t in enumerate(notices())] + messy_rows()
    docs = messy(spark, rows=rows)
    known = licenses.templates()
    index = licenses.RareWordIndex(known, *licenses.document_frequencies(docs, licenses.vocabulary(known)))
    found = licenses.license_scan(docs).collect()
    want = counted((d, a, round(b, 9)) for d, (a, b) in ((r[0], plain_labels(r[1], index, known)) for r in rows))
    got = counted((r.doc_id, r.labels, round(r.score, 9)) for r in found)
    missed = want - got
    # a place that no anchor is in line with may score a little higher than those that are; the label is the same
    assert {(d, a) for d, a, _ in missed} == {(d, a) for d, a, _ in got - want}
    assert sum(missed.values()) <= len(rows) // 10
    assert sum(1 for r in found if r.labels) > 100


def test_licenses(spark):
    found = licenses.license_scan(messy(spark)).collect()
    assert counted(tuple(r)[:6] for r in found) == counted((d, *plain_licenses(t)) for d, t, *_ in messy_rows())
    for r in found:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)


def test_templates_are_found_with_small_changes(spark):
    label, text, _ = licenses.TEMPLATES[8]
    words = text.split()
    near = " ".join([*words[:18], "changed", *words[19:]])
    far = " ".join(words[:12])
    rows = [(i, t, None, None, None) for i, t in enumerate([f"x y {text.upper()} z", near, far, prose(1, 200)])]
    found = {r.doc_id: r for r in licenses.license_scan(messy(spark, rows=rows)).collect()}
    assert [label in found[i].labels.split(",") for i in range(4)] == [True, True, False, False]
    assert found[0].score == 1.0 > found[1].score >= licenses.MIN_COVERAGE


def edited_rows(rows):
    """The rows in order with the next text."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, (rows[i][1] or "").encode()))
    texts = [rows[i][1] or "" for i in order]
    out = []
    for k, i in enumerate(order):
        half, following = len(texts[k]) // 2, texts[(k + 1) % len(texts)]
        out.append((rows[i][0], texts[k], texts[k][: len(texts[k]) - half] + following[:half], following))
    return out


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_neighbours(spark, parts):
    found = fingerprints.neighbour_likeness(messy(spark), parts).collect()
    expected = edited_rows(messy_rows())
    assert counted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == counted(
        (d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in expected
    )
    by_text = {}
    for r in found:
        near = {(d, hashlib.sha256(e.encode()).hexdigest()): (t, e, n) for d, t, e, n in expected}
        text, edited, following = near[r.doc_id, r.edited_sha256]
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        for other, likeness in ((edited, r.near_edited), (following, r.near_next)):
            a, b = set(exact(text)), set(exact(other))
            truth = len(a & b) / len(a | b) if a | b else 1.0
            exactly = len(a | b) < fingerprints.SKETCH_SIZE
            assert likeness == pytest.approx(truth, abs=1e-9 if exactly else 0.15)


def exact(text: str):
    words = split(text)
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def test_a_few_rows(spark):
    for n in (0, 1, 2):
        rows = [(i, prose(i, 30), None, None, None) for i in range(n)]
        found = fingerprints.neighbour_likeness(spark.createDataFrame(rows, SCHEMA), 4).collect()
        assert counted((r.doc_id, r.edited_sha256) for r in found) == counted(
            (d, hashlib.sha256(e.encode()).hexdigest()) for d, _, e, _ in edited_rows(rows)
        )
    nameless = [(None, prose(i, 30), None, None, None) for i in range(5)]
    assert fingerprints.neighbour_likeness(spark.createDataFrame(nameless, SCHEMA), 4).count() == 5


def test_sketches_merge_and_estimate(spark):
    parts = [prose(i, 900) for i in range(4)]
    hashes = [fingerprints.shingle_hashes([t.encode()])[0] for t in parts]
    whole = fingerprints.sketch(np.concatenate(hashes))
    rows = fingerprints.fingerprints(messy(spark, rows=[(i, t, None, None, None) for i, t in enumerate(parts)]))
    merged = fingerprints.merged_fingerprints(rows.withColumn("g", F.lit("all")), "g").collect()
    assert [fingerprints.to_text(whole)] == [r.fingerprint for r in merged]
    assert fingerprints.distinct_count(whole) == pytest.approx(len(set(np.concatenate(hashes).tolist())), rel=0.3)
    one = fingerprints.sketch(hashes[0])
    assert fingerprints.containment(one, whole) == pytest.approx(1.0, abs=0.3)
    assert fingerprints.containment(whole, one) == pytest.approx(0.25, abs=0.15)
    assert (fingerprints.from_text(fingerprints.to_text(one)) == one).all()
    none = one[:0]
    assert (fingerprints.resemblance(none, none), fingerprints.resemblance(one, none)) == (1.0, 0.0)
    assert fingerprints.distinct_count(none) == 0 and len(shingles("a")) == 1


text_bytes = st.text(alphabet="aAb'1. ,\n\té漢", max_size=700).map(str.encode)


@settings(max_examples=150, deadline=None)
@given(st.data(), text_bytes)
def test_token_tree(data, text):
    tree = token_counts.TokenTree(text, word_tokenizer(vocabulary_path()))
    for _ in range(4):
        chars = text.decode()
        start, end = sorted(data.draw(st.tuples(*[st.integers(0, len(chars))] * 2)))
        insert = data.draw(st.text(alphabet="aB' .\n", max_size=400))
        at = len(chars[:start].encode())
        tree.apply(token_counts.Edit(at, len(chars[start:end].encode()), insert.encode()))
        text = (chars[:start] + insert + chars[end:]).encode()
        assert tree.text() == text and tree.size == len(text) and tree.tokens == len(whole_ids(text.decode()))


def test_edits_leave_most_of_a_long_text_alone():
    text = prose(1, 9000).encode()
    tree = token_counts.TokenTree(text, word_tokenizer(vocabulary_path()))
    tree.apply(token_counts.Edit(20_000, 5, b"x y"))
    assert tree.encoded_bytes < 4 * token_counts.PIECE_BYTES
    with pytest.raises(ValueError):
        tree.apply(token_counts.Edit(len(text), 9, b""))


def test_edited_counts(spark):
    found = token_counts.edited_counts(messy(spark)).drop("encoded_bytes").collect()
    expected = []
    for doc_id, text, *_ in messy_rows():
        old = new = (text or "").encode()
        edits = token_counts.sample_edits(old)
        for e in edits:
            new = new[: e.at] + e.inserted + new[e.at + e.deleted :]
        counts = len(old), len(whole_ids(old.decode())), len(edits), len(new), len(whole_ids(new.decode()))
        expected.append((doc_id, *counts, hashlib.sha256(new).hexdigest()))
    assert counted(found) == counted(expected)


def test_quality_on_held_out_labels(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("no given tables")
    docs, labels = documents(spark, SMALL), spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.fit(*quality.labelled_sample(docs, labels))
    found = quality.scored(docs, model).drop("kept").toPandas()
    assert (found.held_out == found.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    assert found.score.between(0, 1).all() and ((found.score >= 0.3) == (found.predicted == 1)).all()
    judged = found.merge(labels.toPandas(), on="doc_id")
    judged = judged[judged.held_out]
    assert (judged.predicted == judged.quality).mean() > 0.95
    assert len(model.rules) < 200


def test_quality_of_awkward_rows(spark):
    docs = messy(spark)
    labels = spark.createDataFrame(
        [(0, 1, 0), (21, 0, 0), (60, 1, 1), (3, None, 0), (None, 1, 0), (999, 0, 0), (0, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    model = quality.fit(*quality.labelled_sample(docs, labels))
    found = quality.scored(docs, model)
    assert counted(found.select("doc_id").collect()) == counted(r[:1] for r in messy_rows())
    assert all(0 <= r.score <= 1 for r in found.collect())
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == found.filter("predicted = 1").count()
    for some in (labels.limit(0), labels.filter("quality = 1")):
        constant = quality.fit(*quality.labelled_sample(docs, some))
        assert {r.predicted for r in quality.scored(docs, constant).collect()} == {1}


def test_rules_as_columns_are_the_model(spark):
    rng = np.random.default_rng(4)
    x = rng.random((3000, len(quality.STATISTICS)))
    y = ((x[:, 2] > 0.3) & (x[:, 5] <= 0.7) | (x[:, 0] > 0.9)).astype(int)
    model = quality.fit(x, y)
    again = quality.fit(x[::-1], y[::-1])
    assert model == again
    assert ((model.predict(x) > 0.5) == y).mean() > 0.95
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x[:200]], quality.STATISTICS)
    scores = [r[0] for r in rows.select(model.column()).collect()]
    assert np.allclose(scores, model.predict(x[:200]))
    assert 0 < len(model.rules) < 150


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = quality.fit(*quality.labelled_sample(empty, labels))
    for frame in (
        licenses.license_scan(empty),
        quality.scored(empty, model),
        fingerprints.fingerprints(empty),
        token_counts.edited_counts(empty),
    ):
        assert frame.count() == 0
