"""License scans (operator 2): a positional index over the rare words of license templates.

Of each template the index keeps its words with the highest inverse document frequency over the whole
corpus. A text is looked up by those words alone; a hit says where the template would begin, the other words'
positions in the text are intersected with the template's from there, and the template's key phrases must
stand word for word.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import encoded_slices, schema_with

# The base phrases and their labels.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Public license notices: label, words of the notice, phrases of it that have to stand.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("general public license",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("released into the public domain",)),
    ("cc", "licensed under cc by", ("under cc by",)),
    ("cc", "licensed under a creative commons attribution license", ("creative commons",)),
    ("reserved", "all rights reserved", ("all rights reserved",)),
)

ANCHORS = 3  # rare words of a template by which it is looked up, besides one of each key phrase
MIN_COVERAGE = 0.8
DRIFT = 2  # places by which words of a template may have moved, as where some were put in or left out

# Every byte as it counts in a word: A-Z lower-cased, other ASCII signs as blanks, the rest as it is.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8: runs of ASCII letters and digits and of characters beyond ASCII."""
    return text.translate(_FOLD).split()


@dataclass
class Template:
    label: str
    words: list[bytes]
    phrases: list[list[bytes]]
    base: bool = False
    anchors: list[int] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)


_DRIFTS = sorted(range(-DRIFT, DRIFT + 1), key=abs)


def _find(text: list[bytes], phrase: list[bytes]) -> int:
    """Where a phrase stands first among some words, or -1."""
    return next((i for i in range(len(text) - len(phrase) + 1) if text[i : i + len(phrase)] == phrase), -1)


def templates(more: tuple = TEMPLATES) -> list[Template]:
    base = [Template(label, words(p.encode()), [words(p.encode())], True) for p, label in BASE_PHRASES]
    return base + [Template(a, words(t.encode()), [words(p.encode()) for p in keys]) for a, t, keys in more]


def vocabulary(known: list[Template]) -> list[bytes]:
    return sorted({w for t in known for w in t.words})


def document_frequencies(docs: DataFrame, known: list[bytes]) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of those with each word of the templates: as many counts as templates
    have words, whatever the size of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary_ = frozenset(known)
        for batch in batches:
            found: Counter[bytes] = Counter()
            for _, texts in encoded_slices(batch.column("text")):
                for text in texts:
                    found.update(vocabulary_.intersection(words(text)))
            found[b""] = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["word", "n"],
            )

    counted = docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n"))
    numbers = {word.encode(): n for word, n in counted.collect()}
    return numbers.pop(b"", 0), numbers


class RareWordIndex:
    """Templates by their rarest words, and the position of every word in them."""

    def __init__(self, known: list[Template], total: int, frequencies: dict[bytes, int]):
        idf = {w: math.log((total + 1) / (frequencies.get(w, 0) + 1)) + 1e-3 for w in vocabulary(known)}
        self.rare: dict[bytes, list[tuple[Template, int]]] = defaultdict(list)
        for template in known:
            template.weights = [idf[w] for w in template.words]
            order = sorted(range(len(template.words)), key=lambda i: (-idf[template.words[i]], i))
            # a key phrase stands as a whole, so the rarest of its words finds every template that can be verified
            template.anchors = order[: 0 if template.base else ANCHORS]
            for phrase in template.phrases:
                begin = _find(template.words, phrase)
                inside = [i for i in order if begin <= i < begin + len(phrase)]
                template.anchors += [i for i in inside[:1] if i not in template.anchors]
            for at in template.anchors:
                self.rare[template.words[at]].append((template, at))
        self.known = frozenset(w for t in known for w in t.words)
        self.anchors = frozenset(self.rare)

    def scan(self, text: list[bytes]) -> tuple[dict[str, list[int]], dict[str, float]]:
        """Starts of the base phrases, and by label the best share of a verified template's weight."""
        base: dict[str, list[int]] = defaultdict(list)
        scores: dict[str, float] = {}
        hits = self.anchors.intersection(text)
        if not hits:
            return base, scores
        postings: dict[bytes, list[int]] = defaultdict(list)
        for at, word in enumerate(text):
            if word in self.known:
                postings[word].append(at)
        places = {word: frozenset(found) for word, found in postings.items()}
        tried: dict[int, set[int]] = defaultdict(set)
        for word in hits:
            for template, at in self.rare[word]:
                for position in postings[word]:
                    start = position - at
                    if start in tried[id(template)]:
                        continue
                    tried[id(template)].add(start)
                    drift = (0,) if template.base else _DRIFTS
                    present = [any(start + i + d in places.get(w, ()) for d in drift) for i, w in enumerate(template.words)]
                    share = sum(x for x, there in zip(template.weights, present) if there) / sum(template.weights)
                    if template.base:
                        if all(present):
                            base[template.label].append(start)
                            scores[template.label] = 1.0
                    elif share >= MIN_COVERAGE and self._phrases_stand(template, text, max(0, start)):
                        scores[template.label] = max(scores.get(template.label, 0.0), min(1.0, share))
        return base, scores

    @staticmethod
    def _phrases_stand(template: Template, text: list[bytes], start: int) -> bool:
        region = text[max(0, start - DRIFT) : start + len(template.words) + DRIFT]
        return all(_find(region, p) >= 0 for p in template.phrases)


def license_scan(docs: DataFrame, more: tuple = TEMPLATES) -> DataFrame:
    """Licenses in every row of ``docs``; two passes over the texts, nothing of them shuffled.

    ``n_base``, ``first_word`` and ``last_word`` are the places of the base phrases; ``labels`` adds those of
    the templates, ``score`` is the best coverage. A null or empty text has no words, no places and score
    0; a null ``doc_id`` stays null; a repeated row is scanned again; other columns are ignored; an empty table gives no
    rows.
    """
    known = templates(more)
    total, frequencies = document_frequencies(docs, vocabulary(known))
    schema = schema_with(
        docs,
        ["doc_id"],
        "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RareWordIndex(templates(more), total, frequencies)
        for batch in batches:
            found = [[] for _ in range(7)]
            for text in (t for _, some in encoded_slices(batch.column("text")) for t in some):
                own = words(text)
                base, scores = index.scan(own)
                starts = [s for places in base.values() for s in places]
                row = (
                    len(own),
                    len(starts),
                    min(starts, default=None),
                    max(starts, default=None),
                    ",".join(sorted(base)),
                    ",".join(sorted(scores)),
                    max(scores.values(), default=0.0),
                )
                for column, value in zip(found, row):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(found, kinds))], names=schema.names
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
