"""Token counts under edits (operator 10).

A document is kept as a row of short pieces that end behind white space, with a segment tree over their
numbers of bytes and tokens. White space separates the vocabulary's pre-tokens, so a piece's count does not
depend on its neighbours. An edit finds its pieces by descending the tree, joins a following piece while
the last one no longer ends behind white space, encodes that region again and sums up the paths above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keyfold.llm.common import WHITESPACE, encoded_slices, schema_with
from keyfold.llm.tokens import WordTokenizer, vocabulary_path, word_tokenizer

PIECE_BYTES = 256
_ENDS = frozenset(WHITESPACE.encode())


@dataclass(frozen=True)
class Edit:
    """``deleted`` bytes from ``at`` on give way to ``inserted``; whole characters in UTF-8."""

    at: int
    deleted: int
    inserted: bytes


class TokenTree:
    """Bytes and tokens of a document's pieces, summed up a binary tree."""

    def __init__(self, text: bytes, tokenizer: WordTokenizer):
        self.tokenizer = tokenizer
        self.pieces = _cut(text)
        self.base = 1 << max(0, (len(self.pieces) - 1).bit_length())
        self.sums = np.zeros((2 * self.base, 2), dtype=np.int64)
        leaves = self.sums[self.base : self.base + len(self.pieces)]
        leaves[:, 0] = [len(p) for p in self.pieces]
        leaves[:, 1] = tokenizer.counts(self.pieces)
        level = self.base
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level : 2 * level].reshape(half, 2, 2).sum(axis=1)
            level = half
        self.encoded_bytes = 0

    @property
    def size(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def text(self) -> bytes:
        return b"".join(self.pieces)

    def _find(self, offset: int) -> tuple[int, int]:
        """The piece that holds a byte, and the byte's place in it; behind the end, the last piece."""
        node = 1
        while node < self.base:
            node *= 2
            left = int(self.sums[node, 0])
            if offset >= left and int(self.sums[node + 1, 0]):
                offset -= left
                node += 1
        return node - self.base, offset

    def apply(self, edit: Edit) -> None:
        if not 0 <= edit.at <= edit.at + edit.deleted <= self.size:
            raise ValueError("the edit lies outside the text")
        first, place = self._find(edit.at)
        last, end = self._find(edit.at + edit.deleted)
        changed = self.pieces[first][:place] + edit.inserted + self.pieces[last][end:]
        # boundary context: what follows belongs to the region until white space separates it; every
        # piece before ends behind white space already
        while last + 1 < len(self.pieces) and (not changed or changed[-1] not in _ENDS):
            last += 1
            changed += self.pieces[last]
        self.pieces[first] = changed
        self._set(first, len(changed), int(self.tokenizer.counts([changed])[0]))
        self.encoded_bytes += len(changed)
        for emptied in range(first + 1, last + 1):
            self.pieces[emptied] = b""
            self._set(emptied, 0, 0)

    def _set(self, leaf: int, size: int, tokens: int) -> None:
        node = leaf + self.base
        change = np.array([size, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2


def _cut(text: bytes, size: int = PIECE_BYTES) -> list[bytes]:
    """Pieces of at least ``size`` bytes, each but the last ending behind white space."""
    pieces, start = [], 0
    while start < len(text):
        end = start + size
        while end < len(text) and text[end - 1] not in _ENDS:
            end += 1
        pieces.append(text[start:end])
        start = end
    return pieces or [b""]


def sample_edits(text: bytes) -> list[Edit]:
    """Three edits as a revision makes them: the second quarter's first 40 characters go, ten in the
    middle are replaced by the text's first twelve, and its first line is put at the end again."""
    chars = text.decode()

    def place(n: int) -> int:
        return len(chars[:n].encode())

    half, quarter = place(len(chars) // 2), place(len(chars) // 4)
    replaced = place(len(chars) // 2 + 10) - half
    gone = min(place(len(chars) // 4 + 40), half) - quarter
    # from the back, so that no edit moves the place of another
    return [
        Edit(len(text), 0, b" " + text.split(b"\n", 1)[0]),
        Edit(half, replaced, chars[:12].encode()),
        Edit(quarter, gone, b""),
    ]


def edited_counts(docs: DataFrame, edits=sample_edits, vocabulary: str | None = None) -> DataFrame:
    """Token counts of every row of ``docs`` before and after the edits that ``edits`` makes of its text.

    ``encoded_bytes`` is what the edits made be encoded again. A null text counts as empty; a null ``doc_id`` stays
    null; a repeated row is counted again; other columns are ignored; an empty table gives no rows. One pass,
    nothing shuffled.
    """
    path = vocabulary or vocabulary_path()
    schema = schema_with(
        docs,
        ["doc_id"],
        "n_bytes bigint, n_tokens bigint, n_edits bigint, edited_bytes bigint, edited_tokens bigint, encoded_bytes bigint, edited_sha256 string",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            rows = []
            for text in (t for _, some in encoded_slices(batch.column("text")) for t in some):
                tree = TokenTree(text, tokenizer)
                before = tree.size, tree.tokens
                made = edits(text)
                for edit in made:
                    tree.apply(edit)
                sha = hashlib.sha256(tree.text()).hexdigest()
                rows.append((*before, len(made), tree.size, tree.tokens, tree.encoded_bytes, sha))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in columns[:6]),
                    pa.array(columns[6], pa.string()),
                ],
                names=schema.names,
            )
        tokenizer.rest()

    return docs.select("doc_id", "text").mapInArrow(run, schema)
