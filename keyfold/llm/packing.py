"""Packing (operator 3): power-of-two decomposition.

Each document's ids are cut into pieces whose lengths are the binary digits of their number, whole pieces of
the longest length first, and every piece is a sequence of its own. No sequence crosses documents, none
is padded, and equal lengths share a bucket, from which batches of one length are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import encoded_slices, schema_with
from keyfold.llm.tokens import vocabulary_path, word_tokenizer

MAX_TOKENS = 2048
END_ID = 1
BATCH_TOKENS = 1 << 16


def piece_lengths(tokens: int, longest: int = MAX_TOKENS) -> list[int]:
    """Lengths of a document's pieces in text order: whole ones, then the binary digits of the rest."""
    rest = tokens % longest
    digits = [1 << bit for bit in range(longest.bit_length() - 2, -1, -1) if rest >> bit & 1]
    return [longest] * (tokens // longest) + digits


def packed(
    docs: DataFrame,
    vocabulary: str | None = None,
    longest: int = MAX_TOKENS,
    end_id: int = END_ID,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """One row per piece of the column ``text``, under the document's ``doc_id`` as it is.

    ``longest`` is a power of two. A null or empty text is the single id ``end_id``; a repeated row is packed
    again; a null ``doc_id`` stays null; an empty table gives no rows; other columns are ignored.
    ``bucket`` is the binary logarithm of the length, ``batch`` joins sequences of one bucket up to
    ``batch_tokens`` ids. One pass over the text without a shuffle, so no document or source is hot.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest sequence must be a power of two")
    path = vocabulary or vocabulary_path()
    schema = schema_with(
        docs, ["doc_id"], "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, bucket int, batch bigint"
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            rows, values = [], []
            texts = (t for _, some in encoded_slices(batch.column("text")) for t in tokenizer.encode(some))
            for row, found in enumerate(texts):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                start = 0
                for length in piece_lengths(len(ids), longest):
                    bucket = length.bit_length() - 1
                    number = seen[bucket] // max(1, batch_tokens // length)
                    seen[bucket] += 1
                    rows.append(row)
                    crc = zlib.crc32(ids[start : start + length])
                    values.append((start, length, crc, len(ids), bucket, task << 38 | bucket << 32 | number))
                    start += length
            columns = np.array(values, dtype=np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    *(pa.array(columns[:, k]) for k in range(4)),
                    pa.array(columns[:, 4].astype(np.int32)),
                    pa.array(columns[:, 5]),
                ],
                names=schema.names,
            )
        tokenizer.rest()

    pieced = docs.select("doc_id", "text").mapInArrow(pieces, schema)
    return pieced.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        "bucket",
        "batch",
    )
