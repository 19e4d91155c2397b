"""Exact dedup (operator 4): live digests in cuckoo filters, one for each range of digests.

The texts stay where they are: a digest, a length and a row number are all that moves. Each task first folds the
rows of a batch that share a digest, so a group of copies sends one row a batch, however large it is; then
each partition of digests runs its rows through a :class:`CuckooIndex`. A miss inserts, a verified hit
updates the entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from keyfold.llm.common import WHITESPACE, first_rows, id_order, row_number, schema_with, stored
from keyfold.llm.cuckoo import CuckooIndex

_ENTRY = "digest binary, copies bigint, n_chars bigint, row bigint"


def digest(text: F.Column) -> F.Column:
    """SHA-256 of a text without its white space, null as empty."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), WHITESPACE, "").cast("binary"), 256)


def digest_rows(docs: DataFrame) -> DataFrame:
    """``row, doc_id, n_chars, text_sha256`` of every document, stored: the one pass over the texts."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        row_number().alias("row"),
        "doc_id",
        F.char_length(text).cast("bigint").alias("n_chars"),
        digest(F.col("text")).alias("text_sha256"),
    )
    return stored(rows, "digests")


def _rank(n_chars: int, doc_id, row: int) -> tuple:
    """Smallest is kept: longest text, then smallest doc_id (null last), then the earliest row."""
    return (-n_chars, doc_id is None, 0 if doc_id is None else doc_id, row)


def live_groups(rows: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """One row per live digest: ``digest, keep_id, keep_row, group_size``.

    ``rows`` as from :func:`digest_rows`; ``deleted`` has a column ``text_sha256`` of digests that leave
    the index once all rows are in.
    """
    entry_schema = schema_with(rows, ["doc_id"], _ENTRY)
    live_schema = schema_with(rows, ["doc_id"], "digest binary, copies bigint, row bigint")

    def columns(batch: pa.RecordBatch) -> Iterator[tuple]:
        return zip(*(batch.column(c).to_pylist() for c in ("digest", "copies", "n_chars", "row", "doc_id")))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[bytes, list] = {}
            for key, copies, n_chars, row, doc_id in columns(batch):
                own = (_rank(n_chars, doc_id, row), copies)
                old = best.get(key)
                best[key] = own if old is None else (min(own[0], old[0]), own[1] + old[1])
            yield as_batch(entry_schema, [(rank, key, copies) for key, (rank, copies) in best.items()])

    def as_batch(schema, entries: list[tuple]) -> pa.RecordBatch:
        values = {
            "doc_id": [None if rank[1] else rank[2] for rank, _, _ in entries],
            "digest": [key for _, key, _ in entries],
            "copies": [copies for _, _, copies in entries],
            "n_chars": [-rank[0] for rank, _, _ in entries],
            "row": [rank[3] for rank, _, _ in entries],
        }
        kinds = to_arrow_schema(schema)
        return pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) for f in kinds], schema=kinds)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live = CuckooIndex()
        for batch in batches:
            for key, copies, n_chars, row, doc_id in columns(batch):
                if copies < 0:
                    live.delete(key)
                    continue
                rank = _rank(n_chars, doc_id, row)
                old = live.get(key)
                live.put(key, (rank, copies) if old is None else (min(rank, old[0]), copies + old[1]))
        entries = [(rank, key, copies) for key, (rank, copies) in live.items()]
        for at in range(0, len(entries), 10_000):
            yield as_batch(live_schema, entries[at : at + 10_000])

    inserts = rows.select(
        "doc_id", F.unhex("text_sha256").alias("digest"), F.lit(1).cast("bigint").alias("copies"), "n_chars", "row"
    ).mapInArrow(fold, entry_schema)
    if deleted is not None:
        gone = deleted.select(
            F.lit(None).cast(rows.schema["doc_id"].dataType).alias("doc_id"),
            F.unhex("text_sha256").alias("digest"),
            F.lit(-1).cast("bigint").alias("copies"),
            F.lit(0).cast("bigint").alias("n_chars"),
            F.lit(0).cast("bigint").alias("row"),
        )
        inserts = inserts.unionByName(gone.dropDuplicates(["digest"]))
    by_digest = inserts.repartition("digest")
    if deleted is not None:
        by_digest = by_digest.sortWithinPartitions(F.col("copies").desc())
    return by_digest.mapInArrow(index, live_schema).select(
        F.lower(F.hex("digest")).alias("digest"),
        F.col("doc_id").alias("keep_id"),
        F.col("row").alias("keep_row"),
        F.col("copies").alias("group_size"),
    )


def exact_groups(docs: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """One row per document, those of equal texts grouped.

    Texts are equal when identical without white space; null counts as empty, and empty texts are equal. Of
    equal texts the longest as written stays, then the smallest ``doc_id`` (null last), then, of rows repeated
    as a whole, the first read. ``doc_id`` may be null or repeated; other columns are ignored; an empty table
    gives no rows. Digests in ``deleted`` leave the index, and their documents come out without a group.
    """
    rows = digest_rows(docs)
    groups = live_groups(rows, deleted)
    return rows.join(groups, rows["text_sha256"] == groups["digest"], "left").select(
        "row",
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, all columns as they are; the texts are shuffled once."""
    keepers = live_groups(digest_rows(docs)).select(id_order(F.col("keep_id")).alias("id"), "digest")
    return first_rows(docs, {"id": id_order(F.col("doc_id")), "digest": digest(F.col("text"))}, keepers)
