"""Keyed state: keep-last and field-level upsert (M1-M4).

Every result is a maximum over a unique order key, so merging does not depend on batch boundaries
and replaying messages changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.functions import entry_text, is_null, json_token, render_object, text_of

# Message time first: broker-assigned times increase within a partition, and they stay comparable
# when an id moves to another partition. With producer clocks that run backwards, use
# ``LOG_ORDER``, which is right as long as an id never changes its partition.
TIME_ORDER = ("ts", "part", "pos")
LOG_ORDER = ("pos", "part", "ts")


def order_key(order: tuple[str, ...] = TIME_ORDER) -> Column:
    return F.struct(*order)


def keep_last(docs: DataFrame, order: tuple[str, ...] = TIME_ORDER, key: str = "id") -> DataFrame:
    """The newest whole message per key (M1); fields of earlier messages are lost.

    A maximum, not a sorted group: each map task sends one row per key, however hot the key is.
    """
    payload = F.struct(*[c for c in docs.columns if c != key])
    newest = docs.groupBy(key).agg(F.max_by(payload, order_key(order)).alias("_m"))
    return newest.select(key, "_m.*")


def drop_null_fields(docs: DataFrame) -> DataFrame:
    return docs.withColumn("fields", F.map_filter("fields", lambda _, v: ~is_null(v)))


def field_names(fields: Column) -> Column:
    return F.array_sort(F.map_keys(fields))


def latest_per_shape(docs: DataFrame, shape: Column, order: tuple[str, ...] = TIME_ORDER) -> DataFrame:
    """Keeps the newest message per id and shape, where messages of a shape write the same fields.

    Such a message replaces every field of an earlier one, so the earlier one cannot matter. Busy
    ids shrink to a few rows before their fields are exploded.
    """
    message = F.struct("fields", *TIME_ORDER)
    newest = docs.groupBy("id", shape.alias("_shape")).agg(F.max_by(message, order_key(order)).alias("_m"))
    return newest.select("id", "_m.*")


def field_merge(
    docs: DataFrame,
    null_policy: str = "overwrite",
    order: tuple[str, ...] = TIME_ORDER,
    collapse_shapes: bool = True,
) -> DataFrame:
    """Upsert (M2) of top-level fields: one row per ``id`` and ``field`` with the newest ``val``.

    ``null_policy="overwrite"``: an explicit JSON null replaces the stored value, as for raw text
    messages. ``"ignore"``: nulls never reach the store, as for serialized objects.
    """
    if null_policy not in ("overwrite", "ignore"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    docs = docs.select("id", "fields", *TIME_ORDER)
    if null_policy == "ignore":
        docs = drop_null_fields(docs)
    if collapse_shapes:
        docs = latest_per_shape(docs, field_names(F.col("fields")), order)
    exploded = docs.select("id", *TIME_ORDER, F.explode("fields").alias("field", "val"))
    entry = F.struct("val", *TIME_ORDER)
    merged = exploded.groupBy("id", "field").agg(F.max_by(entry, order_key(order)).alias("_m"))
    return merged.select("id", "field", "_m.*")


def field_text(merged: DataFrame) -> DataFrame:
    """``id, field, val`` with the value as text and JSON null as null."""
    return merged.select("id", "field", entry_text(F.col("val")).alias("val"))


def merged_documents(merged: DataFrame) -> DataFrame:
    """One row per document: ``id`` and its JSON text, keys sorted."""
    tokens = merged.select("id", F.struct("field", json_token(F.col("val")).alias("token")).alias("_e"))
    # after the merge a group is one document, one entry per field
    grouped = tokens.groupBy("id").agg(F.collect_list("_e").alias("_entries"))
    return grouped.select("id", render_object(F.col("_entries"), "field", "token").alias("source"))


def wide_state(
    docs: DataFrame,
    names: list[str],
    null_policy: str = "overwrite",
    order: tuple[str, ...] = TIME_ORDER,
) -> DataFrame:
    """M2 for fields known beforehand: one row per id, one text column per name.

    Each column is its own maximum over the messages that carry the field, so nothing is exploded
    and a message is shuffled as one row at most.
    """
    fields = F.col("fields")

    def newest(name: str) -> Column:
        text = text_of(fields, name)
        carried = text.isNotNull() if null_policy == "ignore" else F.map_contains_key(fields, name)
        return F.max_by(text, F.when(carried, order_key(order))).alias(name)

    return docs.groupBy("id").agg(*[newest(name) for name in names])


def newest_columns(
    rows: DataFrame, key: str, keep_nulls: list[str], skip_nulls: list[str], order: tuple[str, ...] = TIME_ORDER
) -> DataFrame:
    """M2 over typed columns: per key the newest value of each column; nulls in ``skip_nulls``
    columns count as absent."""
    return rows.groupBy(key).agg(
        *[F.max_by(name, order_key(order)).alias(name) for name in keep_nulls],
        *[F.max_by(name, F.when(F.col(name).isNotNull(), order_key(order))).alias(name) for name in skip_nulls],
    )
