"""Upsert with recursive merge of nested objects (M2).

Documents are flattened to one state row per id and path. A row says when a *leaf* (scalar, null,
array) was last written at that path and what it was, and when an *object* was last seen there.
Both are plain maxima, so a busy id never gathers in one task. What the state means:

* at a path, the newer of leaf and object counts;
* neither counts if a newer leaf stands at a path above it.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.functions import is_object, joined_object, json_token, let, quoted, render_object
from keyfold.operators.merge import TIME_ORDER, drop_null_fields, field_names, latest_per_shape, order_key

# Null ``token`` or ``object_pos``: no leaf or no object was ever written at the path.
# `merge_rows` of any union of state rows is the state of all their messages.
STATE_SCHEMA = (
    "id string, path array<string>, token string, ts timestamp, part int, pos bigint, "
    "object_ts timestamp, object_part int, object_pos bigint"
)
STATE_SCHEMA_NAMES = [column.split(" ")[0] for column in STATE_SCHEMA.split(", ")]
STATE_KEY = ["id", "path"]
OBJECT_ORDER = [f"object_{name}" for name in TIME_ORDER]

_NODE = (
    T.StructType()
    .add("path", T.ArrayType(T.StringType()))
    .add("is_object", T.BooleanType())
    .add("token", T.StringType())
)
_NODES = T.ArrayType(_NODE)

# Executors need not have this package installed to run its Python functions.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Number(float):
    """A JSON number that is written back with the digits it was read with."""

    def __new__(cls, digits: str):
        number = super().__new__(cls, digits)
        number.digits = digits
        return number

    def __repr__(self) -> str:
        return self.digits


def _dump(value) -> str:
    if isinstance(value, _Number):
        return value.digits
    if isinstance(value, list):
        return "[" + ",".join(map(_dump, value)) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_dump(v)}" for k, v in value.items()) + "}"
    return json.dumps(value, ensure_ascii=False)


def _walk(value, path: list[str]) -> Iterator[dict]:
    pending = [(value, path)]
    while pending:
        value, path = pending.pop()
        nested = isinstance(value, dict)
        yield {"path": path, "is_object": nested, "token": None if nested else _dump(value)}
        if nested:
            pending.extend((child, [*path, name]) for name, child in value.items())


@F.pandas_udf(_NODES)
def _flatten_objects(texts: pd.Series) -> pd.Series:
    """All paths below the object-valued fields of one message."""

    def nodes(text):
        if text is None:
            return None
        fields = json.loads(text, parse_float=_Number, parse_int=_Number)
        return [node for name, value in fields.items() for node in _walk(value, [name])]

    return texts.map(nodes, na_action="ignore")


def state_rows(
    docs: DataFrame,
    null_policy: str = "overwrite",
    order: tuple[str, ...] = TIME_ORDER,
    nested: bool = True,
) -> DataFrame:
    """Documents as merged state rows (:data:`STATE_SCHEMA`).

    Only the object-valued fields of a message go through Python, and only with ``nested``;
    otherwise an object is a leaf and replaces the stored one as a whole.
    """
    docs = docs.select("id", "fields", *TIME_ORDER)
    if null_policy == "ignore":
        docs = drop_null_fields(docs)
    # messages of one shape write the same paths, so the newest of them is enough
    shape = _path_shape if nested else field_names
    docs = latest_per_shape(docs, shape(F.col("fields")), order)

    leaves = F.map_filter("fields", lambda _, v: ~is_object(v)) if nested else F.col("fields")
    nodes = F.transform(
        F.map_entries(leaves),
        lambda e: F.struct(
            F.array(e["key"]).alias("path"), F.lit(False).alias("is_object"), json_token(e["value"]).alias("token")
        ),
    )
    if nested:
        objects = F.map_entries(F.map_filter("fields", lambda _, v: is_object(v)))
        pairs = F.transform(objects, lambda e: F.struct(e["key"].alias("k"), json_token(e["value"]).alias("v")))
        text = F.when(F.size(objects) > 0, joined_object(pairs))
        nodes = F.concat(nodes, F.coalesce(_flatten_objects(text), F.array().cast(_NODES)))
    # the outer form, since Catalyst would add a filter that runs the Python function once more
    rows = docs.select("id", *TIME_ORDER, F.inline_outer(nodes)).filter(F.col("path").isNotNull())
    if nested and null_policy == "ignore":
        rows = rows.filter(F.col("is_object") | (F.col("token") != "null"))
    leaf_at = [F.when(~F.col("is_object"), F.col(name)).alias(name) for name in TIME_ORDER]
    object_at = [F.when(F.col("is_object"), F.col(name)).alias(f"object_{name}") for name in TIME_ORDER]
    return merge_rows(rows.select(*STATE_KEY, "token", *leaf_at, *object_at), order)


def leaf_rows(rows: DataFrame) -> DataFrame:
    """State rows from leaves that need no parsing: ``id, path, token, ts, part, pos``."""
    never = {"object_ts": "timestamp", "object_part": "int", "object_pos": "bigint"}
    return rows.select(
        *STATE_KEY, "token", *TIME_ORDER, *[F.lit(None).cast(kind).alias(name) for name, kind in never.items()]
    )


def _path_shape(fields: Column) -> Column:
    """The field names of a message, and for nested objects the names and types below them."""
    entries = F.map_entries(fields)
    return F.array_sort(
        F.transform(
            entries,
            lambda e: F.struct(
                e["key"].alias("name"),
                F.when(is_object(e["value"]), F.schema_of_variant(e["value"]["value"])).alias("below"),
            ),
        )
    )


def _leaf_at(order: tuple[str, ...]) -> Column:
    return F.when(F.col("token").isNotNull(), order_key(order))


def _object_at(order: tuple[str, ...]) -> Column:
    return F.when(F.col("object_pos").isNotNull(), F.struct(*[F.col(f"object_{n}").alias(n) for n in order]))


def merge_rows(rows: DataFrame, order: tuple[str, ...] = TIME_ORDER) -> DataFrame:
    """One row per id and path. Feed it any union of state rows, in any order."""
    merged = rows.groupBy(*STATE_KEY).agg(
        F.max_by(F.struct("token", *TIME_ORDER), _leaf_at(order)).alias("_leaf"),
        F.max_by(F.struct(*OBJECT_ORDER), _object_at(order)).alias("_object"),
    )
    return merged.select(*STATE_KEY, "_leaf.*", "_object.*")


def _written(node: Column) -> Column:
    return F.greatest(node["_leaf"], node["_object"])


def _live(nodes: Column) -> Column:
    """The nodes of one field without those that a newer leaf above them has replaced.

    Only a path that held both a leaf and an object can replace anything; there are few of them, and every
    node is held against those alone.
    """

    def without_replaced(resets: Column) -> Column:
        def replaced(node: Column) -> Column:
            def above(reset: Column) -> Column:
                return (
                    (F.size(reset["path"]) < F.size(node["path"]))
                    & (F.slice(node["path"], F.lit(1), F.size(reset["path"])) == reset["path"])
                    & (_written(node) < reset["_leaf"])
                )

            return F.exists(resets, above)

        return F.filter(nodes, lambda node: ~replaced(node))

    resets = F.filter(nodes, lambda n: n["_leaf"].isNotNull() & n["_object"].isNotNull())
    return F.when(F.size(nodes) == 1, nodes).otherwise(let(resets, without_replaced))


def _by_field(state: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``id, field, _nodes``: merged state rows brought together by top-level field, the replaced ones
    dropped. A group is as large as the field has paths, not as its history; where the rows are already
    partitioned by ``id``, nothing is shuffled."""
    node = F.struct(
        *STATE_SCHEMA_NAMES[1:], _leaf_at(order).alias("_leaf"), _object_at(order).alias("_object")
    )
    grouped = state.groupBy("id", F.col("path")[0].alias("field")).agg(F.collect_list(node).alias("_nodes"))
    return grouped.withColumn("_nodes", _live(F.col("_nodes")))


def drop_overwritten(state: DataFrame, order: tuple[str, ...] = TIME_ORDER) -> DataFrame:
    """Merged state rows without those that a newer leaf above them has replaced, in one pass.

    Keeps the state of a document as small as the document: without it, an object that is reset
    again and again would leave all its former members behind.
    """
    return _by_field(state, order).select("id", F.inline("_nodes")).select(*STATE_SCHEMA_NAMES)


def _rebuilt(nodes: Column) -> Column:
    """The JSON token of one top-level field from its live nodes.

    In the order of their paths an object comes right before its members, so each node adds its own text,
    after as many closing braces as it stands higher than the node before.
    """

    def from_sorted(sorted_: Column) -> Column:
        def token(node: Column) -> Column:
            return F.when(node["is_object"], "{").otherwise(node["token"])

        def closed(node: Column, depth: Column) -> Column:
            return F.repeat(F.lit("}"), F.size(node["path"]) - depth + node["is_object"].cast("int"))

        def text(node: Column, at: Column) -> Column:
            depth, before = F.size(node["path"]), F.get(sorted_, at - 1)
            separator = F.when(depth > F.size(before["path"]), "").otherwise(F.concat(closed(before, depth), F.lit(",")))
            named = F.concat(separator, quoted(F.get(node["path"], depth - 1)), F.lit(":"), token(node))
            return F.when(at == 0, token(node)).otherwise(named)

        last = F.get(sorted_, F.size(sorted_) - 1)
        return F.concat(F.array_join(F.transform(sorted_, text), ""), closed(last, F.lit(1)))

    def seen(node: Column) -> Column:
        is_object = F.coalesce(node["_object"] > node["_leaf"], node["_leaf"].isNull())
        return F.struct(node["path"].alias("path"), is_object.alias("is_object"), node["token"].alias("token"))

    return let(F.array_sort(F.transform(nodes, seen)), from_sorted)


def state_fields(state: DataFrame, order: tuple[str, ...] = TIME_ORDER) -> DataFrame:
    """``id, field, token`` of the live top-level fields of merged state rows, which are read once."""
    grouped = _by_field(state, order).filter(F.size("_nodes") > 0)
    return grouped.select("id", "field", _rebuilt(F.col("_nodes")).alias("token"))


def state_documents(state: DataFrame, order: tuple[str, ...] = TIME_ORDER) -> DataFrame:
    """``id, source``: every document of merged state rows as JSON text, keys sorted."""
    entries = state_fields(state, order).groupBy("id").agg(F.collect_list(F.struct("field", "token")).alias("_e"))
    return entries.select("id", render_object(F.col("_e"), "field", "token").alias("source"))


def update_documents(state: DataFrame, order: tuple[str, ...] = TIME_ORDER) -> DataFrame:
    """State rows of one batch as partial updates for a store that merges by itself:
    ``id, step, source``, to be applied in ``step`` order per id.

    Where the batch wrote a leaf and later an object at the same path, the store must forget what
    lies below that path first, so a null is sent ahead of the document, outer paths before inner ones.
    """
    live = drop_overwritten(state, order)
    opened = F.array_join(F.transform("path", lambda name: F.concat(F.lit("{"), quoted(name), F.lit(":"))), "")
    reset = F.concat(opened, F.lit("null"), F.repeat(F.lit("}"), F.size("path")))
    replaced = live.filter(_leaf_at(order) < _object_at(order))
    resets = replaced.select("id", F.size("path").alias("step"), reset.alias("source"))
    last = F.lit(2**31 - 1).alias("step")
    return resets.unionByName(state_documents(state, order).select("id", last, "source"))
