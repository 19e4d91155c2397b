"""User profiles: admission and projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.functions import int_of, long_of, quoted, text_of
from keyfold.operators.deep_merge import leaf_rows, merge_rows
from keyfold.operators.merge import TIME_ORDER, newest_columns
from keyfold.operators.messages import POSITION, bind, unreadable_reason

# The profile's key and fields.
KEY_SEPARATOR = "|"
TEXT_FIELDS = ("app_id", "user_id", "nick_name", "real_name", "user_identity", "phone", "collection_phone")
PROFILE_COLUMNS = [
    "id",
    "app_id",
    "user_id",
    "nick_name",
    "real_name",
    "user_created_at",
    "user_from",
    "user_identity",
    "phone",
    "collection_phone",
]


def _typed() -> dict[str, Column]:
    fields = F.col("fields")
    columns = {name: text_of(fields, name) for name in TEXT_FIELDS}
    columns["user_created_at"] = long_of(fields, "user_created_at")
    columns["user_from"] = int_of(fields, "user_from")
    columns["id"] = F.concat(columns["app_id"], F.lit(KEY_SEPARATOR), columns["user_id"])
    return columns


def _fault(typed: dict[str, Column]) -> Column:
    data_source = text_of(F.col("fields"), "data_source")
    required = {"data_source": data_source, "app_id": typed["app_id"], "user_id": typed["user_id"]}
    missing = [F.when(F.coalesce(text, F.lit("")) == "", f"{name}_missing") for name, text in required.items()]
    bad_number = F.when(typed["user_created_at"].isNull() | typed["user_from"].isNull(), "bad_int")
    return F.coalesce(unreadable_reason(), *missing, bad_number)


def profile_reason() -> Column:
    """Why a message is no user profile; null for a profile."""
    return _fault(_typed())


def profiles(parsed: DataFrame) -> DataFrame:
    """The ten profile columns of each admitted message (P4), and its position."""
    typed = bind(parsed.select(*POSITION, "value", "fields"), **_typed())
    admitted = typed.filter(_fault({name: F.col(name) for name in PROFILE_COLUMNS}).isNull())
    return admitted.select(*PROFILE_COLUMNS, *POSITION)


def profile_json(rows: DataFrame) -> DataFrame:
    """``id`` and the profile as JSON text; null columns are left out."""
    return rows.select("id", F.to_json(F.struct(*PROFILE_COLUMNS)).alias("source"), *POSITION)


def profile_state(rows: DataFrame, order: tuple[str, ...] = TIME_ORDER) -> DataFrame:
    """Profiles as state rows of the store, written from their typed columns; null columns write
    nothing."""
    numbers = ("user_created_at", "user_from")
    leaves = F.array(
        *[
            F.struct(
                F.array(F.lit(name)).alias("path"),
                (F.when(F.col(name).isNotNull(), F.col(name).cast("string") if name in numbers else quoted(F.col(name)))).alias("token"),
            )
            for name in PROFILE_COLUMNS
        ]
    )
    written = rows.select("id", *TIME_ORDER, F.inline(F.filter(leaves, lambda leaf: leaf["token"].isNotNull())))
    return merge_rows(leaf_rows(written), order)


def profile_upsert(rows: DataFrame, order: tuple[str, ...] = TIME_ORDER) -> DataFrame:
    """Current profile per id. Text that a message leaves out survives; the two numbers are always
    written (0 when absent), so the newest message decides them."""
    numbers = ["user_created_at", "user_from"]
    merged = newest_columns(rows, "id", numbers, list(TEXT_FIELDS), order)
    return merged.select(*PROFILE_COLUMNS)

