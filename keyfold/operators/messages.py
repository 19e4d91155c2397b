"""Strict parsing, document admission and quarantine.

A message log has the columns ``topic, part, pos, ts, value``; ``pos`` increases within ``part``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.functions import INEXACT_NUMBER, entry, let, text_of

POSITION = ["topic", "part", "pos", "ts"]


def parse_messages(messages: DataFrame, unquoted_names: bool = False) -> DataFrame:
    """Adds ``fields``, null unless ``value`` is exactly one JSON object (F1); see
    :mod:`keyfold.functions.values` for its entries. ``unquoted_names`` accepts ``{id:"a"}`` too.

    ``from_json`` ignores text after the first value. So the message is parsed inside a wrapper,
    ``{"r": <value>, "e": {"h": <hash of value>}}``: text that closes the wrapper early hides the
    hash, text that adds members changes the size. One parse answers both questions. Only a value
    holding its own hash could pass for clean, and that one is parsed again in an array. Where a number might
    not survive as a variant, a second parse keeps the texts of the fields.
    """
    value = F.col("value")
    options = {"allowUnquotedFieldNames": str(unquoted_names).lower()}
    seal = F.xxhash64(value)
    wrapped = F.concat(F.lit('{"r":'), value, F.lit(',"e":{"h":'), seal.cast("string"), F.lit("}}"))
    listed = F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<map<string,variant>>", options)

    def unwrap(parsed: Column) -> Column:
        clean = (
            (F.size(parsed) == 2)
            & F.try_variant_get(parsed["e"]["h"], "$", "bigint").eqNullSafe(seal)
            & (~F.contains(value, seal.cast("string")) | (F.size(listed) == 1))
        )
        return F.when(clean, parsed["r"])

    variants = let(F.from_json(wrapped, "map<string,map<string,variant>>", options), unwrap)
    texts = F.when(value.rlike(INEXACT_NUMBER), _texts(value, seal, options))
    parsed = bind(messages, _variants=variants, _texts=texts)
    return bind(parsed, fields=_last_key_wins(F.col("_variants"), F.col("_texts"))).drop("_variants", "_texts")


# Signs that no JSON text holds as they are; they stand in for others while numbers are marked.
_OPEN, _CLOSE, _BACKSLASH, _QUOTE, _APOSTROPHE = "\x01\x02\x03\x04\x05"
# Strings and bare words, or a number.
_TOKENS = r"""("[^"]*+"|'[^']*+'|[A-Za-z_$][\w$]*+)|(-?\d[\d.eE+-]*+)"""


def _texts(value: Column, seal: Column, options: dict) -> Column:
    """The texts of a message's fields in order, numbers digit for digit.

    A JSON reader hands numbers on as it understands them. So every number is made a string that holds the
    message's hash, and when the strings are back, what holds the hash is a number again.
    """
    mark = F.concat(F.lit("#"), seal.cast("string"), F.lit("#"))
    escapes = (("\\\\", _BACKSLASH), ('\\"', _QUOTE), ("\\'", _APOSTROPHE))
    text = value
    for escape, sign in escapes:
        text = F.replace(text, F.lit(escape), F.lit(sign))
    text = F.regexp_replace(text, _TOKENS, f"$1{_OPEN}$2{_CLOSE}")
    text = F.replace(text, F.lit(_OPEN + _CLOSE), F.lit(""))
    text = F.replace(F.replace(text, F.lit(_OPEN), F.concat(F.lit('"'), mark)), F.lit(_CLOSE), F.lit('"'))
    for escape, sign in escapes:
        text = F.replace(text, F.lit(sign), F.lit(escape))
    parsed = F.from_json(F.concat(F.lit('{"r":'), text, F.lit("}")), "map<string,map<string,string>>", options)

    def unmarked(one: Column) -> Column:
        inside = F.replace(one, F.concat(F.lit('"'), mark), F.lit(_OPEN))
        return F.replace(F.regexp_replace(inside, f'{_OPEN}([^"]*)"', "$1"), mark, F.lit(""))

    return F.transform(F.map_values(parsed["r"]), unmarked)


def bind(rows: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once, whatever is done with them later.

    Catalyst copies a projected expression into the filters and projections above it; it does not
    copy what a generator returns. The generator only hands on the finished struct, because the
    code of a projection is the better one: common parts are shared, large parts are split.
    """
    one = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.withColumn("_bound", one).select(*rows.columns, F.inline(F.array("_bound")))


def _last_key_wins(variants: Column, texts: Column) -> Column:
    """``fields`` from a parsed map, which keeps repeated keys, and its values' texts in the same order. Only
    a message that repeats a key is sorted for the last place of each."""
    keys, values = F.map_keys(variants), F.map_values(variants)

    def at(place: Column) -> Column:
        return F.struct(F.get(keys, place).alias("key"), entry(F.get(values, place), F.get(texts, place)).alias("value"))

    def last_places(sorted_: Column) -> Column:
        def is_last(one: Column, i: Column) -> Column:
            return ~F.coalesce(F.get(sorted_, i + 1)["key"] == one["key"], F.lit(False))

        return F.array_sort(F.transform(F.filter(sorted_, is_last), lambda one: one["place"]))

    by_key = F.array_sort(F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("place"))))
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    places = F.when(repeated, let(by_key, last_places)).otherwise(F.transform(keys, lambda _, i: i))
    return F.when(variants.isNotNull(), F.map_from_entries(F.transform(places, at)))


def unreadable_reason() -> Column:
    """Why a value has no fields; null when it has."""
    return F.when(F.col("value").isNull() | (F.col("value") == ""), "empty").when(
        F.col("fields").isNull(), "malformed"
    )


def document_reason() -> Column:
    """Why a parsed message is no document; null for a document (F2)."""
    def rule(doc_id: Column) -> Column:
        return F.when(doc_id.isNull(), "id_missing_or_null").when(doc_id == "", "id_empty")

    return F.coalesce(unreadable_reason(), let(text_of(F.col("fields"), "id"), rule))


def documents(parsed: DataFrame) -> DataFrame:
    """Messages that are documents, with their ``id`` as text; ``value`` is the raw text (P1) and
    ``fields`` the parsed message (P2)."""
    return bind(parsed, id=text_of(F.col("fields"), "id")).filter(F.col("id") != "")


def rejects(parsed: DataFrame, **reasons: Column) -> DataFrame:
    """Quarantine rows (F5): one per message and branch that turned it down.

    ``reasons`` maps a branch name to its reason column; all branches share one pass.
    """
    found = F.array(
        *[F.struct(F.lit(branch).alias("branch"), reason.alias("reason")) for branch, reason in reasons.items()]
    )
    return (
        parsed.select(*POSITION, "value", F.explode(found).alias("_r"))
        .select(*POSITION, "value", "_r.branch", "_r.reason")
        .filter(F.col("reason").isNotNull())
    )


def reject_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("branch", "reason").agg(F.count(F.lit(1)).alias("n"))


def union_logs(*logs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, logs)
