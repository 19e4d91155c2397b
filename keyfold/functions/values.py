"""Typed reads from a message's ``fields``, and JSON text out of it.

``fields`` is a ``map<string, struct<value variant, text string>>``. ``value`` tells the type and holds what
fits a variant; ``text`` is the text as it came, where a number in the message might not fit one, else null.
All of it is built-in column functions, so it stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers whose digits a variant may change: fractions, exponents, and more than 18 digits.
INEXACT_NUMBER = r"\d[.eE]|\d{19}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def entry(value: Column, text: Column | None = None) -> Column:
    """An entry of ``fields``."""
    return F.struct(value.alias("value"), (F.lit(None).cast("string") if text is None else text).alias("text"))


def entries_of(variants: Column) -> Column:
    """``fields`` from a map of variants whose numbers are all exact."""
    return F.transform_values(variants, lambda _, v: entry(v))


def entry_text(one: Column) -> Column:
    """An entry as text: strings unquoted, numbers digit for digit, JSON null as SQL null, objects and
    arrays as JSON."""
    return F.coalesce(one["text"], one["value"].cast("string"))


def text_of(fields: Column, name: str) -> Column:
    """String read: the value's text, null when the field is absent or JSON null."""
    return entry_text(fields[name])


def is_null(one: Column) -> Column:
    return F.is_variant_null(one["value"])


def _whole_number(value: Column, sql_type: str, otherwise: Callable[[Column], Column] | None = None) -> Column:
    """Whole number from a variant. Absent, null and '' count as 0, fractions are cut off, booleans
    are 1 or 0, text may have thousands commas. Null means the value is no number of that type."""

    def from_text(text: Column) -> Column:
        plain = F.replace(text, F.lit(","), F.lit("")).try_cast(sql_type)
        return F.when(text.isin("", "null", "NULL"), F.lit(0).cast(sql_type)).otherwise(
            F.coalesce(plain, otherwise(text)) if otherwise else plain
        )

    number = F.try_variant_get(value, "$", sql_type)
    return F.when(value.isNull() | F.is_variant_null(value), F.lit(0).cast(sql_type)).otherwise(
        F.coalesce(number, let(value.cast("string"), from_text))
    )


def int_of(fields: Column, name: str) -> Column:
    """Integer read, see :func:`_whole_number`."""
    return _whole_number(fields[name]["value"], "int")


def long_of(fields: Column, name: str) -> Column:
    """Long read. ISO date text is read as epoch milliseconds in the session time zone."""

    def from_date(text: Column) -> Column:
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.unix_millis(text.try_cast("timestamp")))

    return _whole_number(fields[name]["value"], "bigint", from_date)


def is_object(one: Column) -> Column:
    """True for an entry that holds a JSON object (not for text that looks like one)."""
    return F.try_variant_get(one["value"], "$", "map<string,variant>").isNotNull()


def json_token(one: Column) -> Column:
    """An entry as the JSON text that stands for it, ``"a"`` or ``5.0`` or ``null``."""
    text, known = one["text"], F.to_json(one["value"])
    # a number beyond doubles is written as the string "Infinity"
    beyond = known.isin('"Infinity"', '"-Infinity"') & ~text.isin("Infinity", "-Infinity")
    return F.when(text.isNull(), known).when(known.startswith('"') & ~beyond, known).otherwise(text)


def object_json(fields: Column) -> Column:
    """A message as JSON text without its null fields, in message order."""
    kept = F.filter(F.map_entries(fields), lambda e: ~is_null(e["value"]))
    return joined_object(F.transform(kept, lambda e: F.struct(e["key"].alias("k"), json_token(e["value"]).alias("v"))))


def joined_object(pairs: Column) -> Column:
    """JSON object text from an array of structs ``k`` (a name) and ``v`` (a finished JSON token)."""

    def member(pair: Column) -> Column:
        return F.concat(quoted(pair["k"]), F.lit(":"), pair["v"])

    return F.concat(F.lit("{"), F.array_join(F.transform(pairs, member), ","), F.lit("}"))


def quoted(text: Column) -> Column:
    """Text as a JSON string."""
    return let(F.to_json(F.array(text)), lambda listed: F.substr(listed, F.lit(2), F.length(listed) - 2))


def render_object(entries: Column, name: str, token: str) -> Column:
    """JSON object text from an array of structs holding a key and a finished JSON token.

    Keys come out sorted, so equal documents have equal text.
    """
    return joined_object(F.array_sort(F.transform(entries, lambda e: F.struct(e[name].alias("k"), e[token].alias("v")))))
