from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from keyfold.functions import glob_prefix, glob_to_regex, int_of, long_of, object_json, text_of
from keyfold.operators import messages


def read(log, column, *tokens):
    values = ['{"id":"a"}' if t is None else f'{{"id":"a","n":{t}}}' for t in tokens]
    parsed = messages.parse_messages(log(*values))
    return [r.n for r in parsed.select("pos", column(F.col("fields"), "n").alias("n")).orderBy("pos").collect()]


def test_int_read(log):
    cases = {
        None: 0,
        "null": 0,
        '""': 0,
        '"null"': 0,
        "1": 1,
        '"1"': 1,
        "1.0": 1,
        "1.9": 1,
        "-1.9": -1,
        "1e2": 100,
        "true": 1,
        "false": 0,
        '"1,234"': 1234,
        '"abc"': None,
        '"1.5"': None,
        "99999999999": None,
        "{}": None,
        "[1]": None,
    }
    assert read(log, int_of, *cases) == list(cases.values())


def test_long_read(log):
    cases = {
        None: 0,
        "99999999999": 99999999999,
        '"99999999999"': 99999999999,
        '"2019-08-14 16:54:00"': 1565801640000,
        '"2019-08-14"': 1565740800000,
        '"2019-13-99"': None,
        "9007199254740993": 9007199254740993,
        "9007199254740993.7": 9007199254740993,
    }
    assert read(log, long_of, *cases) == list(cases.values())


def test_text_read(log):
    cases = {None: None, "null": None, '""': "", "1": "1", "1.0": "1.0", '"1.0"': "1.0", "true": "true", '{"a":1}': '{"a":1}'}
    assert read(log, text_of, *cases) == list(cases.values())


def test_object_json_drops_null_fields_and_keeps_types(log):
    parsed = messages.parse_messages(log('{"id":"1","a":null,"b":1,"c":"1","d":[null],"e":true}'))
    assert parsed.select(object_json(F.col("fields")).alias("j")).first().j == '{"id":"1","b":1,"c":"1","d":[null],"e":true}'


@pytest.mark.parametrize(
    ("pattern", "hits", "misses"),
    [
        ("a*", ["a", "abc", "a\nb"], ["ba"]),
        ("a?c", ["abc", "a.c"], ["ac", "abbc"]),
        ("k:[13]", ["k:1", "k:3"], ["k:2", "k:13"]),
        ("k:[^1]", ["k:2"], ["k:1", "k:"]),
        ("k:[a-c]x", ["k:ax", "k:cx"], ["k:dx", "k:-x"]),
        ("k:[c-a]", ["k:b"], ["k:d"]),
        (r"a\*b", ["a*b"], ["axb"]),
        (r"[\]x]", ["]", "x"], ["\\"]),
        ("a.b+(c)|$", ["a.b+(c)|$"], ["axb+(c)|$"]),
        ("[^]", ["x"], [""]),
        ("[]", [], ["", "]", "x"]),
        ("", [""], ["a"]),
    ],
)
def test_globs(spark, pattern, hits, misses):
    regex = glob_to_regex(pattern)
    keys = [(k,) for k in hits + misses]
    found = spark.createDataFrame(keys, "key string").filter(F.col("key").rlike(regex)).collect()
    assert sorted(r.key for r in found) == sorted(hits)
    assert all(k.startswith(glob_prefix(pattern)) for k in hits)
    assert re.compile(regex.replace("\\z", "\\Z"))
