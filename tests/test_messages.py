from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from keyfold.functions import object_json, text_of
from keyfold.operators import messages

MALFORMED = [
    '{"id":"a"} junk',
    '{"id":"a"}]',
    '{"id":"a"}}',
    '{"id":"a"}}]',
    '{"id":"a"}],[1',
    '{"id":"a"},{"id":"b"}',
    '{"id":"a"},"z":{}',
    '{"id":"a"},"e":{"h":1}',
    '{"id":"a"},"e":{"h":1}} junk',
    '{"id":"a"}} junk',
    '{"id":"a"}//c',
    '{"id":"a"}/*',
    "null",
    '"str"',
    "[1]",
    "5",
    "   ",
    '{"id":"a" "b":1}',
    '{"id":"a","b":}',
    '{"id":"a",}',
    '{"id":"u',
    '{"id":tru}',
    "{id:1}",
    '{"id":01}',
]
KEPT = {
    '{"id":" "}': " ",
    '{"id":5.0}': "5.0",
    '{"id":5}': "5",
    '{"id":-7.0}': "-7.0",
    '{"id":1.25}': "1.25",
    '{"id":12345678901234567890}': "12345678901234567890",
    '{"id":"5"}': "5",
    '{"id":true}': "true",
    '{"id":{"k":1}}': '{"k":1}',
    '{"id":[1,"a"]}': '[1,"a"]',
    '{"id":"a","id":"b"}': "b",
    '{"x":1,"id":"a","x":2,"id":"b","y":null}': "b",
    ' {"id":"x"}\n': "x",
    "{'id':'q'}": "q",
    '{"id":"\\u0041é\\"}]"}': 'Aé"}]',
    '{"id":"a","e":{"h":1},"r":{}}': "a",
    '{"id":"a","o":{"x":1,"x":2}}': "a",
}


def reasons(log, *values):
    parsed = messages.parse_messages(log(*values))
    rows = parsed.select("pos", messages.document_reason().alias("reason")).orderBy("pos").collect()
    return [r.reason for r in rows]


def test_malformed_values_are_rejected(log):
    assert reasons(log, *MALFORMED) == ["malformed"] * len(MALFORMED)


def test_other_reasons(log):
    values = [None, "", "{}", '{"id":null}', '{"id":""}', '{"id":"a"}', '{"id":"a","id":null}']
    expected = ["empty", "empty", "id_missing_or_null", "id_missing_or_null", "id_empty", None, "id_missing_or_null"]
    assert reasons(log, *values) == expected


def test_kept_ids(log):
    docs = messages.documents(messages.parse_messages(log(*KEPT)))
    got = {r.value: r.id for r in docs.collect()}
    assert got == KEPT


def test_last_of_repeated_keys_wins(log):
    parsed = messages.parse_messages(log('{"id":"a","x":1,"y":2,"x":3}'))
    row = parsed.select(F.size("fields").alias("n"), object_json(F.col("fields")).alias("j")).first()
    assert row.n == 3
    assert json.loads(row.j) == {"id": "a", "x": 3, "y": 2}


def _strict(text: str) -> bool:
    def no_constant(name):
        raise ValueError(name)

    try:
        return isinstance(json.loads(text, parse_constant=no_constant), dict)
    except (ValueError, RecursionError):
        return False


@pytest.mark.parametrize("seed", [1, 2])
def test_strictness_matches_an_independent_parser(log, seed):
    rng = random.Random(seed)
    bases = [
        '{"id":"a","n":12.5,"o":{"p":[1,2,{"q":null}]},"s":"x\\"y"}',
        '{"id":5,"t":true,"e":{},"l":[]}',
        '{"id":"u1","data_source":"user_queue","phone":null}',
    ]
    alphabet = '{}[],:"\\ 01eaux.-'
    values = set(bases)
    while len(values) < 1500:
        text = list(rng.choice(bases))
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(text))
            action = rng.random()
            if action < 0.4:
                text.insert(at, rng.choice(alphabet))
            elif action < 0.7 and len(text) > 1:
                del text[at]
            else:
                text[at] = rng.choice(alphabet)
        values.add("".join(text))
    values = sorted(values)
    parsed = messages.parse_messages(log(*values))
    got = {r.value: r.ok for r in parsed.select("value", F.col("fields").isNotNull().alias("ok")).collect()}
    # numbers beyond doubles' range stay numbers for both
    wrong = [v for v in values if got[v] != _strict(v)]
    assert wrong == []


def test_admitted_and_rejected_add_up(log):
    values = [*MALFORMED, *KEPT, None, "", "{}", '{"id":""}']
    parsed = messages.parse_messages(log(*values))
    admitted = messages.documents(parsed).count()
    rejected = messages.rejects(parsed, document=messages.document_reason())
    assert admitted + rejected.count() == len(values)
    assert {r.branch for r in rejected.collect()} == {"document"}


def test_long_texts_are_read_whole(log):
    text = "x 1.50\\ \n" * 200_000 + "end"
    docs = messages.documents(messages.parse_messages(log(json.dumps({"id": "a", "t": text}))))
    assert docs.select(text_of(F.col("fields"), "t").alias("t")).first().t == text


def test_the_parse_appears_once_in_the_plan(log):
    docs = messages.documents(messages.parse_messages(log('{"id":"a"}')))
    plan = docs.filter(F.col("id") > "").select("id", "fields")._jdf.queryExecution().optimizedPlan().toString()
    # one parse for the values, and one, made where a number needs it, for the texts
    assert plan.count("from_json(MapType") == 2
    assert plan.count("from_json(MapType(StringType,MapType(StringType,VariantType") == 1
