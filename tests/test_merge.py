from __future__ import annotations

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from keyfold.operators import deep_merge, merge, messages


def documents(log, *items):
    return messages.documents(messages.parse_messages(log(*items)))


def as_dicts(frame):
    return {r.id: json.loads(r.source) for r in frame.collect()}


def flat(frame):
    return {(r.id, r.field): r.val for r in merge.field_text(frame).collect()}


def test_field_merge_keeps_fields_that_later_messages_leave_out(log):
    docs = documents(log, '{"id":"a","x":1}', '{"id":"a","y":2}')
    assert flat(merge.field_merge(docs)) == {("a", "id"): "a", ("a", "x"): "1", ("a", "y"): "2"}
    last = merge.keep_last(docs.select("id", "value", "ts", "part", "pos")).collect()
    assert [r.value for r in last] == ['{"id":"a","y":2}']


def test_null_policies(log):
    docs = documents(log, '{"id":"a","x":1}', '{"id":"a","x":null}')
    assert flat(merge.field_merge(docs))[("a", "x")] is None
    assert flat(merge.field_merge(docs, "ignore"))[("a", "x")] == "1"
    with pytest.raises(ValueError):
        merge.field_merge(docs, "other")


def test_wide_state_equals_field_merge(log):
    docs = documents(log, '{"id":"a","x":1,"y":"p"}', '{"id":"a","x":null}', '{"id":"b","y":"q"}')
    rows = {r.id: (r.x, r.y, r.z) for r in merge.wide_state(docs, ["x", "y", "z"]).collect()}
    assert rows == {"a": (None, "p", None), "b": (None, "q", None)}
    rows = {r.id: (r.x, r.y, r.z) for r in merge.wide_state(docs, ["x", "y", "z"], "ignore").collect()}
    assert rows == {"a": ("1", "p", None), "b": (None, "q", None)}


def test_documents_keep_value_types(log):
    merged = merge.field_merge(documents(log, '{"id":"1","n":1,"s":"1","o":{"k":[1,null]},"b":true,"z":null}'))
    row = merge.merged_documents(merged).first()
    assert row.source == '{"b":true,"id":"1","n":1,"o":{"k":[1,null]},"s":"1","z":null}'


def test_order_keys(log):
    # position 5 was stamped before position 4 by a clock that runs backwards
    frame = log((0, 5, '{"id":"a","x":"later"}'), (0, 4, '{"id":"a","x":"earlier"}'))
    docs = messages.documents(messages.parse_messages(frame))
    assert flat(merge.field_merge(docs, order=merge.LOG_ORDER))[("a", "x")] == "later"
    assert flat(merge.field_merge(docs, order=merge.TIME_ORDER))[("a", "x")] == "earlier"


def random_messages(rng, count, nested):
    def value(depth=0):
        kind = rng.random()
        if nested and depth < 3 and kind < 0.5:
            return {rng.choice("pqr"): value(depth + 1) for _ in range(rng.randint(0, 2))}
        return rng.choice([None, 1, "s", [1, {"a": 2}], True, rng.randint(0, 99)])

    hot = ["a"] * 3 + ["b", "c", "d"]
    return [
        {"id": rng.choice(hot), **{rng.choice("xyz"): value() for _ in range(rng.randint(0, 3))}} for _ in range(count)
    ]


def upsert(stored, update, nested, nulls):
    for key, value in update.items():
        if nested and isinstance(value, dict) and isinstance(stored.get(key), dict):
            upsert(stored[key], value, nested, nulls)
        elif value is not None or nulls:
            stored[key] = upsert({}, value, nested, nulls) if nested and isinstance(value, dict) else value
    return stored


def brute_force(sent, nested, nulls=True):
    state = {}
    for message in sent:
        upsert(state.setdefault(message["id"], {}), message, nested, nulls)
    return state


@pytest.mark.parametrize("collapse", [True, False])
@pytest.mark.parametrize("policy", ["overwrite", "ignore"])
def test_field_merge_against_brute_force(log, collapse, policy):
    sent = random_messages(random.Random(7), 300, nested=True)
    docs = documents(log, *map(json.dumps, sent))
    merged = merge.field_merge(docs, policy, collapse_shapes=collapse)
    assert as_dicts(merge.merged_documents(merged)) == brute_force(sent, nested=False, nulls=policy == "overwrite")


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("policy", ["overwrite", "ignore"])
@pytest.mark.parametrize("nested", [True, False])
def test_nested_merge_against_brute_force(log, seed, policy, nested):
    sent = random_messages(random.Random(seed), 200, nested=True)
    docs = documents(log, *map(json.dumps, sent))
    got = as_dicts(deep_merge.state_documents(deep_merge.state_rows(docs, policy, nested=nested)))
    assert got == brute_force(sent, nested, nulls=policy == "overwrite")


def test_state_does_not_depend_on_batches_or_replays(log):
    rng = random.Random(11)
    sent = random_messages(rng, 240, nested=True)
    docs = documents(log, *map(json.dumps, sent)).cache()
    whole = as_dicts(deep_merge.state_documents(deep_merge.state_rows(docs)))
    assert whole == brute_force(sent, nested=True)
    cuts = [(0, 100), (80, 150), (20, 90), (150, 240)]
    pieces = [deep_merge.state_rows(docs.filter(F.col("pos").between(low, high - 1))) for low, high in cuts]
    folded = deep_merge.merge_rows(messages.union_logs(*pieces))
    assert as_dicts(deep_merge.state_documents(folded)) == whole
    docs.unpersist()


def test_members_of_replaced_objects_do_not_pile_up(log):
    sent = []
    for i in range(60):
        sent.append({"id": "a", "o": {f"k{i}": {"n": i}}})
        if i % 10 == 9:
            sent.append({"id": "a", "o": None})
    sent.append({"id": "a", "o": {"last": 1}})
    state = deep_merge.state_rows(documents(log, *map(json.dumps, sent)))
    # id, o and o.last remain, and of the sixty members nothing
    assert state.count() == 3 + 2 * 60
    live = deep_merge.drop_overwritten(state)
    assert sorted(tuple(r.path) for r in live.collect()) == [("id",), ("o",), ("o", "last")]
    assert as_dicts(deep_merge.state_documents(live)) == {"a": {"id": "a", "o": {"last": 1}}}
    # the reset outlives the members, so replaying an old message does not bring one back
    replayed = deep_merge.state_rows(documents(log, json.dumps(sent[0])))
    both = deep_merge.merge_rows(live.unionByName(replayed))
    assert as_dicts(deep_merge.state_documents(both)) == {"a": {"id": "a", "o": {"last": 1}}}


def test_numbers_in_nested_objects_keep_their_digits(log):
    sent = '{"id":"a","o":{"big":12345678901234567890123,"dec":0.12345678901234567891,"s":"é\\n"}}'
    rows = deep_merge.state_documents(deep_merge.state_rows(documents(log, sent))).collect()
    assert rows[0].source == '{"id":"a","o":{"big":12345678901234567890123,"dec":0.12345678901234567891,"s":"é\\n"}}'


DIGITS = {
    "a": "5.0",
    "b": "100.00",
    "c": "123456789012345678901234567890123456789012",
    "d": "0.1234567890123456789012345678901234567890123",
    "e": "1e400",
    "f": "-12345678901234567890.0",
    "g": '{"w":5.0,"x":{"y":[1.50,"2.50",-0.0]}}',
    "h": '[1.0,{"k":"a\\"1.0\\\\"},1E5]',
    "i": "7",
}


@pytest.mark.parametrize("nested", [True, False])
def test_numbers_come_back_digit_for_digit(log, nested):
    message = '{"id":"1","s":"Infinity","t":"1.50",' + ",".join(f'"{k}":{v}' for k, v in DIGITS.items()) + "}"
    docs = documents(log, message)
    whole = "{" + ",".join(f'"{k}":{v}' for k, v in [*DIGITS.items(), ("id", '"1"'), ("s", '"Infinity"'), ("t", '"1.50"')]) + "}"
    assert merge.merged_documents(merge.field_merge(docs)).first().source == whole
    state = deep_merge.state_rows(docs, nested=nested)
    assert deep_merge.state_documents(state).first().source == whole
    assert deep_merge.update_documents(state).first().source == whole
    texts = flat(merge.field_merge(docs))
    assert {k: texts["1", k] for k in "abcdefi"} == {k: DIGITS[k] for k in "abcdefi"}
    assert (texts["1", "s"], texts["1", "t"]) == ("Infinity", "1.50")
    wide = merge.wide_state(docs, list("abcdefi")).first()
    assert [wide[k] for k in "abcdefi"] == [DIGITS[k] for k in "abcdefi"]


def test_texts_that_are_read_leniently_are_stored_strictly(log):
    docs = documents(log, """{'id':'1','o':{'p':[1.0,'it"s']},"q":"it's 1.0"}""")
    assert merge.merged_documents(merge.field_merge(docs)).first().source == (
        """{"id":"1","o":{"p":[1.0,"it\\"s"]},"q":"it's 1.0"}"""
    )


def test_unquoted_names_are_an_option(log):
    frame = log('{id:"1",a1:2.50}')
    assert messages.documents(messages.parse_messages(frame)).count() == 0
    docs = messages.documents(messages.parse_messages(frame, unquoted_names=True))
    assert merge.merged_documents(merge.field_merge(docs)).first().source == '{"a1":2.50,"id":"1"}'


def test_a_message_with_a_repeated_key_and_many_others_is_read_in_time(log):
    many = 20_000
    message = "{" + ",".join(f'"k{i}":{i}.0' for i in range(many)) + ',"id":"1","k0":1.0}'
    started = time.monotonic()
    fields = flat(merge.field_merge(documents(log, message)))
    assert len(fields) == many + 1 and (fields["1", "k0"], fields["1", "k7"]) == ("1.0", "7.0")
    assert time.monotonic() - started < 20


def test_hot_id_is_reduced_before_the_shuffle(spark, log):
    docs = documents(log, *[json.dumps({"id": "a", "n": i}) for i in range(50)])
    plan = merge.field_merge(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max_by") == 2
    assert "collect_list" not in plan
