"""Decoding of good and corrupt lines; applying operations against a plain sequential fold."""

import json
import random

import pytest
from pyspark.sql import functions as F

from chronofold.operators.apply import apply_chain, apply_operations, fold_operations
from chronofold.operators.decode import decode_lines, with_keys

ITEM = '{"a":{"S":"x"}}'
MATRIX = [
    ('{"Item":%s}' % ITEM, "PUT"),
    ('{"Keys":%s,"NewImage":%s}' % (ITEM, ITEM), "PUT"),
    ('{"Keys":%s,"NewImage":%s,"OldImage":%s}' % (ITEM, ITEM, ITEM), "UPDATE"),
    ('{"Keys":%s,"OldImage":%s}' % (ITEM, ITEM), "DELETE"),
    ('{"Item":%s,"NewImage":"bad"}' % ITEM, "PUT"),
    ("not json", None), ('{"Item":', None), ("", None), ("   ", None), ("[]", None), ("123", None), ("null", None),
    ('{"Item":"str"}', None), ('{"item":%s}' % ITEM, None), ('{"Keys":%s}' % ITEM, None), ('{"Item":%s} trailing' % ITEM, None),
    ('{"Item":%s}{"Item":%s}' % (ITEM, ITEM), None), ("{'Item':{'a':{'S':'x'}}}", None), ('{"Item":{"a":{"S":"x\ty"}}}', None),
    ('{"Item":{"a":{"S":"x"},"a":{"S":"y"}}}', None), ('{"Item":null}', None), ('{"Keys":%s,"NewImage":"bad","OldImage":%s}' % (ITEM, ITEM), None),
]


def test_lines_are_classified_strictly(spark):
    rows = [(k, line) for k, (line, _) in enumerate(MATRIX)]
    got = {r.k: (r.op, r.is_corrupt, r.reason) for r in decode_lines(spark.createDataFrame(rows, "k int, line string")).collect()}
    for k, (line, op) in enumerate(MATRIX):
        assert got[k][0] == op, line
        assert got[k][1] == (op is None) and (got[k][2] is None) == (op is not None)


def test_null_line_and_empty_table(spark):
    assert decode_lines(spark.createDataFrame([(None,)], "line string")).first().is_corrupt
    assert decode_lines(spark.createDataFrame([], "line string")).count() == 0


def image(**named):
    return {k: json.dumps({"N": str(v)}) for k, v in named.items()}


def step(item, op, keys, new, old):
    """The plain meaning of one operation."""
    if op == "PUT":
        return dict(new)
    if op == "DELETE":
        return None
    sets = {k: v for k, v in new.items() if k not in keys}
    removes = [k for k in old if k not in keys and k not in sets]
    if not sets and not removes:
        return item
    out = dict(item if item is not None else keys)
    for k in removes:
        out.pop(k, None)
    return out | sets


def random_log(n=1500, keys=120, seed=1):
    r = random.Random(seed)
    out = []
    for seq in range(n):
        key = image(pk=r.randrange(keys))
        some = lambda: key | image(**{a: r.randrange(9) for a in "abcd" if r.random() < 0.5})  # noqa: B023, E731
        out.append((r.choice(["PUT", "DELETE", "UPDATE", "UPDATE"]), key, some(), some(), seq))
    return out


SCHEMA = "op string, keys map<string,string>, new_image map<string,string>, old_image map<string,string>, seq bigint"


@pytest.mark.parametrize("apply", [apply_operations, fold_operations])
def test_apply_equals_sequential_fold(spark, apply):
    log = random_log()
    state = {}
    for op, key, new, old, _ in log:
        k = json.dumps(key)
        state[k] = step(state.get(k), op, key, new, old)
    expected = sorted(sorted(x.items()) for x in state.values() if x is not None)
    got = sorted(sorted(r.item.items()) for r in apply(spark.createDataFrame(log, SCHEMA)).collect())
    assert got == expected


def test_empty_put_image_and_noop_update(spark):
    key = image(pk=1)
    other = image(pk=2)
    rows = [("PUT", key, {}, None, 0), ("UPDATE", other, other, other, 0)]
    got = apply_operations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.item for r in got] == [{}]


def lines(spark, *records):
    return spark.createDataFrame([(json.dumps(r), 0, 0, k) for k, r in enumerate(records)], "line string, file_ordinal int, block_start bigint, line_number bigint")


def golden(pk, sk, **more):
    return {"pk": {"S": str(pk)}, "sk": {"S": str(sk)}} | {k: {"S": v} for k, v in more.items()}


def test_golden_chain(spark):
    keys = lambda item: {k: item[k] for k in ("pk", "sk")}
    full = lines(spark, *({"Item": golden(1, k, number="1")} for k in (1, 2, 3)))
    put = lambda item: {"Keys": keys(item), "NewImage": item}
    inc1 = lines(spark, *(put(golden(p, k, number="1")) for p in (2, 3) for k in (1, 2, 3)))
    inc2 = lines(
        spark, {"Keys": keys(golden(2, 3)), "OldImage": golden(2, 3)}, {"Keys": keys(golden(1, 1)), "OldImage": golden(1, 1)},
        {"Keys": keys(golden(1, 3)), "NewImage": golden(1, 3, number="1", bin_update="b"), "OldImage": golden(1, 3, number="1")},
        {"Keys": keys(golden(3, 2)), "NewImage": golden(3, 2), "OldImage": golden(3, 2, number="1")}, put(golden(4, 2)),
    )
    logs = [with_keys(decode_lines(x), ["pk", "sk"]) for x in (full, inc1, inc2)]
    for order in ("strict", "batched"):
        assert [apply_chain(logs[: k + 1], order).count() for k in range(3)] == [3, 9, 8]
    items = {tuple(json.loads(r.item[k])["S"] for k in ("pk", "sk")): r.item for r in apply_chain(logs).collect()}
    assert sorted(items) == [("1", "2"), ("1", "3"), ("2", "1"), ("2", "2"), ("3", "1"), ("3", "2"), ("3", "3"), ("4", "2")]
    assert "bin_update" in items["1", "3"] and "number" not in items["3", "2"] and "number" in items["1", "3"]


def test_values(spark):
    from chronofold.functions import values as v

    item = {"Safety.Warning": '{"S":"hot"}', "n": '{"N":"1.50"}', "b": '{"BOOL":true}', "z": '{"NULL":true}', "ss": '{"SS":["b","a"]}', "m": '{"M":{"y":{"SS":["2","1"]},"x":{"N":"1"}}}', "l": '{"L":[{"S":"q"}]}', "bin": '{"B":"aGk="}'}
    again = item | {"ss": '{"SS":["a","b"]}', "m": '{"M":{"x":{"N":"1"},"y":{"SS":["1","2"]}}}'}
    df = spark.createDataFrame([(item, again)], "item map<string,string>, again map<string,string>")
    of = lambda name: v.attribute("item", name)
    r = df.select(
        v.as_string(of("Safety.Warning")), v.as_number_text(of("n")), v.as_boolean(of("b")), v.is_null_value(of("z")), v.is_null_value(of("gone")), v.as_string_set(of("ss")), v.as_binary(of("bin")), v.tag(of("l")),
        v.canonical_item(F.col("item")) == v.canonical_item(F.col("again")), v.as_decimal(of("n"), 2).cast("string"),
    ).first()
    assert list(r) == ["hot", "1.50", True, True, False, ["a", "b"], bytearray(b"hi"), "L", True, "1.50"]
