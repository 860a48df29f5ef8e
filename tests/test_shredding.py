"""Nested records to flat tables: levels, positions, odd layouts and odd rows."""

import json

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from silkmill.operators.shredding import LeafPath, assembled, outermost_json, rebuild, rebuild_table, records_in, shred, shred_arrow, shred_raw, shred_record, slot_positions
from silkmill.operators.tool_tables import argument_table, call_table, child_items, function_table, property_table

REQ = LeafPath("f[].p.r[]")
EXAMPLE = "example_id long, question string, function array<struct<name string, description string, parameters struct<type string, properties map<string,struct<type string,description string>>, required array<string>>>>, input_parameters array<struct<function_name string, arguments map<string,string>>>"


def flat(record):
    """The positions and values that the path means, by plain loops."""
    out = []
    for i, f in enumerate(record.get("f") or []):
        for j, r in enumerate(((f or {}).get("p") or {}).get("r") or []):
            if r is not None:
                out.append((i, j, r))
    return out


entry = st.one_of(st.none(), st.text(alphabet="abc", max_size=3))
records = st.fixed_dictionaries({}, optional={"f": st.one_of(st.none(), st.lists(st.one_of(st.none(), st.fixed_dictionaries({}, optional={"p": st.one_of(st.none(), st.fixed_dictionaries({}, optional={"r": st.one_of(st.none(), st.lists(entry, max_size=3))}))})), max_size=3))})


@settings(max_examples=200, deadline=None)
@given(st.lists(records, max_size=4))
def test_levels_round_trip(many):
    rep, level, values, owner = [], [], [], []
    for k, r in enumerate(many):
        a, b, c = shred_record(r, REQ)
        rep += a
        level += b
        values += c
        owner += [k] * len(a)
    pos = slot_positions(np.array(rep, np.int32), np.array(level, np.int32), REQ.slot_levels())
    got = [(o, *map(int, p), v) for o, p, v, d in zip(owner, pos, values, level, strict=True) if d == REQ.full]
    assert got == [(k, *x) for k, r in enumerate(many) for x in flat(r)]


ITEM = pa.struct([("k", pa.string()), ("m", pa.map_(pa.string(), pa.struct([("t", pa.string())]))), ("r", pa.list_(pa.string())), ("o", pa.struct([("l", pa.list_(pa.list_(pa.string())))]))])
LEAVES = [LeafPath(p) for p in ("f[].k", "f[].m{}.key", "f[].m{}.value.t", "f[].r[]", "f[].o.l[]", "f[].m.a.t")]
text = st.one_of(st.none(), st.sampled_from(["a", "b", "[1, null]", '{"text": "z"}', ""]))
maps = st.one_of(st.none(), st.dictionaries(st.sampled_from("abc"), st.one_of(st.none(), st.fixed_dictionaries({"t": text})), max_size=3))
items = st.one_of(st.none(), st.fixed_dictionaries({"k": text, "m": maps, "r": st.one_of(st.none(), st.lists(text, max_size=3)), "o": st.one_of(st.none(), st.fixed_dictionaries({"l": st.one_of(st.none(), st.lists(st.one_of(st.none(), st.lists(text, max_size=2)), max_size=2))}))}))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(items, max_size=3)), max_size=4), st.integers(0, 2))
def test_arrow_levels_and_records(many, skip):
    """Levels from offsets equal those of a walk, also in a slice of an array, and the levels give the record back."""
    plain = [None if x is None else [None if i is None else {**i, "m": None if i["m"] is None else list(i["m"].items())} for i in x] for x in many]
    column = pa.array([None] * skip + plain, pa.list_(ITEM)).slice(skip)
    for own in (None, "text"):
        for path in (*LEAVES, LeafPath("f[].r[]", own)):
            record, rep, level, values = shred_arrow({"f": column}, len(many), path)
            for k, x in enumerate(many):
                got = (rep[record == k].tolist(), level[record == k].tolist(), values.filter(pa.array(record == k)).to_pylist())
                assert got == shred_record({"f": x}, path)
    lists = [LeafPath(p) for p in ("f[].k", "f[].m{}.key", "f[].m{}.value.t", "f[].r[]")]
    for x in many:
        want = {"f": None if x is None else [None if i is None else {"k": i["k"], "m": None if i["m"] is None else [{"key": k, "value": v} for k, v in i["m"].items()], "r": i["r"]} for i in x]}
        assert assembled({p: shred_record({"f": x}, p) for p in lists}) == want


def test_json_text_and_single_values():
    path = LeafPath("c[].a.u[]", own="text")
    record = {"c": {"a": json.dumps({"u": json.dumps([{"text": "x", "replies": [{"text": "no"}]}, None, "y", {"stars": 1}])})}}
    rep, level, values = shred_record(record, path)
    assert [v for v, d in zip(values, level, strict=True) if d == path.full] == ["x", "y"]
    assert slot_positions(np.array(rep), np.array(level), path.slot_levels())[:, 1].tolist() == [0, 1, 2, 3]
    assert shred_record({"c": [{"a": {"u": "{not json"}}]}, path)[2] == ["{not json"]


def test_outermost_json():
    assert outermost_json('see [图] and [1]: ```json\n{"a": [1]}\n``` bye') == {"a": [1]}
    assert outermost_json('[{"example_id": 1}, {"example_id": 2') is None
    assert outermost_json('{"result": {"example_id": 1}') is None
    for nothing in (None, "", "refused", "[]", "[1, 2]"):
        assert outermost_json(nothing) is None
    assert [r["example_id"] for r in records_in({"data": {"items": ['{"example_id": 3}', [{"example_id": 4}]]}}, "example_id")] == [3, 4]


def test_tables(spark):
    f = lambda name, req: {"name": name, "description": None, "parameters": None if req is None else {"type": "object", "properties": None, "required": req}}
    rows = [
        (1, "q", [f("a", ["x", None, "y"]), None, f("b", None)], [{"function_name": "a", "arguments": {"user_review": '["good", "", {"text": "fine"}]'}}, {"function_name": "b", "arguments": None}]),
        (1, "q", [f("a", ["x", None, "y"]), None, f("b", None)], [{"function_name": "a", "arguments": {"user_review": '["good", "", {"text": "fine"}]'}}, {"function_name": "b", "arguments": None}]),
        (2, None, None, None),
        (3, "", [], []),
    ]
    examples = spark.createDataFrame(rows, EXAMPLE).selectExpr("*", "'clash' AS record_id", "'clash' AS path")
    raw = spark.createDataFrame([(1, '{"example_id": 9, "function": {"name": "c", "parameters": {"required": "z"}}, "input_parameters": {"arguments": {"user_review": "ok"}}}'), (2, None), (3, "no"), (4, '[{"example_id": 8, "function": [{"parameters": {"required": ["q"]}}]}, {"ex')], "raw_id long, raw string")
    got = {tuple(r) for r in child_items(examples, raw).collect()}
    assert got == {(1, "required", 0, 0, "x"), (1, "required", 0, 2, "y"), (1, "user_review", 0, 0, "good"), (1, "user_review", 0, 2, "fine"), (9, "required", 0, 0, "z"), (9, "user_review", 0, 0, "ok")}
    assert child_items(examples, raw).count() == len(got)
    assert {tuple(r) for r in function_table(examples, raw).collect()} == {(1, 0, "a", None, "object"), (1, 2, "b", None, None), (8, 0, None, None, None), (9, 0, "c", None, None)} - {(8, 0, None, None, None)}
    more = spark.createDataFrame([(1, '{"example_id": 7, "function": [{"name": "n", "parameters": {"properties": {"x": {"type": "string"}, "y": "{\\"type\\": \\"integer\\"}", "z": null}}}], "input_parameters": [{"arguments": "{\\"b\\": [1, \\"two\\"], \\"c\\": null}"}]}')], raw.schema)
    assert {tuple(r) for r in property_table(examples, more).collect()} == {(7, 0, 0, "x", "string", None), (7, 0, 1, "y", "integer", None), (7, 0, 2, "z", None, None)}
    assert {tuple(r) for r in argument_table(examples, more).where("example_id = 7").collect()} == {(7, 0, 0, "b", '[1, "two"]'), (7, 0, 1, "c", None)}
    assert argument_table(examples, None).count() == 1
    assert {tuple(r) for r in call_table(examples, None).collect()} == {(1, 0, "a"), (1, 1, "b")}
    empty = examples.where("false")
    assert child_items(empty, raw.where("false")).count() == 0


def test_generic_shred(spark):
    df = spark.createDataFrame([(1, [[1, 2], None, []]), (2, None)], "id long, m array<array<int>>")
    path = LeafPath("m[]")
    got = sorted(tuple(r) for r in rebuild(shred(df, "id", ["m"], [path]), [path]).collect())
    assert [(g[0], g[2]) for g in got] == [(1, 0), (1, 2)]
    assert shred_raw(spark.createDataFrame([("[" * 5000,)], "raw string"), "raw", "id", [path]).count() == 0
    with pytest.raises(ValueError):
        rebuild(shred(df, "id", ["m"], [path]), [path, LeafPath("a.b")])
    inner = LeafPath("m[].no")
    assert sorted(tuple(r) for r in rebuild_table(shred(df, "id", ["m"], [path, inner]), {"v": path, "w": inner}).collect()) == [(1, 0, "[1, 2]", None), (1, 2, "[]", None)]
