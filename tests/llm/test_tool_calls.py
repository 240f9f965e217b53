import json

from isohyet.llm import tool_calls as T

SCHEMAS = [("add", "a", "integer", True), ("add", "b", "number", True), ("add", "note", "string", False), ("now", None, None, None)]


def _linked(spark, calls, results):
    out = T.link(spark.createDataFrame(calls, "conv_id long, call_id string, parent_id string, name string, arguments string"),
                 spark.createDataFrame(results, "conv_id long, call_id string, content string"),
                 spark.createDataFrame(SCHEMAS, "name string, param string, type string, required boolean")).collect()
    return {(r.conv_id, r.call_id, r.kind): r for r in out}, out


def test_links_order_and_errors(spark):
    calls = [
        (1, "a", None, "add", '{"b": 2.5, "a": 1}'), (1, "b", "a", "add", '{"a": "1", "x": 2}'), (1, "c", "b", "now", "{}"), (1, "d", "gone", "now", " { } "),
        (2, "a", "b", "now", "{}"), (2, "b", "a", "now", "{}"), (2, "c", "a", "now", "{}"),
        (3, "a", None, "fly", '{"b":1}'), (3, "b", None, "add", "not json"), (3, "c", None, "add", None), (3, "d", None, "add", "[1]"),
        (4, "a", None, "now", "{}"), (4, "a", None, "now", "{}"), (4, "b", None, "now", "{}"), (4, "b", None, "now", '{"z":1}'),
        (None, "a", None, "now", "{}"), (5, None, None, "now", "{}"),
    ]
    results = [(1, "a", 'said "hi"\n'), (1, "zz", "lost"), (4, "a", "r"), (4, "a", "s"), (None, "a", "x"), (1, None, "y")]
    got, rows = _linked(spark, calls, results)
    a = got[1, "a", "call"]
    assert a.linked and a.valid and a.depth == 0 and a.errors == ""
    assert a.json == '{"arguments":{"a":1,"b":2.5},"id":"a","name":"add","parent":null,"result":"said \\"hi\\"\\n","type":"call"}'
    b = got[1, "b", "call"]
    assert (b.depth, b.linked, b.valid, b.errors) == (1, False, False, "missing:b,type:a,unknown:x")
    assert (got[1, "c", "call"].depth, got[1, "d", "call"].depth) == (2, 0) and got[1, "d", "call"].valid
    assert all(got[2, k, "call"].depth is None and got[2, k, "call"].errors == "circle" for k in "abc")
    assert [got[3, k, "call"].errors for k in "abcd"] == ["tool", "arguments", "arguments", "arguments"]
    assert got[4, "a", "call"].errors == "repeated result" and got[4, "b", "call"].errors == "repeated call,unknown:z"
    assert got[1, "zz", "result"].linked is False and got[1, "zz", "result"].valid is None
    assert sum(r.errors == "no identifier" for r in rows) == 4
    for r in rows:
        assert json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json


def test_long_chains_are_ordered_in_few_joins(spark):
    calls = [(1, f"c{i}", f"c{i - 1}" if i else None, "now", "{}") for i in range(200)]
    df = spark.createDataFrame(calls, "conv_id long, call_id string, parent_id string, name string, arguments string")
    assert {r.call_id: r.depth for r in T.depths(df).collect()} == {f"c{i}": i for i in range(200)}


def test_empty_tables(spark):
    assert _linked(spark, [], [])[1] == []
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    calls, results = T.turns_as_calls(turns)
    assert calls.count() == 0 and results.count() == 0
