import json

from gristmill.llm import chat_tools
from tests.llm.helpers import frame

CALLS = "conv_id long, call_id string, position long, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, call_id string, position long, content string"
SCHEMAS = [
    ("add", "x", "integer", True), ("add", "y", "number", True), ("add", "note", "string", False), ("add", "opts", "object", False),
    ("add", "list", "array", False), ("add", "on", "boolean", False),
]


def linked(spark, calls, results, schemas=SCHEMAS):
    out = chat_tools.link_calls(
        frame(spark, calls, CALLS + ", status string").drop("none") if calls and len(calls[0]) == 7 else frame(spark, calls, CALLS),
        frame(spark, results, RESULTS), frame(spark, schemas, "name string, parameter string, type string, required boolean"),
    )
    return out.collect()


def test_statuses_and_canonical_json(spark):
    good = '{"y": 1.50, "x": 2, "opts": {"b": 1, "a": [true, null]}}'
    calls = [
        (1, "a", 0, "add", good, None), (1, "b", 1, "add", '{"x": "2", "z": 1}', []), (1, "c", 2, "add", "no json", []),
        (1, "d", 3, "gone", "{}", []), (1, "e", 4, "add", good, ["a", "nowhere"]), (1, "f", 5, "add", good, ["a"]),
        (2, "a", 0, "add", None, []), (2, "g", 1, "add", '{"x":1,"y":2,"list":[1],"on":true,"note":"é\\"\\n"}', []), (2, "g", 9, "add", "{}", []),
        (1, None, 6, "add", good, []), (None, "a", 6, "add", good, []), (1, "h", 7, "add", "[1]", []),
    ]
    results = [(1, "a", 1, "3.5"), (1, "a", 9, "late"), (1, "b", 2, ""), (2, "g", 3, None), (1, "orphan", 4, "x"), (None, "a", 5, "y"), (1, "f", 1, "é")]
    got = {(r["conv_id"], r["call_id"], r["order_position"]): r for r in linked(spark, calls, results)}
    status = {k: r["status"] for k, r in got.items()}
    assert status == {
        (1, "a", 0): "ok", (1, "b", 1): "invalid", (1, "c", 2): "invalid", (1, "d", 3): "unknown_tool", (1, "e", 4): "unknown_dependency",
        (1, "f", 5): "ok", (2, "a", 0): "invalid", (2, "g", 1): "ok", (1, None, 6): "no_id", (None, "a", 6): "no_id", (1, "h", 7): "invalid",
        (1, "orphan", 4): "no_call", (None, "a", 5): "no_id", (2, "g", 9): "repeated", (1, "a", 9): "repeated",
    }
    assert got[1, "a", 9]["message"] == '{"id":"a","result":"late"}' and got[1, "orphan", 4]["message"] == '{"id":"orphan","result":"x"}'
    assert got[2, "g", 9]["message"] == '{"arguments":{},"depends_on":[],"id":"g","name":"add"}' and got[2, "g", 9]["errors"] == []
    assert got[1, "a", 0]["message"] == '{"arguments":{"opts":{"a":[true,null],"b":1},"x":2,"y":1.5},"depends_on":[],"id":"a","name":"add","result":"3.5"}'
    assert got[1, "b", 1]["errors"] == ["missing y", "type of x", "unexpected z"]
    assert got[2, "a", 0]["errors"] == ["missing x", "missing y"]
    assert json.loads(got[2, "g", 1]["message"])["arguments"]["note"] == 'é"\n'
    assert all(json.loads(r["message"]) is not None for r in got.values())


def test_order_respects_dependencies(spark):
    calls = [
        (1, "a", 0, "add", "{}", ["c"]), (1, "b", 1, "add", "{}", ["a"]), (1, "c", 5, "add", "{}", []), (1, "d", 6, "add", "{}", ["b", "c"]),
        (1, "e", 2, "add", "{}", []), (2, "p", 0, "add", "{}", ["q"]), (2, "q", 1, "add", "{}", ["p"]), (2, "r", 2, "add", "{}", ["q"]),
        (2, "s", 3, "add", "{}", []), (3, "t", 0, "add", "{}", ["t"]),
    ]
    rows = linked(spark, calls, [])
    first = sorted((r for r in rows if r["conv_id"] == 1), key=lambda r: (r["order_position"], r["order_level"], r["call_id"]))
    assert [r["call_id"] for r in first] == ["e", "c", "a", "b", "d"]
    assert {r["call_id"] for r in rows if r["status"] == "cycle"} == {"p", "q", "r", "t"}


def test_long_chains_and_empty_tables(spark):
    chain = [(1, f"c{i:03}", i, "add", '{"x":1,"y":1}', [f"c{i - 1:03}"] if i else []) for i in range(300)]
    rows = linked(spark, chain, [])
    assert len(rows) == 300 and {r["order_level"] for r in rows} == {0} and {r["status"] for r in rows} == {"no_result"}
    assert linked(spark, [], []) == []
    assert linked(spark, [(1, "a", None, None, None, None)], [], [])[0]["status"] == "unknown_tool"


def test_no_python_in_the_plan(spark):
    out = chat_tools.link_calls(
        frame(spark, [(1, "a", 0, "add", "{}", [])], CALLS), frame(spark, [], RESULTS),
        frame(spark, SCHEMAS, "name string, parameter string, type string, required boolean"),
    )
    assert not any(word in out._jdf.queryExecution().executedPlan().toString() for word in ("Python", "Pandas", "ArrowEval"))
