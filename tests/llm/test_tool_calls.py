from __future__ import annotations

import json
import random

from spanvec.llm import conversation_tools, tool_calls
from spanvec.llm.tool_calls import Param

CALLS = "conv_id bigint, call_id string, turn bigint, name string, arguments string"
RESULTS = "conv_id bigint, call_id string, turn bigint, content string"
SCHEMAS = {"f": {"a": Param("integer", least=0, most=9), "b": Param("string", required=False, most=3), "c": Param("array", required=False)}, "g": {}}


def formatted(spark, calls, results):
    out = tool_calls.format_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS)
    return {(r.conv_id, r.call_id): r for r in out.collect()}


def test_validation_and_canonical_json(spark):
    cases = [
        ('{"b": "xyz",\n "a": 1}', None), ('{"a": 12}', "a: above 9"), ('{"a": -1}', "a: below 0"), ('{"a": "1"}', "a: not of type integer"),
        ('{"a": 1.5}', "a: not of type integer"), ('{"b": "x"}', "a: missing"), ('{"a": null}', "a: missing"), ('{"a": 1, "b": "long text"}', "b: above 3"),
        ('{"a": 1, "z": 1}', "z: no such parameter"), ("[1]", "arguments: not a JSON object"), ("{", "arguments: not a JSON object"),
        ("", "arguments: not a JSON object"), (None, "arguments: not a JSON object"), ('{"c": [3, {"y": 1, "x": "é\\"\\n"}], "a": 1}', None), ("{}", "a: missing"),
    ]
    rows = formatted(spark, [(1, f"k{i}", i, "f", text) for i, (text, _) in enumerate(cases)], [])
    for i, (text, error) in enumerate(cases):
        r = rows[1, f"k{i}"]
        assert r.error == error, text
        try:
            parsed = json.loads(text)
        except (TypeError, ValueError):
            parsed = None
        want = {"id": f"k{i}", "name": "f"} | ({"arguments": parsed} if isinstance(parsed, dict) else {})
        assert r.call_json == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert formatted(spark, [(1, "x", 0, "h", "{}"), (1, "y", 0, None, "{}"), (1, "z", 0, "g", "{}")], [])[1, "x"].error == "name: no such tool"


def test_links_orphans_and_repeats(spark):
    calls = [(1, "a", 0, "g", "{}"), (1, "b", 2, "g", "{}"), (1, "c", 4, "g", "{}"), (1, "c", 3, "f", '{"a":1}'), (None, "a", 0, "g", "{}"), (1, None, 0, "g", "{}"), (2, "a", 0, "g", "{}")]
    results = [(1, "a", 1, "one"), (1, "c", 5, "x"), (1, "c", 5, None), (1, "d", 7, "alone"), (1, None, 8, "y"), (2, "a", 1, None)]
    rows = formatted(spark, calls, results)
    assert {k: r.status for k, r in rows.items() if None not in k} == {
        (1, "a"): "linked", (1, "b"): "call without result", (1, "c"): "repeated identifier", (1, "d"): "result without call", (2, "a"): "linked",
    }
    assert rows[1, "c"].n_calls == 2 and rows[1, "c"].n_results == 2 and json.loads(rows[1, "c"].call_json)["name"] == "f"
    assert rows[1, "a"].result_json == '{"content":"one","tool_call_id":"a"}' and rows[2, "a"].result_json == '{"tool_call_id":"a"}'
    assert {r.status for k, r in rows.items() if None in k} == {"no identifier"}


def test_levels_against_longest_paths(spark):
    rng = random.Random(6)
    calls, needs = [], {}
    for conv in range(4):
        for i in range(25):
            of = rng.sample(range(i), min(i, rng.randrange(3)))
            needs[conv, f"n{i}"] = {f"n{j}" for j in of}
            unknown = ["$result:nowhere"] * (i % 7 == 0)
            calls.append((conv, f"n{i}", i, "f", json.dumps({"a": 1, "c": [f"$result:n{j}" for j in of] + unknown})))
    calls += [(9, "p", 0, "f", '{"c":["$result:q"]}'), (9, "q", 0, "f", '{"c":["$result:p"]}'), (9, "r", 0, "f", '{"c":["$result:q"]}'), (9, "s", 0, "f", '{"c":["$result:s"]}'), (9, "t", 0, "f", "{}")]

    def level(key):
        return max((level((key[0], n)) + 1 for n in needs[key]), default=0)

    rows = formatted(spark, calls, [])
    assert {k: r.level for k, r in rows.items() if k[0] != 9} == {k: level(k) for k in needs}
    assert {k[1]: r.level for k, r in rows.items() if k[0] == 9} == {"p": None, "q": None, "r": None, "s": None, "t": 0}
    assert all(r.n_unknown_needs == (int(k[1][1:]) % 7 == 0) for k, r in rows.items() if k[0] != 9)


def test_odd_turns(spark):
    turns = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, "user", "x" * 100_000), (1, 2, "user", "x" * 100_000), (None, 0, "user", "a"), (2, None, "user", "b"), (2, 3, None, "c"), (3, 1, "assistant", "é\n\"")]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    for f in (frame, frame.selectExpr("*", "1 as call_id", "2 as name", "3 as level", "4 as status")):
        out = tool_calls.format_calls(*conversation_tools.calls_and_results(f), conversation_tools.SCHEMAS)
        rows = {(r.conv_id, r.call_id): r for r in out.collect()}
        assert rows[1, "c1-0"].status == "linked" and rows[1, "c1-2"].n_calls == 2 and rows[1, "c1-2"].level == 1
        assert rows[3, "c3-0"].result_json == '{"content":"é\\n\\"","tool_call_id":"c3-0"}'
        assert len(rows) == 5 and "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert tool_calls.format_calls(*conversation_tools.calls_and_results(frame.limit(0)), conversation_tools.SCHEMAS).count() == 0
