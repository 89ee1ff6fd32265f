import json

import pytest

from helpers_llm import MEDIUM, table
from ohlcflow.llm import chat_format as cf

TOOLS = {
    "search": {
        "type": "object",
        "properties": {
            "q": {"type": "string", "minLength": 1}, "k": {"type": "integer", "minimum": 1, "maximum": 10},
            "kind": {"enum": ["web", "news"]}, "tags": {"type": "array", "items": {"type": "string"}},
        },
        "required": ["q"],
        "additionalProperties": False,
    }
}


def call(ident, args, name="search"):
    return json.dumps({"tool_call": {"id": ident, "name": name, "arguments": args}})


def result(ident, content):
    return json.dumps({"tool_result": {"id": ident, "content": content}})


def link(spark, rows, tools=TOOLS):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, id string, kind string")
    return cf.link_tool_calls(df, tools).collect()


def msg(conv, turn, text, role="assistant"):
    return (conv, turn, role, text, "clash", "clash")


def test_links_orders_and_checks(spark):
    rows = [
        msg(1, 0, "hello", "user"),
        msg(1, 1, call("c", {"q": {"$result": "b"}})),
        msg(1, 2, call("a", {"q": "x", "k": 3.0})),
        msg(1, 3, call("b", {"q": "y", "tags": [{"$result": "a"}]})),
        msg(1, 4, result("a", {"z": 1, "b": [True, None]})),
        msg(1, 5, result("b", "two")),
        msg(1, 6, result("c", 3)),
        msg(2, 1, call("a", {"q": "other"})),
    ]
    got = {(r["conv_id"], r["id"]): r for r in link(spark, rows)}
    assert {k: (r["status"], r["level"], r["valid"]) for k, r in got.items()} == {
        (1, "a"): ("linked", 0, True), (1, "b"): ("linked", 1, True), (1, "c"): ("linked", 2, True),
        (2, "a"): ("unanswered", 0, True),
    }
    assert got[1, "a"]["json"] == (
        '{"arguments":{"k":3,"q":"x"},"id":"a","name":"search","result":{"b":[true,null],"z":1}}'
    )
    assert all(json.loads(r["json"]) for r in got.values())


def test_bad_messages(spark):
    rows = [
        msg(1, 0, call("a", {"q": ""})), msg(1, 1, call("b", {"k": 11, "z": 1})), msg(1, 2, call("c", {"q": 5})),
        msg(1, 3, call("d", {"q": "x", "kind": "tv", "tags": [1]})), msg(1, 4, call("e", {}, "nope")),
        msg(1, 5, call("f", {"q": {"$result": "g"}})), msg(1, 6, call("g", {"q": {"$result": "f"}})),
        msg(1, 7, call("h", {"q": {"$result": "f"}})), msg(1, 8, call("i", {"q": {"$result": "gone"}})),
        msg(1, 9, result("j", 1)), msg(1, 10, call("j", {"q": "x"})), msg(1, 11, result("k", 1)),
        msg(1, 12, call("a", {"q": "again"})), msg(1, 13, '{"tool_call": {"name": "search"}}'),
        msg(1, 14, '{"tool_result": {}}'), msg(1, 15, '{"tool_call": "x"}'), msg(1, 16, '{"tool_call": '),
        msg(1, 17, None), msg(1, 18, ""), msg(None, 0, call("n", {"q": "x"})), msg(None, 1, result("n", 0)),
        msg(1, None, call("o", {"q": "x"})), msg(1, 19, result("o", 0)),
    ]
    got = {}
    for r in link(spark, rows):
        got.setdefault((r["conv_id"], r["id"]), []).append((r["status"], r["valid"], r["errors"]))
    assert sorted(got[1, "a"]) == [("duplicate", False, []), ("unanswered", False, ["$.q: length"])]
    assert got[1, "b"] == [("unanswered", False, ["$.q: missing", "$.k: out of range", "$.z: unknown"])]
    assert got[1, "c"] == [("unanswered", False, ["$.q: not string"])]
    assert got[1, "d"] == [("unanswered", False, ["$.kind: not one of the values", "$.tags[0]: not string"])]
    assert got[1, "e"] == [("unanswered", False, ["unknown tool"])]
    assert [got[1, x][0][0] for x in "fgh"] == ["cyclic"] * 3
    assert got[1, "i"][0][0] == "dangling" and got[1, "j"][0][0] == "early" and got[1, "k"][0][0] == "orphan"
    assert [s for s, _, _ in got[1, None]] == ["malformed"] * 2
    assert got[None, "n"][0][0] == "linked" and got[1, "o"][0][0] == "linked"


def test_empty_table(spark):
    assert link(spark, []) == []


def test_deep_chain(spark):
    rows = [msg(1, i, call(str(i), {"q": {"$result": str(i - 1)} if i else "x"})) for i in range(6)]
    assert sorted((int(r["id"]), r["level"]) for r in link(spark, rows)) == [(i, i) for i in range(6)]


@pytest.mark.parametrize(
    "value, text",
    [
        ({"b": 1.0, "a": [1.5, 2.0]}, '{"a":[1.5,2],"b":1}'), ("é\n", '"é\\n"'), (float("inf"), "null"),
        ({"x": {"z": None, "y": True}}, '{"x":{"y":true,"z":null}}'),
    ],
)
def test_canonical_json(value, text):
    assert cf.canonical_json(value) == text
    if value != float("inf"):
        assert cf.canonical_json(json.loads(text)) == text


def test_conversations(spark):
    """Every user turn is a call; it is answered if the next turn is the assistant's."""
    turns = {(r["conv_id"], r["turn"]): r for r in table(spark, "conversations", MEDIUM).collect()}
    out = cf.link_tool_calls(
        cf.as_tool_messages(table(spark, "conversations", MEDIUM)), {"answer": cf.ANSWER_TOOL}
    ).collect()
    calls = {(r["conv_id"], r["turn"]): r for r in out if r["status"] in ("linked", "unanswered")}
    assert set(calls) == {k for k, r in turns.items() if r["role"] == "user"}
    for (c, t), r in calls.items():
        answer = turns.get((c, t + 1))
        answered = answer is not None and answer["role"] == "assistant"
        assert (r["status"] == "linked") == answered
        body = json.loads(r["json"])
        assert body["arguments"]["question"] == turns[c, t]["text"]
        assert body["result"] == (answer["text"] if answered else None)
        assert r["valid"] == (1 <= body["arguments"]["words"] <= 100)
        assert r["level"] == (t // 2).bit_length()


def test_no_message_ends_the_job(spark):
    """Integers of any length, deep nesting and half surrogate pairs: every call stays."""
    long = "7" * 5000
    deep = '{"tool_call":{"id":"deep","name":"search","arguments":{"q":' + "[" * 100_000 + "]" * 100_000 + "}}}"
    rows = [
        msg(1, 0, '{"tool_call":{"id":"long","name":"search","arguments":{"q":"x","k":%s}}}' % long),
        msg(1, 1, deep), msg(1, 2, "[" * 100_000 + '"tool_call"'),
        msg(1, 3, '{"tool_call":{"id":"s\\ud800","name":"search","arguments":{"q":"\\udc00 \\ud83d\\ude00"}}}'),
        msg(1, 4, '{"tool_result":{"id":"s\\ud800","content":"\\ud800"}}'),
        msg(1, 5, '{"tool_call":{"id":"big","name":"search","arguments":{"q":"x","k":1e999999999999}}}'),
        msg(1, 6, '{"tool_call":{"id":"one","name":"search","arguments":{"q":"x","k":10e-1}}}'),
        msg(1, 7, '{"tool_call":{"id":"x\\ud800","name":"n\\ud800","arguments":{"\\ud800":1}}}'),
    ]
    got = {r["id"]: r for r in link(spark, rows)}
    assert len(got) == 6
    assert got["long"]["errors"] == ["$.k: out of range"] and ("7." + "7" * 4999 + "e+4999") in got["long"]["json"]
    assert got[None]["status"] == "malformed" and got[None]["errors"] == ["nested too deep"]
    assert json.loads(got[None]["json"]) == deep
    s = got["s\\ud800"]
    assert s["status"] == "linked" and s["json"].endswith('"result":"\\ud800"}') and "😀" in s["json"]
    assert got["big"]["errors"] == ["$.k: out of range"] and got["one"]["valid"]
    assert got["x\\ud800"]["errors"] == ["unknown tool"]


@pytest.mark.parametrize(
    "texts",
    [
        ["10000000000000000", "1e16", "1E+16", "1.0e16", "10000000000000000.0"], ["0", "-0", "0.0", "0e5"],
        ["-1.5", "-15e-1", "-1.50"], ["1e400", "10e399"], ["0.1", "1e-1", "0.10"], ["9007199254740993", "9007199254740993.0"],
    ],
)
def test_equal_numbers_have_one_text(texts):
    assert len({cf.canonical_json(cf.read_json(t)) for t in texts}) == 1


def test_numbers_compare_exactly():
    import random
    from decimal import Decimal

    rng = random.Random(2)

    def token():
        kind = rng.randrange(4)
        if kind == 0:
            return str(rng.randint(-50, 50))
        if kind == 1:
            return f"{rng.randint(-9, 9)}.{rng.randint(0, 99)}"
        return f"{rng.randint(1, 9)}e{rng.randint(-3, 3)}" if kind == 2 else str(rng.randint(-(10**25), 10**25))

    for _ in range(3000):
        a, b = token(), token()
        bound = int(Decimal(b)) if Decimal(b) == int(Decimal(b)) else float(b)
        exact = Decimal(a).compare(Decimal(bound))
        assert cf.Number(a).compare(bound) == exact
        assert Decimal(cf.Number(a).text) == Decimal(a)
        assert (cf.Number(a).text == cf.Number(b).text) == (Decimal(a) == Decimal(b))
    assert cf.Number("9007199254740993").compare(9007199254740992) == 1


def brute(messages):
    """(conv, id) -> (status, level) by plain recursion over each conversation."""
    calls, results = {}, {}
    for conv, turn, text in messages:
        value = json.loads(text)
        if "tool_call" in value:
            c = value["tool_call"]
            calls.setdefault((conv, c["id"]), []).append((turn, cf.canonical_json(cf.read_json(json.dumps(c["arguments"]))), c["arguments"]))
        else:
            results.setdefault((conv, value["tool_result"]["id"]), []).append(turn)
    first = {k: min(v, key=lambda x: x[:2]) for k, v in calls.items()}

    def refs(value):
        if isinstance(value, dict):
            return {value["$result"]} if set(value) == {"$result"} else set().union(*map(refs, value.values()), set())
        return set().union(*map(refs, value), set()) if isinstance(value, list) else set()

    level = {}
    deps = {k: {(k[0], r) for r in refs(v[2])} for k, v in first.items()}
    while True:
        ready = {k for k in deps if k not in level and all(d in level for d in deps[k])}
        if not ready:
            break
        level.update({k: max((level[d] + 1 for d in deps[k]), default=0) for k in ready})
    out = {}
    for k, (turn, _, _) in first.items():
        if any(d not in first for d in deps[k]):
            status = "dangling"
        elif k not in level:
            status = "cyclic"
        elif k not in results:
            status = "unanswered"
        else:
            status = "early" if min(results[k]) < turn else "linked"
        out[k] = (status, level.get(k))
    spare = sum(len(v) - 1 for v in [*calls.values(), *results.values()])
    return out, spare, {k for k in results if k not in calls}


@pytest.mark.parametrize("seed", range(4))
def test_random_conversations(spark, seed):
    """Graphs with cycles, unknown and repeated identifiers, results before their calls."""
    import random

    rng = random.Random(seed)
    messages = []
    for conv in range(25):
        ids = [f"c{i}" for i in range(rng.randint(1, 9))]
        for turn in range(rng.randint(1, 18)):
            if rng.random() < 0.6:
                some = [{"$result": rng.choice(ids + ["gone"] * (rng.random() < 0.1))} for _ in range(rng.choice([0, 0, 1, 1, 2]))]
                messages.append((conv, turn, call(rng.choice(ids), {"q": "x", "tags": some, "k": turn % 3 + 1})))
            else:
                messages.append((conv, turn, result(rng.choice(ids), turn)))
    rng.shuffle(messages)
    want, spare, orphans = brute(messages)
    got = link(spark, [msg(*m) for m in messages])
    named = {(r["conv_id"], r["id"]): (r["status"], r["level"]) for r in got if r["status"] not in ("duplicate", "orphan")}
    assert named == want
    assert sum(r["status"] == "duplicate" for r in got) == spare
    assert {(r["conv_id"], r["id"]) for r in got if r["status"] == "orphan"} == orphans
