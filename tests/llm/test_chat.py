import json
import re

import pytest

from tests.llm.conftest import SF
from voltaflow.llm import chat, queries

SCHEMA = "conv_id long, seq long, kind string, call_id string, name string, payload string, after array<string>, level string"
TOOLS = {"add": {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {
    "a": {"type": "number", "minimum": 0, "maximum": 9}, "b": {"type": "array", "items": {"type": "string"}, "maxItems": 2},
    "c": {"enum": ["x", None]}}}}


@pytest.mark.parametrize(("value", "ok"), [
    ({"a": 1}, True), ({"a": 1.5, "b": ["x"], "c": None}, True), ({}, False), ({"a": "1"}, False), ({"a": True}, False),
    ({"a": 10}, False), ({"a": 1, "b": [1]}, False), ({"a": 1, "b": ["x"] * 3}, False), ({"a": 1, "c": "y"}, False),
    ({"a": 1, "d": 1}, False), ([], False), (None, False)])
def test_schema(value, ok):
    assert (chat.problem(value, TOOLS["add"]) is None) == ok


def test_canonical_json():
    assert chat.canonical({"b": [1.0, 2.5, None], "a": {"é": "\n\"", "Z": True}, "€": 1e30}) == (
        '{"a":{"Z":true,"é":"\\n\\""},"b":[1,2.5,null],"€":1e+30}')
    for bad in ('{"a":1,"a":2}', '{"a":NaN}', "{", "", None, "[" * 100_000):
        assert chat.message("call", "i", "add", bad, TOOLS)[1].startswith("not JSON")


def rows():
    call = lambda c, s, i, p='{"a": 1}', after=None, name="add": (c, s, "call", i, name, p, after, "x")
    result = lambda c, s, i: (c, s, "result", i, None, "out", None, "x")
    return [
        call(1, 0, "a"), result(1, 1, "a"), result(1, 2, "a"), call(1, 3, "b", after=["a", "a"]), result(1, 4, "b"),
        call(1, 5, "c", after=["b", "a"]), call(1, 6, "d", '{"a": 99}', ["c"]), result(1, 7, "d"), call(1, 8, "a"),
        call(2, 0, "a", after=["b"]), call(2, 1, "b", after=["a"]), call(2, 2, "z", after=["b"]), call(2, 3, "s", after=["s"]),
        call(3, 5, "late"), result(3, 4, "late"), result(3, 9, "nobody"), call(3, 6, "m", after=["gone"]), result(3, 7, "m"),
        call(3, 8, "u", name="other"), call(3, 8, None), call(None, 8, "n"), result(3, 8, None), (3, 0, "system", None, None, "hi", None, "x"),
        (None, None, None, None, None, None, None, None), call(4, 0, "r"), call(4, 0, "r"), result(4, 1, "r"), call(5, None, "q"),
        (5, 3, "call", "p", "add", None, None, "x"),
    ]


WANT = {
    (1, 0): (0, "ok"), (1, 1): (0, "ok"), (1, 2): (0, "extra_result"), (1, 3): (1, "ok"), (1, 4): (1, "ok"),
    (1, 5): (2, "unanswered"), (1, 6): (3, "invalid"), (1, 7): (3, "ok"), (1, 8): (0, "duplicate_call"),
    (2, 0): (None, "cycle"), (2, 1): (None, "cycle"), (2, 2): (None, "cycle"), (2, 3): (None, "cycle"),
    (3, 5): (0, "unanswered"), (3, 4): (0, "before_call"), (3, 9): (None, "orphan"), (3, 6): (0, "missing_dependency"),
    (3, 7): (0, "ok"), (3, 0): (None, "plain"), (None, 8): (None, "no_id"), (None, None): (None, "plain"),
    (4, 0): (0, "ok"), (4, 1): (0, "ok"), (5, None): (0, "unanswered"), (5, 3): (0, "invalid"),
}


def test_links_levels_and_status(frame):
    got = chat.link(frame(rows(), SCHEMA), TOOLS).collect()
    assert len(got) == len(rows())
    for r in got:
        if (r.conv_id, r.seq) == (3, 8):
            assert r.status == ("no_id" if r.call_id is None else "invalid")
        else:
            assert (r.level, r.status) == WANT[r.conv_id, r.seq], r
        json.loads(r.message)


def test_empty(frame):
    assert chat.link(frame([], SCHEMA), TOOLS).count() == 0
    assert chat.link(chat.from_turns(frame([], "conv_id long, turn long, role string, text string")), TOOLS).count() == 0


def test_query_against_brute_force(spark):
    turns = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}
    users = {k for k, r in turns.items() if r.role == "user"}

    def level(c, t):
        return level(c, t // 2) + 1 if t > 0 and t // 2 < t and (c, t // 2) in users else 0

    def dumps(x):
        return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    want = []
    for (c, t), r in turns.items():
        if r.role == "user":
            n = len([w for w in re.split(r"[ \t\n\x0b\f\r]+", r.text) if w])
            ok = n >= (3 if t else 1)
            answered = (c, t + 1) in turns and turns[c, t + 1].role == "assistant"
            args = dumps({"text": r.text, "words": n, "turn": t})
            text = dumps({"role": "assistant", "tool_calls": [{"id": f"call-{t}", "type": "function", "function": {
                "name": "follow_up" if t else "ask", "arguments": args}}]})
            want.append((c, t, "call", f"call-{t}", level(c, t), "invalid" if not ok else "ok" if answered else "unanswered", text))
        elif r.role == "assistant":
            linked = (c, t - 1) in users
            want.append((c, t, "result", f"call-{t - 1}", level(c, t - 1) if linked else None, "ok" if linked else "orphan",
                         dumps({"role": "tool", "tool_call_id": f"call-{t - 1}", "content": r.text})))
        else:
            want.append((c, t, r.role, None, None, "plain", dumps({"role": r.role, "content": r.text})))
    got = queries.op7_chat(spark, SF).drop("error").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def plain_levels(calls):
    deps = {c: {d for d in after or () if (c[0], d) in calls} for c, after in calls.items()}
    out, todo = {}, dict(deps)
    while True:
        free = [c for c, ds in todo.items() if all((c[0], d) in out for d in ds)]
        if not free:
            return out
        for c in free:
            out[c] = 1 + max((out[c[0], d] for d in todo.pop(c)), default=-1)


def test_levels_of_random_dependencies(frame):
    import random
    rnd = random.Random(8)
    calls = {}
    for conv in range(6):
        for k in range(40):
            n = rnd.choice([0, 1, 1, 1, 1, 2, 3])
            others = [f"c{rnd.randrange(max(k, 1))}" if rnd.random() < (0.97 if conv else 0.6) else f"c{rnd.randrange(45)}" for _ in range(n)]
            calls[conv, f"c{k}"] = others
    df = frame([(c, i, a) for (c, i), a in calls.items()], "conv_id long, call_id string, after array<string>")
    got = {(r.conv_id, r.call_id): r.level for r in chat.levels(df).collect()}
    assert got == plain_levels(calls)


def test_a_long_chain_takes_few_rounds(frame, monkeypatch):
    n = 600
    rows = [(1, f"c{k}", [f"c{k - 1}"] if k else None) for k in range(n)] + [(2, "a", ["b"]), (2, "b", ["a"]), (2, "d", ["a", "b"]), (2, "e", ["zz"])]
    df = frame(rows, "conv_id long, call_id string, after array<string>")
    cuts, real = [], chat.cut
    monkeypatch.setattr(chat, "cut", lambda d: cuts.append(1) or real(d))
    got = {(r.conv_id, r.call_id): r.level for r in chat.levels(df).collect()}
    assert got == {(1, f"c{k}"): k for k in range(n)} | {(2, "e"): 0}
    assert len(cuts) < 30


def test_odd_turns_and_a_very_long_text(frame):
    rows = [(1, 0, "user", "w " * 200_000), (1, 1, "assistant", None), (1, 2, "user", None), (1, 2, "user", None), (1, -3, "user", "x"),
            (1, None, "user", "y"), (None, 1, "user", "z"), (2, None, None, None)]
    df = frame([(*r, "a", 1) for r in rows], "conv_id long, turn long, role string, text string, after string, level int")
    got = chat.link(chat.from_turns(df), chat.TOOLS).collect()
    assert len(got) == len(rows)
    assert {r.kind for r in got} == {"call", "result", None} and all(r.status for r in got)
    assert max(len(r.message or "") for r in got) > 400_000
