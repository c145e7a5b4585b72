import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SF
from voltaflow.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    t = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (2 if k % 2 else 1)
        t += x - 9 if x > 9 else x
    return t % 10 == 0


def brute(text):
    out = []
    for n, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), n, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def base(text):
    return [s[:3] for s in pii.spans_of(text) if s[3]]


@given(st.text(alphabet="a1@.+- ()é4", max_size=60) | st.from_regex(PATTERNS["email"] + ".{0,5}" + PATTERNS["ip"])
       | st.from_regex(PATTERNS["phone"]) | st.from_regex(r"([0-9.]{1,5}@?[a-z-]{0,3}\.?){1,9}"))
@settings(max_examples=1500, deadline=None)
def test_base_spans_are_the_patterns(text):
    assert base(text) == brute(text)


def found(text):
    return [(k, text[a:b]) for k, a, b, own in pii.spans_of(text) if not own]


@pytest.mark.parametrize(("text", "want"), [
    ("write to jane.doe [at] example [dot] org now", [("email", "jane.doe [at] example [dot] org")]),
    ("é jane at example dot co dot uk.", [("email", "jane at example dot co dot uk")]),
    ("jane(at)example.com x", [("email", "jane(at)example.com")]),
    ("jаne@exаmple.com", [("email", "jаne@exаmple.com")]),  # Cyrillic a
    ("ab@exa​mple.com", [("email", "ab@exa​mple.com")]),
    ("ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", [("email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ")]),
    ("host 192 dot 168 dot 0 dot 12 up", [("ip", "192 dot 168 dot 0 dot 12")]),
    ("card ４１１１ 1111 1111 １１１１!", [("card", "４１１１ 1111 1111 １１１１")]),
    ("call plus one five five five oh one two three four five", [
        ("phone", "plus one five five five oh one two three four five")]),
    ("four one one one one one one one one one one one one one one one", [
        ("card", "four one one one one one one one one one one one one one one one")]),
    ("card four triple one double one double one double one double one double one double one", [
        ("card", "four triple one double one double one double one double one double one double one")]),
    ("look at this. the dot is near one or two trees at noon", []),
    ("Ed at eaha. Reat in the dot", []),
    ("plain a@b.co stays", []),
])
def test_added_spans(text, want):
    assert found(text) == want
    assert base(text) == brute(text)


@pytest.mark.parametrize(("text", "want"), [
    ("call plus 44 20 7946 0958 now", [("phone", "plus 44 20 7946 0958")]),
    ("PLUS double four two zero seven nine four six zero nine five eight", [
        ("phone", "PLUS double four two zero seven nine four six zero nine five eight")]),
    ("plus four, four, two, zero, seven, nine, four, six, zero, nine", [
        ("phone", "plus four, four, two, zero, seven, nine, four, six, zero, nine")]),
    ("card four, one, one, one, one, one, one, one, one, one, one, one, one, one, one, one.", [
        ("card", "four, one, one, one, one, one, one, one, one, one, one, one, one, one, one, one")]),
    ("four,one  one\tone-one one one one one one one one one one one one", [
        ("card", "four,one  one\tone-one one one one one one one one one one one one")]),
    ("double five triple five double five triple five double four double nine", [
        ("card", "double five triple five double five triple five double four double nine")]),
    ("one plus one, f\u0131ve, s\u0131x and 2 plus 2", []),
])
def test_plus_separators_and_leading_multiples(text, want):
    assert found(text) == want


@given(st.lists(st.sampled_from([
    "plus ", "Plus  ", "dot ", " dot ", " at ", "[at]", "(dot)", "{ . }", "<@>", "double ", "triple ", "one", "Two", "oh", "five ", ", ",
    " ", "-", "\t", "_", "44", "7", "a", "example", "com", "\u200b", "\u0131", "f\u0131ve", "\u0130", "\uff11", "é", "\u0301"]), max_size=14).map("".join))
@settings(max_examples=1500, deadline=None)
def test_skipping_the_check_for_disguises_changes_nothing(text):
    quick, held = pii.spans_of(text), pii._disguised
    pii._disguised = lambda _: True
    try:
        assert pii.spans_of(text) == quick
        full = pii._rewritten(text)
    finally:
        pii._disguised = held
    assert pii._rewritten(text) == full


def test_base_stays_beside_added():
    text = "a@b.co, c at d dot org, 10.0.0.1"
    assert [(k, text[a:b], own) for k, a, b, own in pii.spans_of(text)] == [
        ("email", "a@b.co", True), ("email", "c at d dot org", False), ("ip", "10.0.0.1", True)]
    assert pii.redacted(text, pii.spans_of(text)) == "[EMAIL], [EMAIL], [IP]"


@pytest.mark.parametrize("unit", ["a", "1", "1.", "@", "a@", "+1", "+1(", " ", "one ", "[", "é", "dot ", "1 ", "( at"])
def test_very_long_texts_take_linear_time(unit):
    began = time.time()
    pii.spans_of(unit * (400_000 // len(unit)))
    assert time.time() - began < 8


def expected(i, text):
    b = brute(text)
    n = {k: sum(x[0] == k for x in b) for k in PATTERNS}
    return (i, *n.values(), hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in b).encode()).hexdigest())


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries.op8_pii(spark, SF).collect()
    assert sorted(tuple(r)[:6] for r in got) == sorted(expected(d.doc_id, d.text) for d in docs)
    for r in got:
        assert r.spans is not None


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (1, "", None), (1, "", None), (None, "a@b.co", "b")]])
def test_nulls_repeats_clashing_names_and_empty_tables(frame, rows):
    got = queries.private_spans(frame(rows, "doc_id long, text string, found string")).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((expected(i, t) for i, t, _ in rows), key=key)
