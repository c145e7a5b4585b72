import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from voltaflow.llm import queries, repair

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = defaultdict(list)
    for c, t, r, x in rows:
        out[c]
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if k == 0:
            continue
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        out[c] += [(t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    return {c: sorted(v, key=lambda q: (q[0] is not None, q[0] or 0, q[1], q[2])) for c, v in out.items()}


def cheapest(rows, faults):
    """Uniform-cost search over (cost, edits, roles): the first accepted path is the cheapest, then the ASCII-least."""
    n, heap, seen = len(rows), [(0, "", 0, "", ())], set()
    while True:
        cost, audit, k, roles, made = heapq.heappop(heap)
        if k == n and LEGAL.fullmatch(roles):
            return cost, audit, made
        # what can follow depends on the last role alone (after s nothing but u has been added)
        if (k, roles[-1:], len(roles) == 0) in seen:
            continue
        seen.add((k, roles[-1:], len(roles) == 0))
        nexts = [("I", r, "", 2) for r in ("user", "assistant")]
        if k < n:
            _, role, text = rows[k]
            heapq.heappush(heap, (cost + 3, audit + "D", k + 1, roles, made))
            if faults[k] not in ("blank", "duplicate"):
                more = faults[k] == "truncated"
                nexts += [("K", role, text, more)] + [("R", r, text, 2 + more) for r in ("user", "assistant")]
        for edit, r, x, extra in nexts:
            new = roles + (r[:1] or "?")
            if re.fullmatch(r"(s?(ua)*u?)?", new):
                heapq.heappush(heap, (cost + extra, audit + edit, k + (edit != "I"), new, (*made, f"{r}:{x}")))


def brute(conversations):
    out = set()
    for c, rows in damaged(conversations).items():
        faults, seen = [], set()
        for _, r, x in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", x)
            faults.append("blank" if not solid else "duplicate" if (r, x) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((r, x))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, made = cheapest(rows, faults)
        out.add((c, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                 hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return out


def summed(df):
    got = [tuple(r) for r in repair.summary(repair.damage(df)).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_repair(spark, SF).collect()
    assert len(got) == len({r[0] for r in rows})
    assert set(map(tuple, got)) == brute(rows)


def noise(seed, convs=60, longest=14):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(convs), None]:
        for t in range(rnd.randint(1, longest)):
            rows.append((c, rnd.choice([t, t, t * 2, None]), rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
                         rnd.choice(["Yes.", "No!", "Why?", "cut", "a. b", "", " \x0b\n", None, f"Turn {t}.", f"Turn {t}.  \n", f"open {t}"])))
    return rows


@pytest.mark.parametrize("seed,parts", [(0, 1), (1, 7), (2, 40)])
def test_random_conversations(spark, frame, seed, parts):
    rows = noise(seed)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert summed(frame(rows, SCHEMA)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_conversation_over_many_partitions(spark, frame):
    rnd = random.Random(5)
    rows = [(7, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Fine.", f"Turn {t}.", f"open {t}", f"{t}!"])) for t in range(1500)]
    rows += [(8, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(40)] + [(3, 1, "user", "x" * 200_000 + ".")]
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        df = frame(rows, SCHEMA)
        ranges = repair.Ranges(repair.damage(df))
        assert len(ranges.begin) > 10  # the long one lies in most partitions
        assert summed(df) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_blocks_and_ranges_give_the_search_of_the_whole():
    rnd = random.Random(2)
    for _ in range(60):
        codes = np.array([repair._code(rnd.choice([1, 2, 1, 2, 0, 3]), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(rnd.randint(0, 30))], np.int64)
        whole = repair.search(codes.tolist(), 0, [0] * 4, True)
        size, repair.BLOCK = repair.BLOCK, 4
        try:
            assert repair.solve(codes, 0, np.array(repair.END), True) == whole
            k = rnd.randint(0, len(codes))
            rest = repair.before(repair.matrix(codes[k:]), np.array(repair.END))
            a, q = repair.solve(codes[:k], 0, rest, False)
            b, end = repair.solve(codes[k:], q, np.array(repair.END), True)
        finally:
            repair.BLOCK = size
        assert (a + b, end) == whole
        assert rest is not None and end in repair.ACCEPT


def test_edits_and_copies(frame):
    df = frame([(1, 0, "user", "Hi.", "k", 9), (1, 1, "user", "Go on.", "k", 9), (2, 0, "assistant", "Oh.", "k", 9)],
               SCHEMA + ", edit string, part int")
    got = sorted(repair.repair(df).collect(), key=lambda r: (r.conv_id, r.part, r.n))
    assert [(r.conv_id, r.edit, r.role, r.text) for r in got] == [
        (1, "K", "user", "Hi."), (1, "R", "assistant", "Go on."), (2, "I", "user", ""), (2, "K", "assistant", "Oh.")]
    none = frame([(4, 0, "user", "Hi.", 0), (5, 1, "user", "Hi.", 3), (5, 2, "assistant", "Yes.", 1)], SCHEMA + ", copies long")
    assert sorted((r.conv_id, r.edit) for r in repair.repair(none).collect()) == [(4, ""), (5, "D"), (5, "D"), (5, "K"), (5, "K")]


def test_empty_table(frame):
    assert summed(frame([], SCHEMA)) == set()
