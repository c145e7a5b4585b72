import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from voltaflow.llm import queries, trie

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """From the contract: all beginnings of all rebuilt conversations."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in by.items()}
    base = {c: c - (abs(c) % 20) * (1 if c >= 0 else -1) for c in own}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    made = {c: tuple(own.get(base[c], [])[:h[c]] + own[c][h[c]:]) for c in own}
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    words = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in members}
    leaves, saved, out = {}, {}, set()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * words[p] + sum(saved[k] for k in kids[p])
        ends = ",".join(map(str, sorted(c for c in members[p] if len(made[c]) == len(p))))
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    assert len(out) == len(members)
    return out


def nodes(df):
    got = [tuple(r) for r in trie.nodes(trie.rebuilt(trie.turns(df))).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_trie(spark, SF).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("parts", [1, 3, 17])
def test_random_tries_over_any_number_of_partitions(spark, frame, seed, parts):
    """Few texts, so that nodes, copies and ends lie across the boundaries; null and repeated turns."""
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-60, 300), 150):
        for t in range(rnd.choice([1, 1, 2, 3, 4, 9])):
            rows.append((c, rnd.choice([t, t, t, None]), rnd.choice(["user", None, ""]) if rnd.random() < 0.2 else "u",
                         rnd.choice(["a", "a", "a b\x0bc", "", None])))
    rows += [(c, t, "user", "same words here") for c in range(1000, 1200) for t in range(6)]  # a hot conversation
    rows += [(None, 0, "user", "nobody")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert nodes(frame(rows, SCHEMA)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_long_conversation_empty_table_and_clashing_columns(frame):
    rows = [(c, t, "user", f"w {t // 150} " * 30) for c in (1, 2) for t in range(300)] + [(1, t, "x", "tail") for t in range(300, 320)]
    df = frame([(*r, "k", 3) for r in rows], SCHEMA + ", key string, words int")
    assert nodes(df) == brute(rows)
    assert nodes(frame([], SCHEMA)) == set()
    assert nodes(frame([(None, 1, "u", "x")], SCHEMA)) == set()
    one = [(5, None, None, None)]
    assert nodes(frame(one, SCHEMA)) == brute(one)


def test_contracted_blocks_lose_no_node():
    """Union-find over blocks of any cut equals union-find over all neighbours."""
    rnd = random.Random(4)
    for _ in range(300):
        seqs = sorted(tuple(rnd.choice("ab") for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(1, 25)))
        key = [b"".join(c.encode() * trie.TOKEN for c in s) for s in seqs]
        edges = [trie.lcp(a, b) for a, b in zip(key, key[1:])]
        row = [trie.Block(1, k, 0, int(e < len(s)), len(s), list(range(len(s) + 1))) for k, (s, e) in enumerate(zip(seqs, [*edges, -1]))]

        def seen(found):
            return {(n.least, d, n.convs, n.leaves, n.edge_words, n.children if d == n.depth else 1)
                    for n in found for d in range(n.depth, n.low, -1)}
        want = seen(trie.forest(row, edges, -1, -1, -1))
        cuts = sorted(rnd.sample(range(1, len(row)), min(len(row) - 1, rnd.randint(0, 4))))
        got, blocks, seams = set(), [], []
        for pid, (a, z) in enumerate(zip([0, *cuts], [*cuts, len(row)])):
            before, after = (edges[a - 1] if a else -1), (edges[z - 1] if z < len(row) else -1)
            made, spans, inner = trie.contract(row[a:z], edges[a:z - 1], before, after, pid)
            seams += ([before] if a else []) + inner
            blocks += made
            for b, (x, y) in zip(made, spans):
                x, y = x + a, y + a
                got |= seen(trie.forest(row[x:y], edges[x:y - 1], edges[x - 1] if x else -1, edges[y - 1] if y < len(row) else -1, b.open))
        if len(blocks) > 1:
            got |= seen(trie.forest(blocks, seams, -1, -1, -1))
        assert got == want
