import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from voltaflow.llm import simhash


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_labels(fps, d):
    lab = list(range(len(fps)))
    for _ in fps:
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= d:
                    lab[i] = lab[j] = min(lab[i], lab[j])
    return lab


@given(st.text(alphabet="aAbÄß \t\x0b\x85 .", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_is_the_definition(text):
    assert simhash.fingerprint_of(text) & (1 << 64) - 1 == brute_fp(text)


def test_gray_rank():
    k = np.arange(4096, dtype=np.uint64)
    assert (simhash.gray_rank(k ^ (k >> np.uint64(1))) == k).all()


def test_masks_cover_every_close_pair():
    rng = np.random.default_rng(1)
    masks = simhash.block_masks(4)
    for _ in range(500):
        diff = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))
        assert any(not diff & m for m in masks)


def test_forest_equals_brute_components():
    rng = np.random.default_rng(2)
    for size, spread in ((3, 2), (40, 3), (300, 4), (700, 9)):
        base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
        fps = base[rng.integers(0, 4, size)].copy()
        for _ in range(spread):
            fps ^= np.uint64(1) << rng.integers(0, 64, size, dtype=np.uint64)
        fps = np.unique(fps)
        gid = np.sort(rng.integers(0, 2, len(fps)))
        a, b = simhash.forest(fps, gid, 4)
        got = simhash.min_labels(len(fps), a, b)
        near = (np.bitwise_count(fps[:, None] ^ fps[None]) <= 4) & (gid[:, None] == gid[None])
        want = simhash.min_labels(len(fps), *np.nonzero(near))
        assert (got == want).all()
        assert len(a) < len(fps)


def test_operator_against_brute_force(spark, frame):
    rng = np.random.default_rng(3)
    vocab = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(60):
        text = " ".join(rng.choice(vocab, 120))
        rows.append((k * 3, text, "x"))
        if k % 4 == 0:
            words = text.split()
            words[rng.integers(0, 120)] = "changed"
            rows.append((k * 3 + 1, " ".join(words), "y"))
    rows += [(900, "", "e"), (901, None, "n"), (902, " \n ", "e"), (903, "One", None), (904, "oNE", None),
             (904, "oNE", None), (None, "one", None), (None, "far away from all the rest", None)]
    docs = frame(rows, "doc_id long, text string, fingerprint string")
    for options in ({}, {"node_rows": 8}):
        got = simhash.near_duplicates(docs, **options).collect()
        assert len(got) == len(rows)
        fps = [brute_fp(t) for _, t, _ in rows]
        lab = brute_labels(fps, 4)
        ids = {}
        for (i, _, _), r in zip(rows, lab):
            ids.setdefault(r, []).append(i)
        want = sorted((str(i), f"{f:016x}", str(min((x for x in ids[r] if x is not None), default=None)))
                      for (i, _, _), f, r in zip(rows, fps, lab))
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(min((x for x in v if x is not None), default=None)) for v in ids.values())


def test_empty_table(frame):
    docs = frame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0
