import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SF
from voltaflow.llm import decontaminate as dec
from voltaflow.llm import queries

SCHEMA = "doc_id long, text string, item_id string"
ITEMS = "item_id long, text string"


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for k, y in enumerate(b, 1):
            prev, row[k] = row[k], prev + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


@given(st.lists(st.integers(1, 4), min_size=1, max_size=90), st.lists(st.integers(1, 5), max_size=60))
@settings(max_examples=300, deadline=None)
def test_lcs(a, b):
    assert dec.lcs(dec._masks(a), len(a), b) == brute_lcs(a, b)


def test_gram_product_and_rows():
    rng = np.random.default_rng(1)
    ids, sizes = rng.integers(0, 9, 500), np.array([100, 0, 33, 367])
    idf = np.array([0, 1, 2, 0, .5, 1, 1, 3, 1.0])
    row, word, value = dec._rows(ids, sizes, idf)
    a = np.zeros((row.max() + 1, 9))
    a[row, word] = value
    passages = []
    for doc in np.split(ids, np.cumsum(sizes)[:-1]):
        for k in range(0, len(doc), dec.PASSAGE):
            v = np.bincount(doc[k:k + dec.PASSAGE], minlength=9) * idf
            if v.any():
                passages.append(v / np.linalg.norm(v))
    assert np.allclose(a, passages)
    omega = rng.standard_normal((9, 3))
    old, dec._NONZERO = dec._NONZERO, 7
    try:
        words, got = dec._gram_product(row, word, value, omega)
    finally:
        dec._NONZERO = old
    assert np.allclose(got, (a.T @ a @ omega)[words])


def test_nystroem_finds_the_leading_space():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((200, 5)) @ rng.standard_normal((5, 40))
    omega = rng.standard_normal((40, 9))
    basis = dec._nystroem(a.T @ a @ omega, omega, 5)
    true = np.linalg.svd(a)[2][:5].T
    assert np.allclose(basis @ basis.T, true @ true.T, atol=1e-4)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(4)
    vocab = np.array([f"q{k}" for k in range(4000)])
    common = np.array(["the", "of", "and", "in", "to"])

    def prose(n):
        return [str(rng.choice(common) if rng.random() < .5 else rng.choice(vocab)) for _ in range(n)]
    items = [(k, " ".join(prose(int(n))) + ". " + " ".join(prose(6)) + ".") for k, n in enumerate(rng.integers(10, 70, 400))]
    docs, want = [], set()
    for d in range(600):
        words = prose(int(rng.integers(5, 900)))
        if d % 3 == 0:
            item_id, text = items[int(rng.integers(0, 200))]
            leak = text.split()
            if d % 2:  # a paraphrase: some words replaced, dropped and added, the answer kept
                leak = [w if rng.random() > .15 or k >= len(leak) - 6 else str(rng.choice(vocab))
                        for k, w in enumerate(leak) if rng.random() > .05 or k >= len(leak) - 6]
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = [w.upper() for w in leak]
            want.add((d, item_id))
        docs.append((d, " ".join(words), "x"))
    return docs, items, want


def test_planted_leaks_are_found_and_nothing_else(frame, corpus):
    docs, items, want = corpus
    docs, bench = frame(docs, SCHEMA), frame(items, ITEMS)
    got = {(r.doc_id, r.item_id) for r in dec.leaks(docs, bench).collect()}
    assert got <= want
    assert len(got) >= 0.98 * len(want)
    assert {w for w in want if w[0] % 2 == 0} <= got  # exact passages
    kept = dec.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(600)) - {d for d, _ in got}


def test_every_document_shapes_the_basis(frame, corpus, monkeypatch):
    docs, items, _ = corpus
    docs, bench = frame(docs, SCHEMA), frame(items, ITEMS)

    def basis():
        (search, _), = dec.searches(docs, bench)
        return search.finder.space.latent
    whole = basis()
    assert whole.shape[1] == dec.RANK
    monkeypatch.setattr(dec, "FIT_DOCS", 50, raising=False)  # the size from which a sample was taken
    part = basis()
    # some products of words instead of the whole Gram matrix
    assert np.allclose(part[:300] @ part.T, whole[:300] @ whole.T, atol=1e-3)


def test_blocks_of_the_benchmark_find_the_same_exact_passages(frame, corpus):
    docs, items, want = corpus
    docs, bench = frame(docs, SCHEMA), frame(items, ITEMS)
    blocks = list(dec.searches(docs, bench, block_bytes=40_000))
    assert len(blocks) > 1
    old, dec.BLOCK_BYTES = dec.BLOCK_BYTES, 40_000
    try:
        found = set()
        for search, _ in blocks:
            out = docs.select("doc_id", search.leaks(dec.encode(docs["text"], search.vocabulary)).alias("x")).collect()
            found |= {(r.doc_id, x.item_id) for r in out for x in r.x}
    finally:
        dec.BLOCK_BYTES = old
    assert {w for w in want if w[0] % 2 == 0} <= found <= want


def test_findings_do_not_depend_on_the_blocks(frame, corpus, monkeypatch):
    """Paraphrases too: one and several blocks, and products of a few items at a time."""
    docs, items, want = corpus
    docs, bench = frame(docs, SCHEMA), frame(items, ITEMS)
    whole = {tuple(r) for r in dec.leaks(docs, bench).collect()}
    monkeypatch.setattr(dec, "ITEMS_AT_ONCE", 7)
    parts = set()
    blocks = list(dec.searches(docs, bench, id_col="doc_id", block_bytes=25_000))
    assert len(blocks) >= 5
    for search, coded in blocks:
        for r in coded.select("_id", search.leaks(coded["ids"]).alias("x")).collect():
            parts |= {(r._id, x.item_id, x.cosine, x.lcs_share, x.answer_share, x.start, x.end) for x in r.x}
    assert {w[:2] for w in parts} == {w[:2] for w in whole}
    assert {w[:2] + w[3:] for w in parts} == {w[:2] + w[3:] for w in whole}
    assert len({w[:2] for w in whole if w[0] % 2}) >= 0.95 * len([w for w in want if w[0] % 2])


def test_candidates_against_every_window(spark):
    """Both ways: all pairs that pass the checks over any window of any document, by plain LCS."""
    docs = [(r.doc_id, dec.words_of(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, dec.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in queries.op9_decontamination(spark, SF).collect()}
    want = set()
    for i, own in items:
        if not own:
            continue
        masks, half = dec._masks(own), max(16, 1 << (len(own) - 1).bit_length()) // 2
        for d, words in docs:
            for a in range(0, max(len(words), 1), half):
                region = words[max(a - half // 2, 0):a + 2 * half + half // 2]
                if len(region) >= 0.8 * len(own) and dec.lcs(masks, len(own), region) >= 0.9 * len(own):
                    want.add((d, i))
    assert want and len(want & got) >= 0.9 * len(want)
    share = {}
    for d, i in got - want:  # what else is found holds at least half of the item in order
        own, words = dict(items)[i], dict(docs)[d]
        share[d, i] = dec.lcs(dec._masks(own), len(own), words) / len(own)
    assert all(v >= dec.LOOSE for v in share.values())


def test_query_finds_every_whole_passage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    flat = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    want = {(d.doc_id, i.item_id) for d in docs for i in items if flat(i.text) in flat(d.text)}
    got = {(r.doc_id, r.item_id): r.lcs_share for r in queries.op9_decontamination(spark, SF).collect()}
    assert want and want <= set(got)
    assert all(got[p] == 1.0 for p in want)


@pytest.mark.parametrize("items", [[], [(1, None), (2, ""), (None, "x y z")], [(1, "alpha beta"), (1, "alpha beta"), (2, "…")]])
@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", "b"), (3, "so Alpha, beta!", None), (3, "so Alpha, beta!", None),
                                       (None, "alpha beta", "c")]])
def test_nulls_repeats_clashing_names_and_empty_tables(frame, items, rows):
    docs, bench = frame(rows, SCHEMA), frame(items, ITEMS)
    got = sorted(str(r.doc_id) for r in dec.leaks(docs, bench).collect())
    leaked = ["3", "3", "None"] if rows and len(items) == 3 and items[0][1] == "alpha beta" else []
    assert got == leaked
    assert dec.clean(docs, bench).count() == len(rows) - len(leaked)
