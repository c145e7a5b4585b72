import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from voltaflow.llm import packing, queries

SF = "/root/testdata/sf0.01"
FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(open(FILE, encoding="utf-8").read(), public_tokenizers.PATTERN)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps.remove(fit)
            gaps.append(fit - n)
    return len(gaps)


def check(rows, ids_of, capacity):
    """rows: query rows; ids_of(doc_id) -> ids with the end id. Every id is in one piece, sequences have no gaps."""
    held = defaultdict(list)
    docs = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for places in held.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    for d, own in docs.items():
        ids, at = np.array(ids_of(d), "<u4"), 0
        for k, r in enumerate(sorted(own, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            assert r.length == capacity or k == 0
            at += r.length
        assert at == len(ids)
    return len(held)


def test_given_documents(spark, library):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op12_packing(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(text)
    made = check(rows, lambda d: [*library.encode(text[d] or "", add_special_tokens=False).ids, 0], 2048)
    total = sum(r.length for r in rows)
    assert made <= -(-total // 2048) + 1
    assert made <= best_fit_decreasing([r.length for r in rows], 2048)


def test_ids_are_those_of_tokenizers(library, encoder):
    assert encoder.slow is None
    rnd = random.Random(3)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b1{c}2 {c}{c} !{c}?  {c}" for c in map(chr, rnd.sample(points, 20_000))]
    texts += ["", " ", "\n\n  x", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "it's 'S we'LL", "x" * 5000]
    for t in texts:
        assert encoder.encode(t) == library.encode(t, add_special_tokens=False).ids, t


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_ids_of_any_text(text):
    global _E, _L
    try:
        _E
    except NameError:
        _E, _L = packing.Encoder(open(FILE, encoding="utf-8").read(), public_tokenizers.PATTERN), tokenizers.Tokenizer.from_file(FILE)
    assert _E.encode(text) == _L.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_are_left_to_the_library(library):
    path = public_tokenizers.path("word_bpe_49k.json")
    own = packing.Encoder(open(path, encoding="utf-8").read(), public_tokenizers.PATTERN)
    assert own.slow is not None
    assert own.encode("Some Words here") == tokenizers.Tokenizer.from_file(path).encode("Some Words here", add_special_tokens=False).ids


def test_exact_complements_are_consumed():
    # one, two or three lengths close each gap, so no id is wasted
    for counts, want in (({60: 5, 40: 5}, 5), ({70: 4, 20: 4, 10: 4}, 4), ({55: 3, 20: 3, 15: 3, 10: 3}, 3),
                         ({25: 4000}, 1000), ({100: 7}, 7), ({1: 1050}, 11), ({}, 0)):
        assert packing.plan(Counter(counts), 100).sequences == want


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=25))
@settings(max_examples=150, deadline=None)
def test_plan_places_every_piece_once(counts):
    made = packing.plan(counts, 64)
    held = defaultdict(list)
    for n, c in counts.items():
        s, o = made.place(np.full(c, n), np.arange(c))
        for a, b in zip(s.tolist(), o.tolist()):
            held[a].append((b, n))
    assert set(held) == set(range(made.sequences))
    for places in held.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 64
    total = sum(n * c for n, c in counts.items())
    assert made.sequences >= -(-total // 64)
    assert made.sequences <= best_fit_decreasing(list(Counter(counts).elements()), 64) * 1.03 + 1


def test_odd_rows_and_sequences(frame, library):
    long = "several words again " * 900
    rows = [(1, "short"), (2, None), (3, ""), (None, "no id"), (4, long), (5, "twice"), (5, "twice"), (6, "<|endoftext|>")]
    rows += [(100 + k, "a hot text") for k in range(500)]
    docs = frame([(*r, 7, "x") for r in rows], "doc_id long, text string, length int, piece string")
    vocabulary = open(FILE, encoding="utf-8").read()
    cut_ = packing.pieces(docs, vocabulary, public_tokenizers.PATTERN, 64, keep_ids=True)
    packed = packing.pack(cut_, 64).collect()
    n = lambda t: len(library.encode(t or "", add_special_tokens=False).ids) + 1
    assert sum(r.length for r in packed) == sum(n(t) for _, t in rows)
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(d for d, _ in rows)
    got = queries.packed(docs.where("doc_id is not null and doc_id <> 5"), FILE, public_tokenizers.PATTERN, 64).collect()
    text = dict(rows)
    check(got, lambda d: [*library.encode(text[d] or "", add_special_tokens=False).ids, 0], 64)
    spark = docs.sparkSession
    whole = {r.sequence_id: list(r.ids) for r in packing.sequences(spark.createDataFrame(packed)).collect()}
    for r in packed:
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == list(r.ids)
    assert packing.pack(packing.pieces(docs.limit(0), vocabulary, public_tokenizers.PATTERN)).collect() == []
