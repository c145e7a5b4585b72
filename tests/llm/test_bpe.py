import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from voltaflow.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
MODEL = bpe.serialise(RANKS)
ENCODER = bpe.Encoder(MODEL, public_tokenizers.PATTERN)
TABLE = bpe.token_bytes(MODEL)
OWN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@given(st.text(max_size=80) | st.text(alphabet="ab \n'\t1ßé中🙂st.ll", max_size=200))
@settings(max_examples=400, deadline=None)
def test_same_ids_as_the_reference_encoder_and_exact_round_trip(text):
    ids = ENCODER.encode(text)
    assert ids.tolist() == OWN.encode_ordinary(text)
    assert bpe.decode_ids(ids, TABLE) == text.encode()


def test_every_token_of_the_vocabulary_and_long_runs():
    for text in ("x" * 30_000, " " * 30_000, "ab1 " * 600_000, "<|endoftext|>", "<unk>"):
        ids = ENCODER.encode(text)
        assert ids.tolist() == OWN.encode_ordinary(text)
        assert bpe.decode_ids(ids, TABLE) == text.encode()
    for token, rank in list(RANKS.items())[::37]:
        assert bpe.decode_ids(np.array([rank]), TABLE) == token


def test_gaps_in_ranks():
    encoder = bpe.Encoder(bpe.serialise({bytes([b]): b for b in range(256)} | {b"ab": 300}), r"\S+|\s+")
    assert encoder.encode("abb").tolist() == [300, 98]


def test_memory_limit_does_not_change_results(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe.Encoder(MODEL, public_tokenizers.PATTERN)
    for text in ("one two three four five", "six one seven two", "one two three nine ten eleven"):
        assert encoder.encode(text).tolist() == OWN.encode_ordinary(text)


class Counted:
    """A sentencepiece processor that notes how many words each call encodes."""

    def __init__(self, sp):
        self.sp, self.calls = sp, []

    def encode(self, words, **options):
        self.calls.append(len(words))
        return self.sp.encode(words, **options)


def test_words_used_last_are_not_encoded_again(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe.Encoder(MODEL, public_tokenizers.PATTERN)
    encoder.sp = Counted(encoder.sp)
    for k in "abcdefghij":
        text = f"xqzv wqjk zzxv qqwv x{k}qzjv"
        assert encoder.encode(text).tolist() == OWN.encode_ordinary(text)
    assert sum(encoder.sp.calls) == 14  # the four common words once, and a new one in each text


def test_new_words_of_many_texts_take_one_call():
    encoder = bpe.Encoder(MODEL, public_tokenizers.PATTERN)
    encoder.sp = Counted(encoder.sp)
    texts = [f"xqzv{k}zzxv wqjk" for k in range(500)]
    ids, limits = encoder.encode_all(texts)
    assert [x.tolist() for x in np.split(ids, limits[1:-1])] == [OWN.encode_ordinary(t) for t in texts]
    assert len(encoder.sp.calls) == 1


@pytest.mark.parametrize("size", [1, 3, 4, 1000])
def test_limits_of_slices_and_texts(monkeypatch, size):
    monkeypatch.setattr(bpe, "_SLICE", size)
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    texts = ["", "one two three", None, "", "four xqzv xqzv", "a b c d", "", "long " * 40, "\U0001f642 中 ß", ""]
    ids, limits = bpe.Encoder(MODEL, public_tokenizers.PATTERN).encode_all(texts)
    assert [x.tolist() for x in np.split(ids, limits[1:-1])] == [OWN.encode_ordinary(t or "") for t in texts]


def test_decoded_column_with_nulls(frame):
    rows = [(0, None), (1, []), (2, OWN.encode_ordinary("Zwölf 12")), (3, None), (4, OWN.encode_ordinary("\U0001f642")[:1])]
    got = frame(rows, "k long, ids array<int>").select("k", bpe.decode(F.col("ids"), MODEL).alias("raw")).collect()
    assert {r.k: r.raw and bytes(r.raw) for r in got} == {k: None if ids is None else bpe.decode_ids(np.array(ids, int), TABLE)
                                                         for k, ids in rows}


def expected(text):
    ids = OWN.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op6_bpe(spark, SF).collect()}
    assert got == {d.doc_id: expected(d.text) for d in docs}


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (1, "", None), (1, "", None), (None, "Zwölf 12", "b")]])
def test_nulls_repeats_clashing_names_and_empty_tables(frame, rows):
    docs = frame(rows, "doc_id long, text string, ids string")
    got = queries.token_digests(docs, PATH, public_tokenizers.PATTERN).collect()
    key = lambda x: (str(x[0]), *x[1:])
    assert sorted(map(tuple, got), key=key) == sorted(((i, *expected(t)) for i, t, _ in rows), key=key)
