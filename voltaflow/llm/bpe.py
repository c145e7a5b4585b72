"""Byte-level BPE through a sentencepiece model made from a rank file.

The rank file (one ``base64 rank`` line per token) is all that is needed; no
tokenizer is trained. Each byte is mapped to one printable character
(``chr(0x100 + byte)``), each token becomes a piece whose score is its negative
rank, and normalisation is the identity. sentencepiece then merges the adjacent
pair of best score, leftmost first: the merge of lowest rank, which is what
byte-level BPE does. A text is cut into pre-tokens by the tokenizer's pattern
and each is encoded by itself, so results don't depend on their neighbours.

The model (about 1 MB) is built once on the driver and shipped with the
function. A worker numbers the pre-tokens of many texts at a time, has the new
ones encoded in one call and gathers ids by number. It remembers them up to a
fixed number.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from voltaflow.llm.common import bounded_batches, freeing

#: Pre-tokens a worker remembers; beyond it the half used last stays.
REMEMBERED = 150_000
#: Pre-tokens that are encoded at once, of several texts or a part of one.
_SLICE = 1 << 16
_FROM_CHAR = {0x100 + b: b for b in range(256)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def pieces_of(tokens: list[bytes]) -> list[str]:
    """The tokens with a character for each byte, all mapped at once."""
    mapped = (np.frombuffer(b"".join(tokens), np.uint8) + np.uint16(0x100)).astype("<u2").tobytes().decode("utf-16-le")
    return [mapped[a:b] for a, b in pairwise(accumulate(map(len, tokens), initial=0))]


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model of the vocabulary. Piece 0 is the unknown
    piece that the library asks for; the token of rank r is piece r + 1, with
    unused pieces in the gaps of the ranks."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.unk_id, model.trainer_spec.bos_id = 0, -1
    model.trainer_spec.eos_id, model.trainer_spec.pad_id = -1, -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    model.pieces.add(piece="<unk>", score=0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    by_rank = dict(zip(ranks.values(), pieces_of(list(ranks))))
    for r in range(max(by_rank) + 1):
        if r in by_rank:
            model.pieces.add(piece=by_rank[r], score=-r)
        else:
            model.pieces.add(piece=f"<unused{r}>", score=-r, type=pb.ModelProto.SentencePiece.UNUSED)
    model.trainer_spec.vocab_size = len(model.pieces)
    return model.SerializeToString()


def token_bytes(model: bytes) -> list[bytes]:
    """The inverse mapping: bytes by rank. Unused pieces decode to nothing;
    they are never encoded."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = (sp.id_to_piece(k) for k in range(1, sp.get_piece_size()))
    return [b"" if p[0] == "<" else bytes(map(_FROM_CHAR.__getitem__, map(ord, p))) for p in pieces]


def decode_ids(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


class _Numbers(dict):
    """Number of each pre-token; a new one gets the next number."""

    def __missing__(self, token: str) -> int:
        self[token] = k = len(self)
        return k


def _lists(rows: list) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat - 1))


class Encoder:
    """Encoder of one worker."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern)
        self.whole = {b: (k + 1,) for k, b in enumerate(token_bytes(model)) if b}
        self.number = _Numbers()
        self.known = _lists([])  # ids by number
        self.used = np.empty(0, np.int64)  # slice of the last use, by number
        self.slice = 0

    def _learn(self, tokens: list[str]) -> None:
        raw = [t.encode("utf-8", "surrogatepass") for t in tokens]
        # a pre-token that is a token of the vocabulary is never cut
        rest = iter(self.sp.encode(pieces_of([r for r in raw if r not in self.whole]), out_type=int, num_threads=1))
        self.known = pa.concat_arrays([self.known, _lists([self.whole.get(r) or next(rest) for r in raw])])

    def _ids(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens, joined, and the limits between them."""
        before = len(self.number)
        numbers = np.fromiter(map(self.number.__getitem__, tokens), np.int32, len(tokens))
        if len(self.number) > before:
            self._learn(list(islice(self.number, before, None)))
        got = self.known.take(pa.array(numbers))
        self.slice += 1
        self.used = np.concatenate([self.used, np.zeros(len(self.number) - before, np.int64)])
        self.used[numbers] = self.slice
        if len(self.number) > REMEMBERED:
            half, names = REMEMBERED // 2 + 1, list(self.number)
            last = np.flatnonzero(self.used >= np.partition(self.used, -half)[-half])
            self.number = _Numbers((names[k], n) for n, k in enumerate(last.tolist()))
            self.known, self.used = self.known.take(pa.array(last)), self.used[last]
        return got.values.to_numpy(), got.offsets.to_numpy()

    def _pretokens(self, text: str) -> Iterator[list[str]]:
        if len(text) < 8 * _SLICE:
            yield self.find.findall(text)
        else:  # a very long text is taken in slices of whole pre-tokens
            matches = (m[0] for m in self.find.finditer(text))
            yield from iter(lambda: list(islice(matches, _SLICE)), [])

    def _slices(self, texts: Iterable[str | None]) -> Iterator[tuple[list[str], list[int]]]:
        """Pre-tokens of the texts, and the places among them where texts end."""
        part, stops = [], []
        for text in texts:
            for more in self._pretokens(text or ""):
                part += more
                if len(part) >= _SLICE:
                    yield part, stops
                    part, stops = [], []
            stops.append(len(part))
        yield part, stops

    def encode_all(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and the limits between the texts."""
        out, limits, done = [np.empty(0, np.int32)], [np.zeros(1, np.int64)], 0
        for part, stops in self._slices(texts):
            ids, at = self._ids(part)
            out.append(ids)
            limits.append(done + at[np.array(stops, np.int64)])
            done += len(ids)
        return np.concatenate(out), np.concatenate(limits)

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]


def encode(text: Column, model: bytes, pattern: str) -> Column:
    """Token ids (array of int) of a text column, without special tokens. A
    null text counts as empty, an empty one has no ids."""
    bounded_batches()

    @F.arrow_udf("array<int>")
    @freeing
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(model, pattern)
        for batch in batches:
            flat, limits = encoder.encode_all(t.as_py() for t in batch)
            yield pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(flat))
    return ids(text)


def decode(ids: Column, model: bytes) -> Column:
    """Bytes of an id column, by the inverse mapping. Null ids give null bytes."""
    bounded_batches()

    @F.arrow_udf("binary")
    @freeing
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = pa.array(token_bytes(model), pa.binary())
        for batch in batches:
            tokens = pa.ListArray.from_arrays(batch.offsets, table.take(batch.values))
            yield pc.if_else(batch.is_valid(), pc.binary_join(tokens, b""), None)
    return raw(ids)
