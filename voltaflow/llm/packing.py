"""Best-fit packing of tokenised documents by exact-complement hashing.

1. *Pieces.* A document's ids (and an end id) are cut from the back into pieces
   of at most ``capacity`` ids, so only the first piece can be shorter.
2. *Plan.* Which lengths share a sequence depends only on how many pieces there
   are of each length: at most ``capacity`` counts, whatever the table's size.
   ``plan`` works on these counts. Sums of two lengths are indexed by hashing;
   a gap is closed by a single length, by a pair of the index, or by a length
   whose complement is in the index (a triple). Combinations that fill a gap
   exactly are consumed as often as the counts allow; what is left is packed
   best-fit, again with exact complements as soon as a gap has one. A pattern
   is used many times over, so there are a few thousand patterns at most.
3. *Places.* Every piece is numbered among those of its length, in two levels
   (within a slice of the table, then over the slices), so a length that a third
   of all pieces share is no hot group. Number and length give the pattern, the
   sequence and the place in it by binary search in the plan.

The driver holds the counts and the plan (bounded by ``capacity``), never pieces.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltaflow.llm.common import bounded_batches, cut

CAPACITY = 2048
END_ID = 0
#: Plans to choose from: exact fills before everything else or not, and the most lengths of a fill.
WAYS = ((True, 3), (False, 3), (False, 2), (False, 1))
PIECES = "array<struct<piece:int,start:long,length:long,crc:long,ids:array<int>>>"
#: Fixed value: the byte alphabet of byte-level BPE vocabularies maps these bytes to
#: themselves and the others, in order, to the characters from 256 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_of_character() -> dict[str, int]:
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE vocabulary file (``tokenizers`` JSON), without
    added special tokens; the text of a special token is that token, as there.

    ``tokenizers`` itself spends most of its time on what isn't needed here. As
    ids of such a vocabulary are merge ranks, ``tiktoken`` gives the same ids
    from the same file several times as fast. A file of any other kind is left
    to ``tokenizers``.
    """

    def __init__(self, vocabulary: str, pattern: str):
        spec = json.loads(vocabulary)
        kind, pre = spec["model"], spec.get("pre_tokenizer") or {}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec.get("added_tokens") or [])
        odd = [kind.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")]
        self.slow = None
        if (kind.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and plain and not any(odd)
                and not pre.get("add_prefix_space") and not spec.get("normalizer")):
            import tiktoken

            byte = byte_of_character()
            ranks = {bytes(byte[c] for c in t): k for t, k in kind["vocab"].items() if t not in self.special}
            self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special)
        else:
            import tokenizers

            self.slow = tokenizers.Tokenizer.from_str(vocabulary)

    def encode(self, text: str) -> list[int]:
        if self.slow:
            return self.slow.encode(text, add_special_tokens=False).ids
        if any(t in text for t in self.special):
            return self.fast.encode(text, allowed_special="all")
        return self.fast.encode_ordinary(text)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be short."""
    count = -(-n // capacity)
    first = n - (count - 1) * capacity
    return [(0, first)] + [(first + k * capacity, capacity) for k in range(count - 1)]


def pieces(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``<id_col>, piece, start, length, ids_crc32`` (and ``ids``) of every row of
    ``docs``. ``vocabulary`` is the text of the tokenizer's file. A null or empty
    text has the end id alone; null and repeated ids are rows like any other.
    Other columns are not read."""
    bounded_batches()

    @F.arrow_udf(PIECES)
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Encoder(vocabulary, pattern)
        kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()),
                                   ("ids", pa.list_(pa.int32()))]))
        for batch in batches:
            out = []
            for text in batch:
                ids = np.array([*own.encode(text.as_py() or ""), end_id], "<u4")
                out.append([{"piece": k, "start": a, "length": n, "crc": zlib.crc32(ids[a:a + n].tobytes()),
                             "ids": ids[a:a + n].astype(np.int32) if keep_ids else None}
                            for k, (a, n) in enumerate(cuts(len(ids), capacity))])
            yield pa.array(out, kind)

    each = docs.select(F.col(id_col).alias("id"), F.explode(encoded(F.col(text_col))).alias("p"))
    return each.select(F.col("id").alias(id_col), "p.piece", "p.start", "p.length", F.col("p.crc").alias("ids_crc32"),
                       *([F.col("p.ids")] if keep_ids else []))


class _Sums:
    """Lengths still available, and the index of the sums of two of them."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for n, c in counts.items():
            self.left[n] = c
        own = np.flatnonzero(self.left)[::-1]
        # per sum its larger parts, largest first; a part that ran out never comes back
        a, b = (own[k] for k in np.triu_indices(len(own)))
        fits = a + b <= capacity
        a, total = a[fits], (a + b)[fits]
        order = np.argsort(total, kind="stable")
        self.part, self.sum = a[order], total[order]
        self.at = np.searchsorted(self.sum, np.arange(capacity + 2)).tolist()
        self.end = self.at[1:] + [len(self.sum)]

    def has(self, own: Counter) -> bool:
        return all(self.left[n] >= c for n, c in own.items())

    def pair(self, total: int, most: int, used: Counter) -> tuple[int, int] | None:
        """The pair of that sum with the largest part up to ``most``."""
        first = True
        for k in range(self.at[total], self.end[total]):
            a = int(self.part[k])
            b = total - a
            if self.left[a] < (2 if a == b else 1) or self.left[b] < 1:
                if first:
                    self.at[total] = k + 1  # gone for good
                continue
            first = False
            if a <= most and self.has(used + Counter((a, b))):
                return a, b
        return None

    def complement(self, gap: int, used: Counter, most: int) -> list[int] | None:
        """One, two or three lengths, ``most`` at most, that fill ``gap`` exactly."""
        if self.left[gap] > used[gap]:
            return [gap]
        if most > 1 and (pair := self.pair(gap, gap, used)):
            return list(pair)
        if most < 3:
            return None
        own = np.flatnonzero(self.left[:gap])[::-1]
        for a in own[own * 3 >= gap].tolist():
            if self.left[a] > used[a] and (pair := self.pair(gap - a, a, used + Counter((a,)))):
                return [a, *pair]
        return None

    def largest(self, gap: int, used: Counter) -> int:
        """The largest length up to ``gap`` that is left; 0 if there is none."""
        for n in np.flatnonzero(self.left[:gap + 1])[::-1].tolist():
            if self.left[n] > used[n]:
                return n
        return 0

    def take(self, own: Counter) -> int:
        times = min(int(self.left[n]) // c for n, c in own.items())
        for n, c in own.items():
            self.left[n] -= times * c
        return times


def _patterns(counts: dict[int, int], capacity: int, exact_first: bool, most: int) -> list[tuple[Counter, int]]:
    sums, out = _Sums(counts, capacity), []

    def use(own: Counter) -> None:
        out.append((own, sums.take(own)))

    for n in np.flatnonzero(sums.left)[::-1].tolist() if exact_first else []:
        while sums.left[n]:
            used = Counter((n,))
            more = sums.complement(capacity - n, used, 3) if n < capacity else []
            if more is None:
                break
            use(used + Counter(more))
    while (n := sums.largest(capacity, Counter())):
        used, gap = Counter(), capacity
        while n:
            # as many of the largest as fit: each of them would go into the same gap next
            used[n] += 1
            gap -= n
            more = sums.complement(gap, used, most) if gap else []
            if more is not None:
                used.update(more)
                break
            n = sums.largest(gap, used)
        use(used)
    return out


@dataclass
class Plan:
    """Runs of places: pieces ``first .. first + n - 1`` of a length go, ``each``
    to a sequence, to the sequences from ``sequence`` on, at ``offset``."""
    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``nth`` (from 0) piece of a length."""
        # runs are sorted by (length, first); numbers below 2 ** 48 keep the key in 64 bits
        run = np.searchsorted((self.length << 48) + self.first, (length << 48) + nth, side="right") - 1
        within = nth - self.first[run]
        return (self.sequence[run] + within // self.each[run],
                self.offset[run] + within % self.each[run] * length)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Packing of ``counts[n]`` pieces of each length ``n``.

    Exact fills before everything else, or along with best-fit, or of fewer
    lengths, can each be the better choice; all are computed from the counts, and
    the shortest is kept, the first of them if no id is wasted.
    """
    least, best = -(-sum(n * c for n, c in counts.items()) // capacity), None
    for way in WAYS:
        found = _patterns(counts, capacity, *way)
        if best is None or sum(t for _, t in found) < sum(t for _, t in best):
            best = found
        if sum(t for _, t in best) == least:
            break
    done, rows, sequence = Counter(), [], 0
    for own, times in best:
        offset = 0
        for n, c in sorted(own.items(), reverse=True):
            rows.append((n, done[n], c, sequence, offset))
            done[n] += c * times
            offset += c * n
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*table.T, sequences=sequence)


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to
    ``capacity``. Every row is placed, equal ones too; an empty table stays so."""
    rows = cut(cut_pieces.withColumn("_nth", F.monotonically_increasing_id()))
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most ``capacity`` rows
    made = plan(counts, capacity)
    # numbers within (length, slice), then the pieces of the slices before
    sliced = rows.withColumn("_slice", F.shiftright("_nth", 33))
    own = Window.partitionBy("length", "_slice").orderBy("_nth")
    before = (sliced.groupBy("length", "_slice").count()
              .withColumn("_before", F.sum("count").over(Window.partitionBy("length").orderBy("_slice")) - F.col("count"))
              .drop("count"))
    numbered = (sliced.withColumn("_own", F.row_number().over(own) - 1).join(before, ["length", "_slice"])
                .withColumn("_number", F.col("_own") + F.col("_before")))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(length: pa.Array, nth: pa.Array) -> pa.Array:
        s, o = made.place(np.asarray(length, np.int64), np.asarray(nth, np.int64))
        return pa.StructArray.from_arrays([pa.array(s, pa.int64()), pa.array(o, pa.int64())], ["sequence_id", "offset"])

    placed = numbered.withColumn("_place", place(F.col("length"), F.col("_number")))
    return placed.select(*cut_pieces.columns, "_place.sequence_id", "_place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of packed pieces that carry their ``ids``: at most
    ``capacity`` ids are gathered per sequence."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(own, lambda p: p["ids"])).alias("ids"))
