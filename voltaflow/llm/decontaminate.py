"""Benchmark leaks by latent semantic retrieval.

1. *Words.* Each text is turned once into the positions' benchmark-word ids (0
   for other words), a compact binary column that is checkpointed; all later
   passes read it and not the texts. Document frequencies cover all documents.
   Words in more than ``MAX_DF`` of the documents are left out of the TF-IDF
   vectors, but the rarest words of every item always stay in: ``RAREST[0]`` of
   them, and up to ``RAREST[1]`` if they are telling (see 4).
2. *Randomised SVD.* Passages of ``PASSAGE`` words are rows of a TF-IDF matrix
   of unit rows, stacked with the benchmark items (weighted to the same total).
   Each task multiplies its rows by a random test matrix and back; the products
   are summed by word in a shuffle, and a Nystroem step on the driver (words by
   ``RANK`` numbers) gives the latent basis. All documents take part.
3. *Search.* Every document is covered by overlapping windows whose length
   follows the items' lengths. A window is a candidate for an item if their
   latent cosine is at least ``COSINE`` and the window covers at least ``COVER``
   of the item's latent weight. Windows too light to cover any item are skipped
   before the product; that can't lose a candidate.
4. *Checks.* The longest common subsequence of the item's words and the window
   (with a margin on each side) must hold ``EXACT`` of the item; or ``LOOSE`` of
   it, if it also holds ``ANSWER`` of the item's answer in order. The answer is
   the item's last sentence, or its last quarter where it has only one. Each
   share is the smaller of two: over all words, and over telling words, those in
   at most ``TELLING_DF`` of the documents, so function words alone don't make a
   match. An item with fewer than ``TELLING`` of them must pass ``EXACT``.

Frequencies, kept words and the basis are those of the whole benchmark, so what is
found for an item doesn't depend on the others. The driver and each worker hold the
benchmark's distinct words (about 600 bytes each: the basis) and search items in
blocks of at most ``BLOCK_BYTES`` of text; a larger benchmark takes more blocks. A
product has at most ``_NONZERO / 4`` windows by ``ITEMS_AT_ONCE`` items.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaflow.llm.common import bounded_batches, cut, freeing

MAX_DF = 0.02
RAREST = (3, 8)
PASSAGE = 32
RANK, EXTRA = 128, 16
COSINE, COVER = 0.45, 0.35
EXACT, LOOSE, ANSWER = 0.8, 0.5, 0.8
TELLING, TELLING_DF = 4, 0.25
BLOCK_BYTES = 8 << 20
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_NONZERO = 20_000  # matrix entries multiplied at once
ITEMS_AT_ONCE = 1024
LEAKS = "array<struct<item_id: long, cosine: double, lcs_share: double, answer_share: double, start: int, end: int>>"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def answer_words(text: str | None) -> int:
    """How many words at the end of an item are its answer."""
    parts = [n for s in _SENTENCE.split(text or "") if (n := len(words_of(s)))]
    total = sum(parts)
    return parts[-1] if len(parts) > 1 else math.ceil(total / 4)


def encode(text: Column, vocabulary: dict[str, int]) -> Column:
    """Word ids of a text as little-endian binary; 0 is any other word."""
    kind = "<u2" if len(vocabulary) < 1 << 16 else "<u4"

    bounded_batches()

    @F.pandas_udf("binary")
    @freeing
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text):
            words = words_of(text)
            return np.fromiter((vocabulary.get(w, 0) for w in words), kind, len(words)).tobytes()
        for s in batches:
            yield s.map(one).astype(object)
    return ids(text)


def lcs(masks: dict[int, int], size: int, words) -> int:
    """Length of the longest common subsequence, bit-parallel: ``masks`` has
    the positions of each word of the shorter sequence."""
    full = (1 << size) - 1
    s = full
    for w in words:
        m = masks.get(w)
        if m:
            u = s & m
            s = ((s + u) | (s - u)) & full
    return size - s.bit_count()


def _masks(words) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << k
    return out


def unpack(batch: pd.Series, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch and the number of words of each document."""
    raw = [b or b"" for b in batch]
    ids = np.frombuffer(b"".join(raw), kind)
    return ids, np.array([len(b) for b in raw], np.int64) // np.dtype(kind).itemsize


@dataclass
class Space:
    """By word id: TF-IDF weights (0 where a word is left out), whether the
    word counts as telling, and the latent basis."""
    kind: str
    idf: np.ndarray
    telling: np.ndarray
    latent: np.ndarray  # word id x rank, TF-IDF weight included


def _rows(ids: np.ndarray, sizes: np.ndarray, idf: np.ndarray):
    """Unit TF-IDF rows of passages: (row of each entry, word, value)."""
    start = np.cumsum(sizes) - sizes
    at = np.flatnonzero(idf[ids] > 0)
    doc = np.searchsorted(start, at, "right") - 1
    row = (at - start[doc]) // PASSAGE + (np.cumsum(sizes // PASSAGE + 1) - (sizes // PASSAGE + 1))[doc]
    key, count = np.unique(row * len(idf) + ids[at], return_counts=True)
    row, word = np.divmod(key, len(idf))
    row = np.unique(row, return_inverse=True)[1]
    value = count * idf[word]
    return row, word, value / np.sqrt(np.bincount(row, value ** 2))[row]


def _gram_product(row, word, value, omega: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, their rows of A'A Omega)."""
    if not len(row):
        return np.empty(0, np.int64), np.empty((0, omega.shape[1]))
    cuts = [0]
    while cuts[-1] < len(row):  # whole rows at a time
        end = min(cuts[-1] + _NONZERO, len(row))
        cuts.append(int(np.searchsorted(row, row[end - 1], "right")))
    words = np.unique(word)
    total = np.zeros((len(words), omega.shape[1]))
    for a, b in zip(cuts, cuts[1:]):
        r, w, v = row[a:b] - row[a], word[a:b], value[a:b, None]
        y = np.add.reduceat(v * omega[w], np.flatnonzero(np.r_[True, r[1:] != r[:-1]]))
        r = np.cumsum(np.r_[0, r[1:] != r[:-1]])
        by = np.argsort(w, kind="stable")
        head = np.flatnonzero(np.r_[True, np.diff(w[by]) != 0])
        total[np.searchsorted(words, w[by][head])] += np.add.reduceat((v * y[r])[by], head)
    return words, total


def _nystroem(product: np.ndarray, omega: np.ndarray, rank: int) -> np.ndarray:
    """Leading eigenvectors of the Gram matrix from one product with Omega."""
    shift = 1e-9 * (np.linalg.norm(product) or 1.0)
    y = product + shift * omega
    core = omega.T @ y
    low = np.linalg.cholesky((core + core.T) / 2 + 1e-9 * np.trace(core) / len(core) * np.eye(len(core)))
    return np.linalg.svd(np.linalg.solve(low, y.T).T, full_matrices=False)[0][:, :rank]


class Finder:
    """Search and checks for one block of the benchmark."""

    def __init__(self, items: list[tuple[int, list[int], int]], space: Space):
        self.space = space
        self.scales: dict[int, list[int]] = {}
        self.items = []
        vectors = []
        for n, (item_id, ids, answer) in enumerate(items):
            end = ids[len(ids) - answer:]
            parts = (ids, [w for w in ids if space.telling[w]], end, [w for w in end if space.telling[w]])
            self.items.append((item_id, *((_masks(x), len(x)) for x in parts)))
            vectors.append(space.latent[ids].sum(axis=0))
            if ids:
                self.scales.setdefault(max(16, 1 << (len(ids) - 1).bit_length()), []).append(n)
        self.vectors = np.array(vectors, np.float32).reshape(len(items), -1)
        self.norms = np.linalg.norm(self.vectors, axis=1)

    def batch(self, raw: pd.Series) -> list[list[dict]]:
        ids, sizes = unpack(raw, self.space.kind)
        out: list[dict[int, dict]] = [{} for _ in sizes]
        start = np.cumsum(sizes) - sizes
        at = np.flatnonzero(self.space.idf[ids] > 0)
        doc = np.searchsorted(start, at, "right") - 1
        for length, members in self.scales.items():
            members = [m for m in members if self.norms[m] > 0]
            if not members or not len(at):
                continue
            half = length // 2
            halves = sizes // half + 2  # two more than are used, so windows never cross documents
            first = np.cumsum(halves) - halves
            block = first[doc] + (at - start[doc]) // half
            head = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            used = block[head]
            for a in range(0, len(used), _NONZERO // 4):
                b = min(a + _NONZERO // 4, len(used))
                # one more block on each side, which windows at the border share
                lo, hi = max(a - 1, 0), min(b + 1, len(used))
                end = head[hi] if hi < len(used) else len(at)
                sums = np.add.reduceat(self.space.latent[ids[at[head[lo]:end]]], head[lo:hi] - head[lo])
                self._windows(ids, sizes, start, first, half, used[lo:hi], sums, (used[a], used[b - 1]), members, out)
        return [sorted(d.values(), key=lambda x: x["item_id"]) for d in out]

    def _windows(self, ids, sizes, start, first, half, used, sums, span, members, out) -> None:
        """Windows are pairs of consecutive blocks; ``used`` has those with content."""
        left = np.unique(np.concatenate([used, used - 1]))
        left = left[(left >= span[0] - 1) & (left <= span[1])]
        at = np.searchsorted(used, left)
        vec = np.zeros((len(left), sums.shape[1]), np.float32)
        for shift in (0, 1):
            at = np.minimum(np.searchsorted(used, left + shift), len(used) - 1)
            hit = used[at] == left + shift
            vec[hit] += sums[at[hit]]
        norm = np.linalg.norm(vec, axis=1)
        by = np.argsort(norm, kind="stable")
        # a window can cover items up to its own weight over COVER: items in order of
        # weight, and for each chunk the windows that are heavy enough for its lightest
        members = sorted(members, key=lambda m: self.norms[m])
        for c in range(0, len(members), ITEMS_AT_ONCE):
            some = members[c:c + ITEMS_AT_ONCE]
            own = self.norms[some]
            heavy = np.sort(by[np.searchsorted(norm[by], COVER * own.min() - 1e-6):])
            if not len(heavy):
                break
            self._pairs(ids, sizes, start, first, half, left[heavy], vec[heavy], norm[heavy], some, own, out)

    def _pairs(self, ids, sizes, start, first, half, left, vec, norm, members, own, out) -> None:
        """Candidates among windows and items by one product, and their checks."""
        dot = vec @ self.vectors[members].T
        w, k = np.nonzero((dot >= COSINE * norm[:, None] * own) & (dot >= COVER * own ** 2))
        docs = np.searchsorted(first, left[w], "right") - 1
        for n in range(len(w)):
            d, member = int(docs[n]), members[k[n]]
            item_id, *parts = self.items[member]
            begin = int(left[w[n]] - first[d]) * half
            if begin < 0 or begin >= sizes[d]:
                continue
            margin = half // 2
            a, b = max(begin - margin, 0), int(min(begin + 2 * half + margin, sizes[d]))
            region = ids[start[d] + a:start[d] + b].tolist()

            def held(part, size):
                return lcs(part, size, region) / size if size else 1.0
            share = min(held(*parts[0]), held(*parts[1]))
            if share < LOOSE:
                continue
            answered = min(held(*parts[2]), held(*parts[3]))
            if share < EXACT and (answered < ANSWER or parts[1][1] < TELLING):
                continue
            old = out[d].get(member)
            if old is None or (share, answered) > (old["lcs_share"], old["answer_share"]):
                cosine = float(dot[w[n], k[n]]) / (float(norm[w[n]]) * float(own[k[n]]))
                out[d][member] = {"item_id": item_id, "cosine": round(min(cosine, 1.0), 6), "lcs_share": share,
                                  "answer_share": answered, "start": a, "end": b}


def _fit(coded: DataFrame, items: DataFrame, vocabulary: int, kind: str) -> Space:
    """The space of all documents and all items, both as ``ids``."""
    @freeing
    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(vocabulary + 1, np.int64), 0
        for part in batches:
            ids, sizes = unpack(part["ids"], kind)
            doc = np.repeat(np.arange(len(sizes)), sizes)[ids > 0]
            df += np.bincount(np.unique(doc * (vocabulary + 1) + ids[ids > 0]) % (vocabulary + 1), minlength=vocabulary + 1)
            n += len(sizes)
        df[0] = n
        w = np.flatnonzero(df)
        yield pd.DataFrame({"word": w, "n": df[w]})

    counted = coded.select("ids").mapInPandas(frequencies, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    df = np.zeros(vocabulary + 1)
    for r in counted.collect():  # one row per benchmark word
        df[r["word"]] = r["n"]
    docs, df[0] = df[0], np.inf
    idf = np.log((docs + 1) / np.maximum(df + 0.5, 0.5).clip(max=1e18))
    keep, telling = df <= MAX_DF * docs, df <= TELLING_DF * docs

    def rarest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stay = np.zeros(vocabulary + 1, bool)
        for part in batches:
            for raw in part["ids"]:
                own = sorted(set(np.frombuffer(raw, kind).tolist()), key=lambda w: (df[w], w))[:RAREST[1]]
                stay[[w for n, w in enumerate(own) if n < RAREST[0] or telling[w]]] = True
        yield pd.DataFrame({"word": np.flatnonzero(stay)})

    for r in items.select("ids").mapInPandas(rarest, "word long").distinct().collect():  # benchmark words at most
        keep[r["word"]] = True
    idf = np.where(keep, np.maximum(idf, 0.1), 0.0)
    idf[0] = 0.0

    words = np.flatnonzero(idf)
    column = np.zeros(len(idf), np.int64)
    column[words] = np.arange(len(words))
    width = min(RANK + EXTRA, len(words))
    if width == len(words):  # the space of the words itself
        latent = np.zeros((len(idf), width), np.float32)
        latent[words, column[words]] = idf[words]
        return Space(kind, idf, telling, latent)
    omega = np.zeros((len(idf), width))
    omega[words] = np.linalg.qr(np.random.default_rng(11).standard_normal((len(words), width)))[0]

    @freeing
    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = {}, 0
        for part in batches:
            ids, sizes = unpack(part["ids"], kind)
            row, word, value = _rows(ids, sizes, idf)
            rows += row[-1] + 1 if len(row) else 0
            for w, v in zip(*_gram_product(row, word, value, omega)):
                total[int(w)] = total.get(int(w), 0) + v
        yield pd.DataFrame({"word": [0, *total], "v": [np.full(1, float(rows)).tobytes(),
                                                      *(v.astype("<f8").tobytes() for v in total.values())]})

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for part in batches:
            for w, v in zip(part["word"], part["v"]):
                total[w] = total.get(w, 0) + np.frombuffer(v)
        yield pd.DataFrame({"word": list(total), "v": [v.tobytes() for v in total.values()]})

    def product_of(rows: DataFrame) -> tuple[np.ndarray, float]:
        out, count = np.zeros((len(idf), width)), 0.0
        for r in (rows.select("ids").mapInPandas(products, "word long, v binary").repartition("word")
                  .mapInPandas(summed, "word long, v binary").collect()):  # one row per word that is kept
            if r["word"]:
                out[r["word"]] = np.frombuffer(r["v"])
            else:
                count = float(np.frombuffer(r["v"])[0])
        return out, count

    product, rows = product_of(coded)
    # benchmark items are passages too, with as much weight as those of the corpus together
    own, passages = product_of(items)
    product += own * (max(rows, 1.0) / max(passages, 1.0))
    latent = np.zeros((len(idf), min(RANK, width)), np.float32)
    latent[words] = _nystroem(product[words], omega[words], RANK) * idf[words, None]
    return Space(kind, idf, telling, latent)


@dataclass
class Search:
    """What one block of the benchmark is searched with."""
    vocabulary: dict[str, int]
    finder: Finder

    def leaks(self, ids: Column) -> Column:
        finder = self.finder

        bounded_batches()

        @F.pandas_udf(LEAKS)
        @freeing
        def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                yield pd.Series(finder.batch(s), dtype=object)
        return found(ids)


def searches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str | None = None,
             block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[Search, DataFrame]]:
    """For each block of the benchmark: its search, and the coded documents
    (``id_col``, where given, and ``ids``). All blocks share vocabulary and space."""
    items = benchmark.select("item_id", "text").where("text is not null and item_id is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(1.25 * size / block_bytes))

    @F.pandas_udf("array<string>")
    def distinct_words(s: pd.Series) -> pd.Series:
        return s.map(lambda t: sorted(set(words_of(t)))).astype(object)

    found = items.select(F.explode(distinct_words("text")).alias("w")).distinct()
    vocabulary = {w: n + 1 for n, w in enumerate(sorted(r["w"] for r in found.collect()))}  # words, not items
    if not vocabulary:
        return
    kind = "<u2" if len(vocabulary) < 1 << 16 else "<u4"
    own = [F.col(id_col).alias("_id")] if id_col else []
    coded = cut(docs.select(*own, encode(F.col(text_col), vocabulary).alias("ids")))
    coded_items = cut(items.select("item_id", "text", encode(F.col("text"), vocabulary).alias("ids")).where(F.octet_length("ids") > 0))
    space = _fit(coded, coded_items, len(vocabulary), kind)
    for k in range(blocks):
        block = coded_items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        rows = sorted((r["item_id"], np.frombuffer(r["ids"], kind).tolist(), answer_words(r["text"])) for r in block.collect())
        if rows:
            yield Search(vocabulary, Finder(rows, space)), coded


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row and leaked item: ``id_col``, ``item_id``,
    ``cosine``, ``lcs_share``, ``answer_share`` and the words [start_word,
    end_word) in which it was found.

    Null and empty texts and items have no leaks; repeated rows each get their
    rows; items with one id and several texts count by text; a null id is kept.
    """
    out = docs.sparkSession.createDataFrame([], f"{id_col} {dict(docs.dtypes)[id_col]}, item_id long, cosine double, "
                                                "lcs_share double, answer_share double, start_word int, end_word int")
    for search, coded in searches(docs, benchmark, text_col, id_col):
        found = coded.select(F.col("_id"), F.explode(search.leaks(F.col("ids"))).alias("x"))
        out = out.unionByName(found.select(F.col("_id").alias(id_col), "x.item_id", "x.cosine", "x.lcs_share",
                                           "x.answer_share", F.col("x.start").alias("start_word"),
                                           F.col("x.end").alias("end_word")))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a leak, columns as they were."""
    row = None
    for search, _ in searches(docs, benchmark, text_col):
        if row is None:  # one vocabulary, so texts are encoded once
            row = docs.select(F.struct(*docs.columns).alias("_row"), encode(F.col(text_col), search.vocabulary).alias("_ids"))
        row = row.where(F.size(search.leaks(F.col("_ids"))) == 0)
    return docs if row is None else row.select("_row.*")
