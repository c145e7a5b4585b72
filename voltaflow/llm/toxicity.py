"""Toxicity: a counterfactually regularised linear classifier.

*Features* of a text are the hashed words and word beginnings (3 to 6 letters)
it holds, each counted once. *Training* takes a bounded sample of labelled rows
(``SAMPLE`` per label, by a hash of the id): Spark counts the features by label
over the sample and keeps the ``FEATURES`` with the strongest association; the
driver fits a logistic regression on the sample's sparse rows. Both weigh the
rows of a label by what the sample leaves out of it, so scores follow the true
share of toxic rows whatever the size of the table. Beside L2, the
loss penalises the squared change of the logit when the identity terms of a
labelled text are swapped for others of their category, so neutral mentions of
a group don't carry weight. Nothing but the text is an input of a score.
*Scoring* is a pass over whole texts with the small model shipped along.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaflow.llm.common import bounded_batches, cut, freeing

#: Labelled rows of label 0 and of label 1 that training takes at most.
SAMPLE = (10_000, 5_000)
#: Features that the model keeps at most.
FEATURES = 1_500
HASH_BITS = 20
#: Weight of L2, of the counterfactual penalty, and steps of the optimiser.
L2, SWAP, STEPS = 2e-5, 1.0, 400
#: Words a worker remembers; beyond it the memory starts anew.
REMEMBERED = 150_000

# Identity terms by category; a term is swapped for the next of its category.
IDENTITY = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("man", "woman"), ("men", "women"), ("male", "female"), ("he", "she"), ("his", "her"),
    ("mexican", "american", "chinese", "indian", "german", "french", "spanish", "turkish", "russian"),
    ("immigrant", "refugee", "native"), ("immigrants", "refugees", "natives"),
    ("deaf", "blind", "disabled"), ("old", "young"),
    ("mann", "frau"), ("christ", "moslem", "jude"), ("homme", "femme"), ("hombre", "mujer"),
)
NEXT = {t: c[(k + 1) % len(c)] for c in IDENTITY for k, t in enumerate(c)}
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(word: str) -> tuple[int, ...]:
    """Hashed features of a word: itself and its beginnings."""
    names = [f"={word}", *(f"^{word[:k]}" for k in range(3, 7) if len(word) >= k)]
    return tuple(zlib.crc32(n.encode("utf-8", "surrogatepass")) & (1 << HASH_BITS) - 1 for n in names)


@dataclass
class Model:
    bias: float
    weights: dict[int, float]

    def logit(self, words: set[str], known: dict[str, tuple[int, ...]]) -> float:
        """``known`` remembers the weighted features of words."""
        hit: set[int] = set()
        for w in words:
            own = known.get(w)
            if own is None:
                if len(known) > REMEMBERED:
                    known.clear()
                own = known[w] = tuple(f for f in features_of(w) if f in self.weights)
            if own:
                hit.update(own)
        return self.bias + sum(self.weights[f] for f in sorted(hit))


def fit(rows: list[np.ndarray], swapped: list[np.ndarray], labels: np.ndarray, kept: np.ndarray,
        l2: float = L2, swap: float = SWAP, steps: int = STEPS, weights: tuple[float, float] = (1.0, 1.0)) -> Model:
    """Logistic regression by Adam on sparse 0/1 rows; ``swapped`` are the
    rows' counterfactuals, ``weights`` the weight of a row of label 0 and 1.
    Without both labels, the score is the smoothed share of label 1 for every
    text."""
    n, ones = len(labels), float(labels.sum())
    each = np.where(labels == 1, weights[1], weights[0])
    total, heavy = each.sum(), float((each * labels).sum())
    prior = (heavy + 0.5) / (total + 1.0)
    if not 0 < ones < n or not len(kept):
        return Model(float(np.log(prior / (1 - prior))) if n else -20.0, {})

    def sparse(some: list[np.ndarray]):
        size = np.array([len(r) for r in some])
        col = np.searchsorted(kept, np.concatenate(some)) if size.sum() else np.empty(0)
        return np.repeat(np.arange(len(some), dtype=np.int32), size), col.astype(np.int32)

    at, col = sparse(rows)
    sat, scol = sparse(swapped)
    d = len(kept)
    w = np.r_[np.zeros(d), np.log(prior / (1 - prior))]
    m, v = np.zeros(d + 1), np.zeros(d + 1)
    for step in range(1, steps + 1):
        z = np.bincount(at, w[col], n)
        change = z - np.bincount(sat, w[scol], n)
        p = 1 / (1 + np.exp(-np.clip(z + w[d], -40, 40)))
        err, pair = each * (p - labels) / total, 2 * swap * each * change / total
        grad = np.r_[np.bincount(col, (err + pair)[at], d) - np.bincount(scol, pair[sat], d) + 2 * l2 * w[:d], err.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        w -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return Model(float(w[d]), {int(f): float(x) for f, x in zip(kept, w[:d]) if x})


def held_out(doc_id: Column) -> Column:
    """Ids that training never sees: crc32 of the id as text is 0 modulo 5. A
    null id is held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: tuple[int, int] = SAMPLE, features: int = FEATURES,
          swap: float = SWAP) -> Model:
    """Fit on a bounded sample of the labelled rows that aren't held out.

    A label other than 0 or 1 is ignored; an id with both labels counts as 1.
    The sample's ids are at most ``sum(sample)``, which bounds the broadcast.
    """
    spark = docs.sparkSession
    named = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label")))
    order = [F.xxhash64(F.lit(7), "_id"), "_id"]
    chosen = [named.where(F.col("_label") == k).orderBy(*order).limit(n) for k, n in enumerate(sample)]
    ids = chosen[0].unionByName(chosen[1])  # at most sum(sample) rows
    every = {r["_label"]: r["n"] for r in named.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # ids are chosen by hash, so a label's rows stand for as many others as its ids do
    scale = [max(1.0, every.get(k, 0) / n) if n else 1.0 for k, n in enumerate(sample)]

    bounded_batches()

    @F.pandas_udf("struct<own: array<int>, swapped: array<int>>")
    @freeing
    def featured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def hashed(words):
            return sorted({f for w in words for f in features_of(w)})
        for s in batches:
            words = [words_of(t) for t in s]
            yield pd.DataFrame({"own": [hashed(w) for w in words],
                                "swapped": [hashed({NEXT.get(x, x) for x in w}) if not NEXT.keys().isdisjoint(w)
                                            else None for w in words]})

    rows = cut(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
               .join(F.broadcast(ids), "_id")
               .select("_id", "_label", F.xxhash64("_text").alias("_hash"), featured("_text").alias("f"))
               .select("_id", "_label", "_hash", "f.*"))
    totals = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        return fit([], [], np.r_[np.zeros(min(n0, 1)), np.ones(min(n1, 1))], np.empty(0, np.int64))
    counts = (rows.select("_label", F.explode("own").alias("feature")).groupBy("feature")
              .agg(F.sum("_label").alias("b"), F.sum(1 - F.col("_label")).alias("a")).where("a + b >= 3"))
    n0, n1 = n0 * scale[0], n1 * scale[1]
    a, b = F.col("a") * F.lit(scale[0]), F.col("b") * F.lit(scale[1])
    chi = (F.pow(b * (n0 - a) - a * (n1 - b), F.lit(2.0)) / ((a + b) * (n0 + n1 - a - b) + 1.0))
    kept = np.array(sorted(r[0] for r in counts.orderBy(chi.desc(), "feature").limit(features)
                           .select("feature").collect()), np.int64)
    best = spark.sparkContext.broadcast(kept)

    # both lists in one call: a second one would take another Python worker a task
    @F.pandas_udf("struct<own: array<int>, swapped: array<int>>")
    @freeing
    def of_kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        def held(s):
            return pd.Series([None if f is None else np.intersect1d(f, best.value).astype(np.int32) for f in s], dtype=object)
        for own, swapped in batches:
            yield pd.DataFrame({"own": held(own), "swapped": held(swapped)})

    # rows of repeated ids can be many; the bound of the sample holds for rows as well
    got = (rows.select("_label", "_hash", of_kept("own", "swapped").alias("f")).select("_label", "_hash", "f.*")
           .orderBy(F.xxhash64(F.lit(7), "_hash"), "_label").limit(sum(sample)).toPandas())
    own = [np.asarray(x, np.int64) for x in got["own"]]
    other = [x if y is None else np.asarray(y, np.int64) for x, y in zip(own, got["swapped"])]
    y = got["_label"].to_numpy(float)
    weights = n0 / max(1, int((y == 0).sum())), n1 / max(1, int((y == 1).sum()))
    return fit(own, other, y, kept, swap=swap, weights=weights)


def score(text: Column, model: Model) -> Column:
    """Score from 0 to 1 of a text column; a null text is scored as an empty one."""
    bounded_batches()

    @F.pandas_udf("double")
    @freeing
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple[int, ...]] = {}
        for s in batches:
            z = np.array([model.logit(words_of(t), known) for t in s], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -40, 40))))
    return scored(text)
