"""SimHash near-duplicate groups by a Gray-order hierarchical index.

1. *Fingerprint.* Each bit of a text's 64-bit fingerprint is the majority of
   that bit over the XXH64 values of all its word shingles (whole text,
   repeats included). This is a numpy kernel over Arrow batches.
2. *Upper index nodes.* The 64 bits are cut into ``max_bits + agree`` blocks.
   Two fingerprints within ``max_bits`` agree on at least ``agree`` whole
   blocks, so each choice of ``agree`` blocks is a bit mask, and each masked
   pattern is an upper node of the index. A Spark shuffle deals the distinct
   fingerprints to these nodes; no other pair can be within the distance.
3. *Below a node*, the fingerprints are sorted by Gray rank and cut into
   leaves. Each inner node keeps the bits all its members share. A walk over
   pairs of nodes adds up the shared bits in which they differ and drops whole
   groups once the sum is over ``max_bits``. Pairs that are already in one
   component are dropped as well, so a dense family of copies isn't compared
   pair by pair. What a node emits is a spanning forest, never all pairs.
4. *Hot nodes* (more than ``node_rows`` distinct fingerprints) are dealt out
   as pairs of blocks, so no task holds more than two blocks of one node.
5. Components of the forest's edges give each document its group.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaflow.llm.common import bounded_batches, components, cut, freeing, min_labels

SEED = 42
WORDS = 4
MAX_BITS = 4
#: Whole blocks on which two fingerprints within the distance must agree.
AGREE = 2
#: Distinct fingerprints of one upper node that a task takes at once.
NODE_ROWS = 20_000
FANOUT = 16
_STEP = 1 << 16
#: Node pairs that one step of the walk expands.
_PAIRS = 1 << 12


def fingerprint_of(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The signed 64-bit fingerprint; a text without words (or null) has 0."""
    # bytes.lower() maps A-Z only; bytes.split() splits at space and \t\n\v\f\r
    toks = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not toks:
        return 0
    joined = b" ".join(toks)
    size = np.fromiter(map(len, toks), np.int64, len(toks))
    end = np.cumsum(size + 1) - 1
    width = min(words, len(toks))
    start, end = (end - size)[: len(toks) - width + 1], end[width - 1:]
    ones, total, digest = np.zeros(64, np.int64), len(start), xxhash.xxh64_intdigest
    for at in range(0, total, _STEP):
        h = np.fromiter((digest(joined[a:b], seed) for a, b in
                         zip(start[at:at + _STEP].tolist(), end[at:at + _STEP].tolist())), "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, words: int = WORDS, seed: int = SEED) -> Column:
    """Fingerprint column (bigint) of a text column."""
    bounded_batches()

    @F.pandas_udf("long")
    @freeing
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([fingerprint_of(t, words, seed) for t in s], dtype="int64")
    return fp(text)


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code word in the reflected Gray sequence."""
    r = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def block_masks(max_bits: int, agree: int = AGREE) -> list[int]:
    """Bit masks of every choice of ``agree`` out of ``max_bits + agree`` blocks."""
    m = max_bits + agree
    if m > 64:
        raise ValueError("max_bits + agree is at most 64")
    cuts = [64 * k // m for k in range(m + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    return [sum(block[k] for k in some) for some in itertools.combinations(range(m), agree)]


def _upper(shared: np.ndarray, pattern: np.ndarray, low: np.ndarray, high: np.ndarray, gid: np.ndarray):
    """Fold runs of FANOUT nodes of one group into parents."""
    new = np.r_[True, gid[1:] != gid[:-1]]
    first = np.flatnonzero(new)
    pos = np.arange(len(gid)) - np.repeat(first, np.diff(np.r_[first, len(gid)]))
    head = np.flatnonzero(new | (pos % FANOUT == 0))
    every = np.bitwise_and.reduceat(pattern, head)
    some = np.bitwise_or.reduceat(pattern, head)
    keep = np.bitwise_and.reduceat(shared, head) & (every | ~some)
    return (keep, every & keep, np.minimum.reduceat(low, head), np.maximum.reduceat(high, head), gid[head],
            np.r_[head, len(gid)])


def forest(fp: np.ndarray, gid: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, root), as indices, of the components that links of
    at most ``max_bits`` make inside each group. ``gid`` is sorted."""
    n = len(fp)
    order = np.lexsort((gray_rank(fp), gid))
    x, g = fp[order], gid[order]
    a_all, b_all = [], []
    for k in range(1, min(FANOUT, n)):  # neighbours in Gray order
        same = g[k:] == g[:-k]
        if not same.any():
            break
        near = np.flatnonzero(same & (np.bitwise_count(x[k:] ^ x[:-k]) <= max_bits))
        a_all.append(near), b_all.append(near + k)
    a, b = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (a_all, b_all))
    lab = min_labels(n, a, b)
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    if np.diff(np.r_[first, n]).max(initial=0) > FANOUT:  # larger groups get a tree
        big = np.repeat(np.diff(np.r_[first, n]) > FANOUT, np.diff(np.r_[first, n]))
        at = np.flatnonzero(big)
        ea, eb = _walk(x[at], g[at], lab[at], max_bits)
        lab = min_labels(n, np.concatenate([a, at[ea]]), np.concatenate([b, at[eb]]))
    member = np.flatnonzero(lab != np.arange(n))
    return order[member], order[lab[member]]


def _walk(x: np.ndarray, g: np.ndarray, lab: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that the Gray-order tree finds between components known so far."""
    levels = [(np.full(len(x), ~np.uint64(0)), x, lab, lab, g, None)]
    while (levels[-1][4][1:] == levels[-1][4][:-1]).any():
        levels.append(_upper(*levels[-1][:5]))
    out_a, out_b = [], []
    now = lab.copy()
    top = len(levels) - 1
    roots = np.arange(len(levels[top][0]))
    stack = [(top, roots, roots)]
    while stack:
        level, p, q = stack.pop()
        if len(p) > _PAIRS:  # bounds the memory of one step; later parts see links found by earlier ones
            stack += [(level, p[k:k + _PAIRS], q[k:k + _PAIRS]) for k in range(0, len(p), _PAIRS)]
            continue
        shared, pattern, low, high, _, _ = levels[level]
        if level == 0:
            ok = (now[p] != now[q]) & (np.bitwise_count(pattern[p] ^ pattern[q]) <= max_bits)
            if ok.any():
                out_a.append(p[ok]), out_b.append(q[ok])
                roots_now, inverse = np.unique(np.concatenate([now[p[ok]], now[q[ok]]]), return_inverse=True)
                k = ok.sum()
                to = roots_now[min_labels(len(roots_now), inverse[:k], inverse[k:])]
                at = np.searchsorted(roots_now, now)
                at[at == len(roots_now)] = 0
                hit = roots_now[at] == now
                now[hit] = to[at[hit]]
                for j in range(1, len(levels)):  # which subtrees are one component by now
                    head = levels[j][5]
                    lo, hi = (now, now) if j == 1 else (levels[j - 1][2], levels[j - 1][3])
                    levels[j] = (*levels[j][:2], np.minimum.reduceat(lo, head[:-1]), np.maximum.reduceat(hi, head[:-1]),
                                 *levels[j][4:])
            continue
        differ = np.bitwise_count((pattern[p] ^ pattern[q]) & shared[p] & shared[q])
        one = (low[p] == high[p]) & (low[q] == high[q]) & (low[p] == low[q])
        ok = (differ <= max_bits) & ~one
        p, q, head = p[ok], q[ok], levels[level][5]
        kids_p, kids_q = head[p + 1] - head[p], head[q + 1] - head[q]
        pairs = kids_p * kids_q
        which = np.repeat(np.arange(len(p)), pairs)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        cp, cq = head[p[which]] + nth // kids_q[which], head[q[which]] + nth % kids_q[which]
        once = (cp < cq) | ((cp == cq) & (level > 1))
        if once.any():
            stack.append((level - 1, cp[once], cq[once]))
    none = np.empty(0, np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def links(fps: DataFrame, max_bits: int = MAX_BITS, agree: int = AGREE, node_rows: int = NODE_ROWS) -> DataFrame:
    """Edges ``(u, v)`` that connect the distinct values of ``fps(fp)`` just as
    all links of at most ``max_bits`` differing bits do."""
    masks = block_masks(max_bits, agree)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    nodes = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("pattern"))
        for k, m in enumerate(signed)])).alias("node")).select("fp", "node.*")
    hot = (nodes.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > node_rows)
           .select("mask", "pattern", F.ceil(F.col("n") / node_rows).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (nodes.join(hot, ["mask", "pattern"], "left")
             .withColumn("own", F.coalesce(own, F.lit(0)))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1)))
             .select("mask", "pattern", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"))
    keys = ["mask", "pattern", "lo", "hi"]

    @freeing
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for part in itertools.chain(batches, [None]):
            if part is not None:
                part = part if rest is None else pd.concat([rest, part], ignore_index=True)
                rest = part
                if not len(part):
                    continue
            if rest is None or not len(rest):
                continue
            new = np.zeros(len(rest), bool)
            for k in keys:
                v = rest[k].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            gid = np.cumsum(new)
            whole = gid < gid[-1] if part is not None else np.ones(len(rest), bool)  # the last group may go on
            fp, own_gid = rest["fp"].to_numpy()[whole], gid[whole]
            rest = rest[~whole].reset_index(drop=True)
            if len(fp):
                a, b = forest(fp.view(np.uint64), own_gid, max_bits)
                if len(a):
                    yield pd.DataFrame({"u": fp[a], "v": fp[b]})

    return (dealt.repartition(*keys).sortWithinPartitions(*keys)
            .mapInPandas(walk, "u long, v long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    max_bits: int = MAX_BITS, agree: int = AGREE, node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per input row: ``id_col``, ``fingerprint`` (16 hex digits),
    ``component_id`` (smallest id reachable by links, its own included),
    ``group_fp`` (the same group, named by its smallest signed fingerprint) and
    ``text_hash`` (XXH64 of the text, for joining back).

    Null and empty texts have fingerprint zero and are linked like any other.
    Rows with equal ids each get a row. A null id is never the smallest unless
    the whole group has null ids. Other columns of ``docs`` are not read. An
    empty table gives an empty result.
    """
    rows = cut(docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                           fingerprint(F.col(text_col), words).alias("fp")))
    distinct = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(distinct.select("fp"), max_bits, agree, node_rows))
    member = cut(distinct.join(roots, distinct["fp"] == roots["node"], "left")
                 .select("fp", "least", F.coalesce("root", "fp").alias("group_fp")))
    group = member.groupBy("group_fp").agg(F.min("least").alias("component_id"))
    named = member.select("fp", "group_fp").join(group, "group_fp")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), hexed(F.col("fp")).alias("fingerprint"),
                                         "component_id", "group_fp", "text_hash")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group: the
    one with the smallest id. Columns and their order stay.

    Of repeated rows with the kept id in one group, one stays. A group whose
    ids are all null keeps one row. The texts cross the network once; the
    repeated-row check reuses that partitioning.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    kept = (near_duplicates(docs, id_col, text_col, **options)
            .where(F.col(id_col).eqNullSafe(F.col("component_id")))
            .select(key.alias("_key"), F.col("text_hash").alias("_hash"), F.col("group_fp").alias("_group")).distinct())
    mine = docs.select(F.struct(*docs.columns).alias("_row"), key.alias("_key"),
                       F.xxhash64(F.col(text_col)).alias("_hash"))
    first = F.row_number().over(Window.partitionBy("_key", "_group").orderBy("_hash"))
    return (mine.join(kept, (mine["_key"] == kept["_key"]) & (mine["_hash"] == kept["_hash"]))
            .select("_row", mine["_key"], "_group", mine["_hash"]).withColumn("_first", first)
            .where("_first = 1").select("_row.*"))
