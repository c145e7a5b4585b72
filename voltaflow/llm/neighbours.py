"""Approximate nearest neighbours by inner product, with balanced posting lists.

1. Equal vectors are searched once: an index entry is a distinct vector with
   its ``k + 1`` smallest ids. More copies can't be among anyone's ``k``
   nearest, so nothing is lost, and a vector that a third of the rows share is
   no hot list.
2. *Bands.* Inner product becomes distance by one more component that brings all
   vectors to one norm. A few very long vectors would make all others look alike,
   so vectors of the same power of two of their norm are a band of their own, brought to the
   largest norm of the band. All geometry is in double precision, on vectors
   divided by that norm.
3. *Balanced lists.* The centroids of a band are fitted on a hash-chosen sample
   (about ``SAMPLE`` vectors over all bands) by splitting clusters again and
   again with a size penalty, until a list is expected to hold ``LIST_ROWS``.
4. *Graph.* Vectors and queries find their lists by search over an in-memory
   neighbour graph of the band's centroids. There are at most ``MAX_LISTS`` and
   one for each band, which bounds what is broadcast; beyond ``MAX_LISTS * LIST_ROWS``
   vectors the lists grow instead, and a visit costs more.
5. *Boundary vectors* go to every list whose centroid is at most ``REPLICATE``
   times as far as the nearest one, up to ``REPLICAS`` lists.
6. *Search.* A query visits, in each band, the lists whose centroid is at most ``probe`` times
   as far as the nearest one: the beam of the graph search is doubled until it
   ends beyond that. If the lists hold fewer than ``k + 1`` vectors, farther ones follow,
   nearest first, until they do. The ratio is measured: the true neighbours of up to
   ``TUNE`` queries, by products with all vectors, tell which ratio reaches
   ``RECALL`` of them; it is ``PROBE`` at least.
7. Neighbouring lists are searched as a group of up to ``GROUP_ROWS`` vectors: a query is sent
   once to a group, not once to each list, and a group returns its best entries
   only. Groups, and groups with many queries, are dealt out in blocks. Scores
   are exact products of the original vectors in double precision; only the
   choice of lists is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaflow.llm.common import cut

NEAREST = 20
LIST_ROWS = 4096
MAX_LISTS = 16_384
SAMPLE = 200_000
PER_LIST = 64  # sampled vectors for each list
REPLICATE, REPLICAS = 1.10, 4
PROBE = 1.16
#: Queries whose true neighbours are looked up, and the share of these that must be reached.
TUNE, RECALL = 256, 0.99
BEAM = 32
DEGREE = 24
#: Vectors of the lists that are searched together, and vectors or queries that a task takes at once.
GROUP_ROWS = 131_072
BLOCK_ROWS = 32_768


def _balanced_split(x: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Labels of a k-means in which crowded clusters are made to look farther."""
    centre = x[rng.choice(len(x), parts, replace=False)].copy()
    penalty, label = np.zeros(parts), None
    for _ in range(12):
        d = ((centre ** 2).sum(axis=1) - 2 * x @ centre.T)
        scale = max(float(d.std()), 1e-12)
        label = np.argmin(d + penalty * scale, axis=1)
        size = np.bincount(label, minlength=parts)
        penalty += 0.3 * (size * parts / len(x) - 1)
        total = np.zeros_like(centre)
        np.add.at(total, label, x)
        centre[size > 0] = total[size > 0] / size[size > 0, None]
    return label


def centroids(x: np.ndarray, lists: int, seed: int = 3) -> np.ndarray:
    """About ``lists`` centroids of nearly equally large clusters."""
    rng = np.random.default_rng(seed)
    target, todo, out = max(1.0, len(x) / max(lists, 1)), [np.arange(len(x))], []
    while todo:
        own = todo.pop()
        parts = min(8, round(len(own) / target), len(own))
        label = _balanced_split(x[own], parts, rng) if parts > 1 else None
        if label is None or (label == label[0]).all():
            out.append(x[own].mean(axis=0))
        else:
            todo += [own[label == p] for p in range(parts) if (label == p).any()]
    return np.array(out)


@dataclass
class Graph:
    """Centroids with their neighbour graph."""
    centre: np.ndarray
    near: np.ndarray

    @classmethod
    def build(cls, centre: np.ndarray, degree: int = DEGREE, seed: int = 5) -> Graph:
        n = len(centre)
        k, norm = min(degree, n - 1), (centre ** 2).sum(axis=1)
        near = np.zeros((n, k), np.int64)
        for a in range(0, n, 1024):
            d = norm - 2 * centre[a:a + 1024] @ centre.T
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
            near[a:a + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k] if k else near[a:a + 1024]
        # a few far links, so that every part of the graph can be reached
        far = np.random.default_rng(seed).integers(0, n, (n, min(4, n)))
        far = np.concatenate([far, ((np.arange(n) + 1) % n)[:, None]], axis=1)
        return cls(centre, np.concatenate([near, far], axis=1))

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids found for each query (nearest first) and their
        distances; entries beyond what was found are -1 and infinite."""
        n, rows = len(self.centre), np.arange(len(q))
        beam = min(beam, n)
        norm, own = (self.centre ** 2).sum(axis=1), (q ** 2).sum(axis=1)
        start = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(np.int64))
        ids = np.full((len(q), beam), -1)
        dist = np.full((len(q), beam), np.inf)
        done = np.ones((len(q), beam), bool)
        seen = np.zeros((len(q), n), bool)
        fresh = np.broadcast_to(start, (len(q), len(start)))
        while True:
            new = np.sort(fresh, axis=1)
            new = np.where((np.diff(new, axis=1, prepend=-1) == 0) | (new < 0) | seen[rows[:, None], np.maximum(new, 0)], -1, new)
            at = np.maximum(new, 0)
            d = own[:, None] + norm[at] - 2 * np.einsum("qd,qkd->qk", q, self.centre[at])
            d[new < 0] = np.inf
            seen[rows[:, None], at] |= new >= 0
            ids, dist = np.concatenate([ids, new], axis=1), np.concatenate([dist, d], axis=1)
            done = np.concatenate([done, new < 0], axis=1)
            best = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, done = (np.take_along_axis(v, best, axis=1) for v in (ids, dist, done))
            # expand the nearest few that were not expanded yet
            step = np.argsort(np.where(done, np.inf, dist), axis=1, kind="stable")[:, :4]
            open_ = ~np.take_along_axis(done, step, axis=1)
            if not open_.any():
                return ids, np.sqrt(np.maximum(dist, 0))
            np.put_along_axis(done, step, True, axis=1)
            fresh = np.where(open_[:, :, None], self.near[np.maximum(np.take_along_axis(ids, step, axis=1), 0)], -1)
            fresh = fresh.reshape(len(q), -1)


    def within(self, q: np.ndarray, factor: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """All centroids found within ``factor`` times the nearest one's distance,
        nearest first, and their distances over that of the nearest."""
        out: list = [None] * len(q)
        todo, beam = np.arange(len(q)), BEAM
        while len(todo):
            ids, d = self.search(q[todo], beam)
            ratio = np.where(ids >= 0, d, np.inf) / np.maximum(d[:, :1], 1e-9)
            inside = ratio <= factor + 1e-9
            # the search saw the end of the ratio, or everything there is
            done = ~inside[:, -1] | (beam >= len(self.centre))
            for k in np.flatnonzero(done):
                out[todo[k]] = ids[k][inside[k]], ratio[k][inside[k]]
            todo, beam = todo[~done], 2 * beam
        return out


def _lengths(x: np.ndarray) -> np.ndarray:
    """Norms, also where squares would not fit a double."""
    most = np.maximum(np.abs(x).max(axis=1), 1e-300)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))


def _distances(centre: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of each query from every centroid."""
    d = (q ** 2).sum(axis=1)[:, None] + (centre ** 2).sum(axis=1) - 2 * q @ centre.T
    return np.sqrt(np.maximum(d, 0))


@dataclass
class Band:
    """Lists ``first, first + 1, ...`` of vectors with norms up to ``norm``."""
    norm: float
    first: int
    graph: Graph

    def vectors(self, x: np.ndarray) -> np.ndarray:
        z = x / self.norm
        return np.c_[z, np.sqrt(np.maximum(1 - (z ** 2).sum(axis=1), 0))]


def _queries(x: np.ndarray) -> np.ndarray:
    """Queries among the centroids of any band; the length of a query does not change the order."""
    return np.c_[x / _lengths(x)[:, None], np.zeros(len(x))]


def visited(bands: list[Band], x: np.ndarray, factor: float, rows: np.ndarray, least: int) -> list[np.ndarray]:
    """Lists that each query visits: those within the ratio in every band, then
    farther ones until ``least`` of the ``rows`` of the lists are reached."""
    q, out = _queries(x), []
    found = [band.graph.within(q, factor) for band in bands]
    for k in range(len(q)):
        own = np.concatenate([band.first + f[k][0] for band, f in zip(bands, found)])
        if rows[own].sum() < least:
            all_ = [(band.first + np.arange(len(band.graph.centre)), _distances(band.graph.centre, q[k:k + 1])[0]) for band in bands]
            lists = np.concatenate([a for a, _ in all_])
            far = np.concatenate([d / max(d.min(), 1e-9) for _, d in all_])
            far[np.isin(lists, own)] = 0
            order = lists[np.argsort(far, kind="stable")]
            own = order[:max(len(own), int(np.searchsorted(np.cumsum(rows[order]), least)) + 1)]
        out.append(np.sort(own).astype(np.int32))
    return out


def _placed(bands: dict[int, Band], vec: Column, band: Column) -> Column:
    """Lists of an indexed vector: the nearest of its band, and those almost as near."""
    @F.pandas_udf("array<int>")
    def chosen(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for s, of in batches:
            out: list = [None] * len(s)
            for b in of.unique():
                at = np.flatnonzero((of == b).to_numpy())
                own = bands[b]
                for a in range(0, len(at), 256):
                    some = at[a:a + 256]
                    z = own.vectors(np.stack(s.iloc[some].to_numpy()).astype(np.float64))
                    ids, d = own.graph.search(z, BEAM)
                    ok = (ids >= 0) & (d <= REPLICATE * d[:, :1] + 1e-9)
                    for k, row, keep in zip(some, ids, ok):
                        out[k] = (own.first + row[keep][:REPLICAS]).astype(np.int32)
            yield pd.Series(out, dtype=object)
    return chosen(vec, band)


def _visits(bands: list[Band], vec: Column, factor: float, rows: np.ndarray, group: np.ndarray, least: int) -> Column:
    """Groups that a query visits, with the lists of each."""
    @F.pandas_udf("array<struct<group:int,lists:array<int>>>")
    def chosen(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = []
            for a in range(0, len(s), 256):
                for own in visited(bands, np.stack(s.iloc[a:a + 256].to_numpy()).astype(np.float64), factor, rows, least):
                    of = group[own]
                    out.append([{"group": int(g), "lists": own[of == g].tolist()} for g in np.unique(of)])
            yield pd.Series(out, dtype=object)
    return chosen(vec)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors get equal scores wherever they are."""
    return (a * b).sum(axis=1)


def _measured(bands: list[Band], entries: DataFrame, postings: DataFrame, asking: DataFrame, k: int) -> float:
    """The smallest ratio, from ``PROBE`` on, at which a hash-chosen sample of the
    queries visits a list of ``RECALL`` of its true neighbours."""
    some = asking.orderBy(F.xxhash64("question"), "question").limit(TUNE).collect()
    if not some:
        return PROBE
    q = np.array([r["qx"] for r in some], np.float64)

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, scores = np.empty((len(q), 0), object), np.empty((len(q), 0))
        for part in batches:
            for a in range(0, len(part), 4096):
                own = part.iloc[a:a + 4096]
                scores = np.concatenate([scores, q @ np.stack(own["x"].to_numpy()).astype(np.float64).T], axis=1)
                names = np.concatenate([names, np.broadcast_to(own["entry"].to_numpy(), (len(q), len(own)))], axis=1)
                if scores.shape[1] > k + 1:
                    at = np.argpartition(-scores, k, axis=1)[:, :k + 1]
                    scores, names = np.take_along_axis(scores, at, axis=1), np.take_along_axis(names, at, axis=1)
        n = scores.shape[1]
        yield pd.DataFrame({"nth": np.repeat(np.arange(len(q)), n), "entry": names.ravel(), "score": scores.ravel()})

    # a query is no neighbour of its own
    asked = F.element_at(F.array(*[F.lit(r["question"].rpartition(":")[2]) for r in some]), F.col("nth") + 1)
    place = F.row_number().over(Window.partitionBy("nth").orderBy(F.desc("score"), "entry"))
    true = (entries.select("entry", "x").mapInPandas(best, "nth int, entry string, score double")
            .where(F.substring_index("entry", ":", -1) != asked)
            .withColumn("place", place).where(F.col("place") <= k).select("nth", "entry"))
    # at most TUNE * k * REPLICAS rows
    held = postings.select("entry", "list").join(F.broadcast(true), "entry").select("nth", "entry", "list").toPandas()
    if not len(held):
        return PROBE
    each = [_distances(band.graph.centre, _queries(q)) for band in bands]
    ratio = np.concatenate([d / np.maximum(d.min(axis=1, keepdims=True), 1e-9) for d in each], axis=1)
    held["ratio"] = ratio[held["nth"].to_numpy(), held["list"].to_numpy()]
    need = np.sort(held.groupby(["nth", "entry"])["ratio"].min().to_numpy())
    return max(PROBE, float(need[int(np.ceil(RECALL * len(need))) - 1]) * (1 + 1e-4))


def nearest(vectors: DataFrame, queries: Column, k: int = NEAREST, id_col: str = "vec_id", vec_col: str = "embedding",
            list_rows: int = LIST_ROWS, probe: float | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``query_id, rank, <id_col>, score`` of the ``k`` nearest rows found for
    each row of which ``queries`` is true, itself excluded; ties go to the
    smaller id. Without ``probe``, the ratio of the lists to visit is measured.

    Vectors that are null, empty, zero or hold a null or non-finite component
    take no part, nor do rows without an id or with another number of components
    than most vectors have. Rows with equal id and vector count once; an id with
    several vectors is a row for each. Components may be as large as doubles are:
    a product that overflows is infinite, and one of overflows of both signs counts
    as minus infinity. Every query gets ``k`` rows, or all
    candidates if there are fewer. Other columns are not read.
    """
    spark = vectors.sparkSession
    schema = f"query_id long, rank int, {id_col} long, score double"
    x = F.col("x")
    kind = "float" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "double"
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{kind}>").alias("x"),
                           F.coalesce(queries, F.lit(False)).alias("asks"))
            .where(F.col("id").isNotNull() & x.isNotNull()
                   & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
                   & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))))
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("x") == sizes["d"]).groupBy("id", "x").agg(F.max("asks").alias("asks"))
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy("x").orderBy("id"))).where(F.col("nth") <= k + 1)
    # the norm by the largest component, whose square may not fit a double
    most = F.array_max(F.transform("x", lambda v: F.abs(v).cast("double")))
    norm = F.col("most") * F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + F.pow(v.cast("double") / F.col("most"), F.lit(2.0))))
    entries = cut(first.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                  .select(F.concat_ws(":", F.col("ids")[0], F.hex(F.xxhash64("x"))).alias("entry"), "x", "ids", most.alias("most"))
                  .withColumn("norm", norm).withColumn("band", F.floor(F.log2("norm")).cast("int")).drop("most"))
    # a row for each power of two among the norms: at most some two thousand
    sides = entries.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm")).orderBy(F.desc("band")).collect()
    count = sum(r["n"] for r in sides)
    lists = max(1, min(MAX_LISTS, -(-count // list_rows)))
    share = min(1.0, min(SAMPLE, max(PER_LIST * lists, 4096)) / count)
    some = (entries.where(F.pmod(F.xxhash64("entry"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
            .select("band", "x").orderBy("entry").limit(SAMPLE).collect())
    bands: dict[int, Band] = {}
    for r in sides:
        own = Band(r["norm"], sum(len(b.graph.centre) for b in bands.values()), None)
        sample = own.vectors(np.array([s["x"] for s in some if s["band"] == r["band"]], np.float64).reshape(-1, sizes["d"]))
        fit = max(1, round(lists * r["n"] / count))
        own.graph = Graph.build(centroids(sample, fit) if len(sample) else np.zeros((1, sizes["d"] + 1)))
        bands[r["band"]] = own
    some = None

    postings = cut(entries.select("entry", F.col("ids")[0].alias("first"), "x", F.explode(_placed(bands, x, F.col("band"))).alias("list")))
    asking = cut(rows.where("asks").groupBy("x").agg(F.min("id").alias("q")).select(
        F.concat_ws(":", "q", F.hex(F.xxhash64("x"))).alias("question"), F.col("x").alias("qx")))
    all_bands = list(bands.values())
    total = sum(len(b.graph.centre) for b in all_bands)
    if probe is None:
        probe = _measured(all_bands, entries, postings, asking, k) if total > 1 else PROBE
    # one row per list: at most MAX_LISTS, and one per band
    held = np.zeros(total, np.int64)
    for r in postings.groupBy("list").count().collect():
        held[r["list"]] = r["count"]
    group = (np.cumsum(held) - held) // group_rows
    groups = spark.createDataFrame([(n, int(g)) for n, g in enumerate(group)], "list int, group int")
    # a boundary vector counts in each of its lists, so up to REPLICAS times as many are asked for
    visits = cut(asking.select("question", "qx", F.explode(_visits(all_bands, F.col("qx"), probe, held, group, REPLICAS * (k + 1))).alias("v"))
                 .select("question", "qx", "v.group", "v.lists"))
    grouped = postings.join(F.broadcast(groups), "list")
    blocks = (grouped.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
              .join(visits.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("qblocks")), "group"))
    keys = ["group", "block", "qblock"]
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    dealt = (grouped.join(F.broadcast(blocks), "group")
             .select("group", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int").alias("block"), "entry", "first", "x", "list",
                     every("qblocks").alias("qblock")))
    asked = (visits.join(F.broadcast(blocks), "group")
             .select("group", every("blocks").alias("block"), "question", "qx", "lists",
                     F.pmod(F.xxhash64("question"), F.col("qblocks")).cast("int").alias("qblock")))
    most = k + 1

    def products(qs: pd.DataFrame, vs: pd.DataFrame) -> pd.DataFrame:
        """The best ``most`` entries of each query among those of its lists."""
        if not len(qs) or not len(vs):
            return pd.DataFrame({"question": [], "entry": [], "first": [], "score": []})
        vs = vs.sort_values("list", kind="stable")
        q, v = (np.stack(c.to_numpy()).astype(np.float64) for c in (qs["qx"], vs["x"]))
        names, entry, first, of = qs["question"].to_numpy(), vs["entry"].to_numpy(), vs["first"].to_numpy(), vs["list"].to_numpy()
        own, begin = np.unique(of, return_index=True)
        spans = dict(zip(own.tolist(), zip(begin.tolist(), [*begin[1:].tolist(), len(of)])))
        asks: dict[int, list[int]] = {}
        for n, wanted in enumerate(qs["lists"]):
            for one in wanted:
                asks.setdefault(int(one), []).append(n)
        found = []
        with np.errstate(over="ignore", invalid="ignore"):
            for one, (a, z) in spans.items():
                at = np.array(asks.get(one, ()), np.int64)
                for b in range(0, len(at), 128):
                    s = q[at[b:b + 128]] @ v[a:z].T
                    n = min(most, z - a)
                    # the margin keeps ties of the last place, up to the error of the product; nothing compares to NaN
                    last = np.partition(s, z - a - n, axis=1)[:, z - a - n]
                    i, j = np.nonzero(~(s < last[:, None] - 1e-9 * np.abs(last[:, None])))
                    found.append((at[b + i], a + j))
            if not found:
                return pd.DataFrame({"question": [], "entry": [], "first": [], "score": []})
            i, j = (np.concatenate(c) for c in zip(*found))
            score = np.concatenate([_dot(q[i[a:a + 65536]], v[j[a:a + 65536]]) for a in range(0, len(i), 65536)])
        out = pd.DataFrame({"q": i, "entry": entry[j], "first": first[j], "score": np.where(np.isnan(score), -np.inf, score)})
        out = out.drop_duplicates(["q", "entry"]).sort_values(["q", "score", "first", "entry"], ascending=[True, False, True, True], kind="stable")
        out = out[out.groupby("q", sort=False).cumcount() < most]
        return out.assign(question=names[out["q"]])[["question", "entry", "first", "score"]]

    scored = asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(
        products, "question string, entry string, first long, score double")
    place = Window.partitionBy("question").orderBy(F.desc("score"), "first", "entry")
    # an entry is in REPLICAS lists at most, so these rows hold the k + 1 best entries; k + 1
    # entries are always enough, as each has at least one id
    few = (scored.withColumn("place", F.row_number().over(place)).where(F.col("place") <= REPLICAS * most)
           .dropDuplicates(["question", "entry"])
           .withColumn("place", F.row_number().over(place)).where(F.col("place") <= most).drop("place"))
    best = cut(few.join(entries.select("entry", "ids"), "entry").select("question", F.explode("ids").alias("id"), "score")
               .withColumn("place", F.row_number().over(Window.partitionBy("question").orderBy(F.desc("score"), "id")))
               .where(F.col("place") <= most))
    own = rows.where("asks").select(F.col("id").alias("query_id"), "x").join(
        asking, F.col("x") == F.col("qx")).select("query_id", "question")
    found = own.join(best, "question").where(F.col("id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id", "question").orderBy("place"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
