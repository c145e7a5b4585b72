"""Prefix trie of conversations by union-find over sorted neighbours.

1. A conversation is the sequence of its turns' digests. Sorted by that sequence,
   the conversations below a trie node are neighbours, and the node's depth is at
   most the common prefix (LCP) of each two neighbours in it.
2. Conversations are dealt out and sorted by ranges, so a sequence that a third of
   all conversations share is spread over many partitions. The driver learns the
   LCP between the last conversation of a partition and the first of the next.
3. *Inside a partition* the edges between neighbours are taken in descending depth;
   a component that merges at depth D is a branching node (or one where
   conversations end), and stays one node for each depth down to the next merge.
   All figures of a node add up over its members and edges:

   * saved tokens: the words down to the LCP of every edge inside the node, less
     ``members - 1`` times the words above the node;
   * leaves: conversations that the next one neither repeats nor goes on from;
   * children: edges of exactly that depth whose right side goes on.
4. *Across boundaries* only nodes that reach the partition's first or last
   conversation are open. The partition is contracted to blocks that no open node
   separates (the staircases of falling LCPs seen from both ends), a handful of
   sums each, and the same union-find runs once more over the blocks of all
   partitions. It is the driver that does this; it holds no conversation but the
   first and last of each partition, and a few blocks for each.
5. Members of an open node that end there can be spread over partitions; only their
   ids go through one more shuffle, to be hashed as a stream in their order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaflow.llm.common import bounded_batches, cut

TOKEN = 16  # bytes of a turn's digest
#: Turns that a partition is asked to hold.
PART_TURNS = 500_000
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
_NODE_PA = pa.schema([(c.split()[0], pa.string() if "string" in c else pa.int64()) for c in NODE.split(", ")])


def lcp(a: bytes, b: bytes) -> int:
    """Turns that two sequences of digests begin with in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TOKEN
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax()) // TOKEN


@dataclass
class Block:
    """Neighbouring conversations, or blocks of these, as one element of a row of neighbours."""
    convs: int
    least: int
    edge_words: int  # words down to the LCP, summed over the edges inside
    leaves: int
    length: int  # turns of the first conversation
    words: list[int]  # words of the first 0, 1, ... turns
    open: int = -1  # depth of the deepest node that goes on outside
    children: int = 0  # of that node, inside, without the first one
    at: tuple[int, int] = (0, 0)


@dataclass
class Node:
    """A component from its merge at ``depth`` up to, but without, depth ``low``."""
    depth: int
    low: int
    left: int
    right: int
    convs: int
    least: int
    edge_words: int
    leaves: int
    children: int
    parent: Node | None = None
    inside: list[int] = field(default_factory=list)  # elements whose deepest open node this is


def breaks(edges: list[int], before: int, after: int) -> list[int]:
    """Edges at which a new minimum begins, seen from the left or from the right end."""
    out, low = set(), before
    for k, e in enumerate(edges):
        if e < low:
            out.add(k)
            low = e
    low = after
    for k in range(len(edges) - 1, -1, -1):
        if edges[k] < low:
            out.add(k)
            low = edges[k]
    return sorted(out)


def forest(row: list[Block], edges: list[int], before: int, after: int, floor: int) -> list[Node]:
    """Nodes of more than ``floor`` turns below neighbours ``row``, whose LCPs are
    ``edges``; ``before`` and ``after`` are those to what lies outside. Parents
    are set as far as they are in the list."""
    n = len(row)
    up, left, right = list(range(n)), list(range(n)), list(range(n))
    convs, least = [b.convs for b in row], [b.least for b in row]
    words, leaves = [b.edge_words for b in row], [b.leaves for b in row]
    around = [before, *edges, after]
    out, top = [], []
    for k, b in enumerate(row):  # a conversation by itself below its last common prefix
        low = max(around[k], around[k + 1])
        top.append(Node(b.length, low, k, k, 1, b.least, 0, 1, 0) if b.open < 0 and b.length > low else None)
    out += [t for t in top if t]
    waiting: list[list[Node]] = [[t] if t else [] for t in top]

    def find(k: int) -> int:
        while up[k] != k:
            up[k] = k = up[up[k]]
        return k

    by_depth: dict[int, list[int]] = {}
    for k, e in enumerate(edges):
        if e > floor:
            by_depth.setdefault(e, []).append(k)
    opens: dict[int, list[int]] = {}
    for k, b in enumerate(row):
        if b.open >= 0:
            opens.setdefault(b.open, []).append(k)
    for depth in sorted(by_depth, reverse=True):
        for k in by_depth[depth]:
            a, b = find(k), find(k + 1)
            if convs[a] < convs[b]:
                a, b, l, r = b, a, left[a], right[b]
            else:
                l, r = left[a], right[b]
            up[b], left[a], right[a] = a, l, r
            convs[a] += convs[b]
            least[a] = min(least[a], least[b])
            words[a] += words[b] + row[k + 1].words[depth]
            leaves[a] += leaves[b]
            waiting[a] += waiting[b]
            waiting[b] = []
        made: dict[int, Node] = {}
        for k in by_depth[depth]:
            root = find(k)
            if root not in made:
                l, r = left[root], right[root]
                made[root] = Node(depth, max(around[l], around[r + 1]), l, r, convs[root], least[root], words[root],
                                  leaves[root], int(row[l].length > depth))
            made[root].children += row[k + 1].length > depth
        for k in opens.get(depth, ()):
            made[find(k)].children += row[k].children
            made[find(k)].inside.append(k)
        for root, node in made.items():
            for child in waiting[root]:
                child.parent = node
            waiting[root] = [node]
            out.append(node)
    return out


def contract(row: list[Block], edges: list[int], before: int, after: int, pid: int) -> tuple[list[Block], list[tuple[int, int]], list[int]]:
    """The blocks of a partition, their ranges of elements, and the LCPs between them."""
    cuts_ = breaks(edges, before, after)
    spans = list(zip([0, *[k + 1 for k in cuts_]], [*[k + 1 for k in cuts_], len(row)]))
    around, out = [before, *[edges[k] for k in cuts_], after], []
    for nth, (a, z) in enumerate(spans):
        depth = max(around[nth], around[nth + 1])
        inner = range(a, z - 1)
        out.append(Block(
            sum(b.convs for b in row[a:z]), min(b.least for b in row[a:z]),
            sum(row[k + 1].words[edges[k]] for k in inner), sum(b.leaves for b in row[a:z]), row[a].length,
            list(row[a].words[:max(depth, 0) + 1]), depth,
            sum(edges[k] == depth and row[k + 1].length > depth for k in inner), (pid, nth)))
    return out, spans, around[1:-1]


class _Out:
    """Rows of nodes in batches."""

    def __init__(self, rows: int = 50_000):
        self.size, self.cols = rows, [[] for _ in _NODE_PA]

    def add(self, node: Node, first: Block, parent: int | None, ends: str) -> Iterator[pa.RecordBatch]:
        """One row for each depth of the node; ``parent`` is the conversation of the node above all."""
        for d in range(node.depth, node.low, -1):
            saved = node.edge_words - (node.convs - 1) * first.words[max(d - 1, 0)] if node.convs > 1 else 0
            above = None if d == 0 else node.least if d - 1 > node.low else parent
            for col, v in zip(self.cols, (node.least, d, above, node.convs, node.children if d == node.depth else 1,
                                          node.leaves, saved, ends if d == node.depth else EMPTY)):
                col.append(v)
            if len(self.cols[0]) >= self.size:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.cols, _NODE_PA)], schema=_NODE_PA)
            self.cols = [[] for _ in _NODE_PA]


def _digest(ids) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


class _Partition:
    """The conversations of one partition, in their order."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.pid, self.ids, self.keys, self.words = -1, [], [], []
        for b in batches:
            if b.num_rows:
                self.pid = b.column("_pid")[0].as_py()
                self.ids += b.column("conv_id").to_pylist()
                self.keys += b.column("key").to_pylist()
                self.words += [np.cumsum([0, *w.as_py()]).tolist() for w in b.column("words")]

    def row(self, after: int) -> tuple[list[Block], list[int]]:
        edges = [lcp(a, b) for a, b in zip(self.keys, self.keys[1:])]
        size = [len(k) // TOKEN for k in self.keys]
        return [Block(1, i, 0, int(e < n), n, w) for i, n, w, e in zip(self.ids, size, self.words, [*edges, after])], edges


def _ends_of(row: list[Block], a: int, z: int, depth: int) -> list[int]:
    """Members ``a .. z`` that end at that depth: the first ones, in the order of their ids."""
    out = []
    for k in range(a, z + 1):
        if row[k].length != depth:
            break
        out.append(row[k].least)
    return out


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, token, words`` of every turn, positions from 0 by turn
    (nulls first), then role and text; null roles and texts are empty. Rows
    without a conversation take no part. Other columns are not read."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    own = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
            .select("conv_id", (F.row_number().over(own) - 1).cast("long").alias("position"),
                    F.md5(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text").cast("binary")).alias("token"),
                    F.regexp_count("text", F.lit(WORD)).cast("int").alias("words")))


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def rebuilt(own: DataFrame, every: int = 20) -> DataFrame:
    """``conv_id, part, position, token, words``: the first h turns of conversation
    ``c - c % every``, then the own ones after the first h. Each conversation also
    has one row without a token, so that those without turns stay."""
    convs = own.select("conv_id").distinct()
    head = own.where((F.col("conv_id") % every == 0) & (F.col("position") < 3)).withColumnRenamed("conv_id", "base")
    given = (convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(head, "base")
             .where(F.col("position") < head_length(F.col("conv_id"))))
    rest = own.where(F.col("position") >= head_length(F.col("conv_id")))
    none = convs.withColumns({"part": F.lit(2), "position": F.lit(0).cast("long"), "token": F.lit(None).cast("string"),
                              "words": F.lit(None).cast("int")})
    columns = ["conv_id", "part", "position", "token", "words"]
    return (given.withColumn("part", F.lit(0)).select(*columns)
            .unionByName(rest.withColumn("part", F.lit(1)).select(*columns)).unionByName(none))


def _range(base: DataFrame) -> DataFrame:
    spark = base.sparkSession
    total = base.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_TURNS))
    order = ("key", "conv_id")
    return cut(base.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()))


def nodes(sequence: DataFrame) -> DataFrame:
    """A row for each distinct beginning of the sequences ``conv_id, part, position,
    token, words`` (ordered by part and position; rows without a token only name
    their conversation): ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``
    and ``ends_sha256``.

    The root, of depth 0, has every conversation; without conversations there is
    no node at all. Equal sequences share all nodes. A conversation's digests (20
    bytes a turn) are held together, its texts never.
    """
    bounded_batches()
    spark = sequence.sparkSession
    item = F.when(F.col("token").isNotNull(), F.struct("part", "position", "token", "words"))
    whole = sequence.groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("t"))
    base = _range(cut(whole.select("conv_id", F.unhex(F.array_join("t.token", "")).alias("key"), F.col("t.words").alias("words"))))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for b in batches:
            if b.num_rows:
                pid, last = b.column("_pid")[0].as_py(), b.column("key")[b.num_rows - 1].as_py()
                first = b.column("key")[0].as_py() if first is None else first
        if first is not None:
            yield pa.RecordBatch.from_pylist([{"pid": pid, "first": first, "last": last}],
                                             schema=pa.schema([("pid", pa.int32()), ("first", pa.binary()), ("last", pa.binary())]))

    # two keys for each partition
    sides = sorted(base.select("_pid", "key").mapInArrow(ends, "pid int, first binary, last binary").collect())
    if not sides:
        return spark.createDataFrame([], NODE)
    between = [-1, *[lcp(bytes(a.last), bytes(b.first)) for a, b in zip(sides, sides[1:])], -1]
    around = {s.pid: (between[k], between[k + 1]) for k, s in enumerate(sides)}

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Partition(batches)
        if part.ids:
            before, after = around[part.pid]
            row, edges = part.row(after)
            made, _, inner = contract(row, edges, before, after, part.pid)
            yield pa.RecordBatch.from_pylist(
                [vars(b) | {"pid": part.pid, "nth": k, "edge": e} for k, (b, e) in enumerate(zip(made, [*inner, -1]))],
                schema=pa.schema([(n, pa.int64()) for n in ("pid", "nth", "convs", "least", "edge_words", "leaves", "length",
                                                            "open", "children", "edge")] + [("words", pa.list_(pa.int64()))]))

    # a few rows for each partition: one for each fall of its LCPs
    found = sorted(base.mapInArrow(blocks, "pid long, nth long, convs long, least long, edge_words long, leaves long, length long, "
                                           "open long, children long, edge long, words array<long>").collect())
    row = [Block(r.convs, r.least, r.edge_words, r.leaves, r.length, list(r.words), r.open, r.children, (r.pid, r.nth)) for r in found]
    seams = [a.edge if a.pid == b.pid else around[b.pid][0] for a, b in zip(found, found[1:])]
    merged = forest(row, seams, -1, -1, -1) if len(row) > 1 else []
    of = {row[k].at: node.least for node in merged for k in node.inside}
    out = _Out(1 << 62)
    for node in merged:
        list(out.add(node, row[node.left], node.parent.least if node.parent else None, ""))
    shared = list(zip(*out.cols))

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Partition(batches)
        if not part.ids:
            return
        before, after = around[part.pid]
        all_, edges = part.row(after)
        made, spans, _ = contract(all_, edges, before, after, part.pid)
        out = _Out()
        for b, (a, z) in zip(made, spans):
            row, low = all_[a:z], edges[a:z - 1]
            before_ = edges[a - 1] if a else before
            after_ = edges[z - 1] if z < len(all_) else after
            for node in forest(row, low, before_, after_, b.open):
                above = node.parent.least if node.parent else of.get(b.at)
                yield from out.add(node, row[node.left], above, _digest(_ends_of(row, node.left, node.right, node.depth)))
        yield from out.flush()

    def ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Partition(batches)
        if not part.ids:
            return
        before, after = around[part.pid]
        all_, edges = part.row(after)
        for b, (a, z) in zip(*contract(all_, edges, before, after, part.pid)[:2]):
            ids = [x.least for x in all_[a:z] if x.length == b.open]
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array([of[b.at]] * len(ids), pa.int64()),
                                                  pa.array([b.open] * len(ids), pa.int64()), pa.array(ids, pa.int64())],
                                                 names=["conv_id", "depth", "member"])

    closed = base.mapInArrow(inner, NODE)
    if not shared:
        return closed
    # ids of members that end in open nodes, hashed as a stream in their order
    keys = ["conv_id", "depth"]
    listed = (base.mapInArrow(ending, "conv_id long, depth long, member long")
              .repartition(*keys).sortWithinPartitions(*keys, "member").mapInArrow(_hashed, "conv_id long, depth long, ends string"))
    opened = spark.createDataFrame(shared, NODE).join(listed, keys, "left")
    return closed.unionByName(opened.withColumn("ends_sha256", F.coalesce("ends", F.lit(EMPTY))).drop("ends"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the members of each (conv_id, depth), rows of which follow each other."""
    at, sha, done = None, None, []

    def close() -> None:
        if at is not None:
            done.append((*at, sha.hexdigest()))

    for b in batches:
        for c, d, m in zip(*(b.column(k).to_pylist() for k in ("conv_id", "depth", "member"))):
            if at == (c, d):
                sha.update(b",%d" % m)
            else:
                close()
                at, sha = (c, d), hashlib.sha256(b"%d" % m)
    close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string()))],
                                         names=["conv_id", "depth", "ends"])
