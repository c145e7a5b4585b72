"""Structure repair of conversations by iterative-deepening A*.

A repaired conversation has the role initials ``(s?(ua)+)?``. Each row is kept,
given another role or deleted, and empty turns can be inserted; the cheapest edits
win, and of these the ASCII-least string of their initials (D, I, K, R).

*Search.* Depth-first in ASCII order under a cost bound, which rises to the least
estimate that went beyond it; states that failed with a budget are not entered
again with the same or less. So the first path that is accepted is the answer. The
estimate adds up what no edit can avoid: 3 for a row that must go, 1 for a
truncated one.

*Long conversations.* The search runs over ``BLOCK`` rows at a time. The state
before a row is one of four, so rows have 4 x 4 matrices of least costs, whose
(min, +) products say exactly what the rest of a conversation costs from each state
behind a block; that is the estimate at the block's end. Rows are dealt out and
sorted by ranges, so a conversation that holds a third of all rows is spread over
many partitions. Each of its partitions hands one matrix to the driver, then the
state it leaves for each state it may begin with; after that all partitions
know their costs and states and repair their rows side by side. A task holds the
rows of one partition, the driver one row of figures for each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaflow.llm.common import bounded_batches, cut

BLOCK = 32
#: Bytes of text that a partition is asked to hold.
PART_BYTES = 32 << 20
FAR = 1 << 40
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: States: nothing yet; after s; after u; after a. What follows each, and the role that leads there.
NEXT, ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
ACCEPT = (0, 3)
#: Least cost of inserts that end a conversation in each state.
END = (0, 4, 2, 0)
FAULTS = ("", "truncated", "blank", "duplicate")
INITIALS = ("s", "u", "a")
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2


def _code(initial: int, fault: int) -> int:
    return fault * 4 + initial


def _kept(q: int, code: int) -> int | None:
    """State after the row is kept as it is, if it may be."""
    want = (0, 2, 3, None)[initial] if (initial := code % 4) < 3 else None
    if initial == 0:
        return 1 if q == 0 else None
    return want if want is not None and NEXT[q] == want else None


def _steps() -> np.ndarray:
    """Least cost from state to state of inserts and then one row, for each code."""
    inserts = np.full((4, 4), FAR)
    for q in range(4):
        p, cost = q, 0
        for _ in range(4):
            inserts[q, p] = min(inserts[q, p], cost)
            p, cost = NEXT[p], cost + INSERT
    out = np.full((17, 4, 4), FAR)
    for code in range(16):
        row = np.full((4, 4), FAR)
        for q in range(4):
            row[q, q] = DELETE
            if code < 8:
                more = code // 4
                row[q, NEXT[q]] = min(row[q, NEXT[q]], REROLE + more)
                if (to := _kept(q, code)) is not None:
                    row[q, to] = min(row[q, to], KEEP + more)
        out[code] = _times(inserts[None], row[None])[0]
    out[16] = np.where(np.eye(4, dtype=bool), 0, FAR)
    return out


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) products of two stacks of matrices."""
    return np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(axis=2), FAR)


STEP = _steps()


def _products(codes: np.ndarray, size: int) -> np.ndarray:
    """The matrix of every ``size`` (a power of two) rows."""
    count = -(-len(codes) // size)
    m = STEP[np.concatenate([codes, np.full(count * size - len(codes), 16, codes.dtype)])]
    while len(m) > count:
        m = _times(m[::2], m[1::2])
    return m


def matrix(codes: np.ndarray) -> np.ndarray:
    """Least cost from each state to each state over all the rows."""
    m = STEP[16:]
    for a in range(0, len(codes), 1 << 14):
        m = _times(m, _products(codes[a:a + (1 << 14)], 1 << 14))
    return m[0]


def before(m: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Least cost to the end from each state in front of the rows of ``m``."""
    return np.minimum((m + after[None, :]).min(axis=1), FAR)


def search(codes: list[int], start: int, after: list[int], final: bool) -> tuple[str, int]:
    """Edits of the rows from state ``start`` and the state they lead to, by
    iterative deepening. ``after`` is what the rest costs from each state, exactly;
    the ``final`` rows end with the inserts that make the conversation complete."""
    n = len(codes)
    rest = [0] * (n + 1)
    for k in range(n - 1, -1, -1):
        rest[k] = rest[k + 1] + (0, 1, 3, 3)[codes[k] // 4]
    least = min(after)
    path: list[str] = []
    end = beyond = 0
    failed: dict[tuple[int, int], int] = {}

    def down(k: int, q: int, left: int) -> bool:
        """Whether a path within the budget ``left`` is accepted."""
        nonlocal end, beyond
        if k == n and (not final or q in ACCEPT):
            over = after[q] - left
            if over <= 0:
                end = q
                return True
            beyond = min(beyond, over)
            return False
        over = rest[k] + least - left
        if over > 0:
            beyond = min(beyond, over)
            return False
        if failed.get((k, q), -1) >= left:
            return False
        at = len(path)
        code = codes[k] if k < n else None
        edits = [("I", k, NEXT[q], INSERT)]
        if code is not None:
            edits.insert(0, ("D", k + 1, q, DELETE))
            if code < 8:
                more = code // 4
                if (to := _kept(q, code)) is not None:
                    edits.append(("K", k + 1, to, KEEP + more))
                edits.append(("R", k + 1, NEXT[q], REROLE + more))
        for edit, k2, q2, cost in edits:
            path.append(edit)
            if down(k2, q2, left - cost):
                return True
            del path[at:]
        failed[k, q] = left
        return False

    bound = rest[0] + least
    while True:
        beyond = FAR
        failed.clear()
        if down(0, start, bound):
            return "".join(path), end
        bound += beyond


def solve(codes: np.ndarray, start: int, after: np.ndarray, final: bool) -> tuple[str, int]:
    """``search`` over any number of rows, block by block."""
    blocks = [codes[a:a + BLOCK].tolist() for a in range(0, len(codes), BLOCK)] or [[]]
    behind = [after]
    if len(blocks) > 1:
        for m in _products(codes, BLOCK)[:0:-1]:
            behind.append(before(m, behind[-1]))
    out = []
    for k, (block, rest) in enumerate(zip(blocks, behind[::-1])):
        last = final and k == len(blocks) - 1
        # the inserts of the last block are edits of its own, not costs behind it
        edits, start = search(block, start, [0] * 4 if last else rest.tolist(), last)
        out.append(edits)
    return "".join(out), start


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of conversations with faults put in by
    crc32 of ``conv_id:turn`` (null: a space) modulo 20: 0 drops a row (0 copies),
    1 empties its text, 2 takes its sentence ends away, 3 repeats it (2 copies), 4
    makes it the user's. Null roles and texts are one space. Other columns are not read."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows by ranges of (conversation, turn, role, text), equal ones as one with
    their number, with role initial and fault."""
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1).cast("long")
    real = copies > 0
    one = rows.select("conv_id", F.when(real, F.col("turn")).alias("turn"),
                      *[F.when(real, F.coalesce(c, F.lit(" "))).alias(c) for c in ("role", "text")], copies.alias("copies"))
    one = one.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    said = F.md5(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text").cast("binary"))
    when = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    one = one.withColumn("_said", said)
    # the first turn in which a role said this: partial minima, then a join that can be split
    first = (one.where("copies > 0").groupBy(F.col("conv_id").alias("_conv"), F.col("_said").alias("_s"))
             .agg(F.min(when).alias("_first")))
    seen = one.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_said") == F.col("_s")), "left")
    stripped = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.coalesce(*[F.when(F.substring("role", 1, 1) == c, k) for k, c in enumerate(INITIALS)], F.lit(3))
    fault = (F.when(stripped == "", 2).when(~when.eqNullSafe(F.col("_first")), 3)
             .when(~F.substring(stripped, -1, 1).isin(".", "!", "?"), 1).otherwise(0))
    out = seen.select("conv_id", "turn", "role", "text", "copies", (fault * 4 + initial).cast("int").alias("code"))
    out = cut(out)
    spark = rows.sparkSession
    total = out.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    order = ("conv_id", "turn", "role", "text")
    return cut(out.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()))


def _expanded(code: list[int], copies: list[int]) -> np.ndarray:
    """A code for each copy; those after the first one repeat it."""
    code, copies = np.array(code, np.int64), np.array(copies, np.int64)
    out = np.repeat(code, copies)
    first = np.cumsum(copies) - copies
    again = np.ones(len(out), bool)
    again[first[copies > 0]] = False
    return np.where(again & (out // 4 != 2), out % 4 + 12, out)


_COLUMNS = ("conv_id", "turn", "role", "text", "copies", "code")


def _runs(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[int, object, list[list], bool, bool]]:
    """(pid, conversation, columns, whether it is the first, the last of the partition)."""
    pid, now, held, first = None, None, None, True
    at = columns.index("conv_id")
    for b in batches:
        if not b.num_rows:
            continue
        pid = b.column("_pid")[0].as_py()
        cols = [b.column(c).to_pylist() for c in columns]
        own = cols[at]
        starts = [0, *[k for k in range(1, len(own)) if own[k] != own[k - 1]], len(own)]
        for a, z in zip(starts, starts[1:]):
            if held is not None and own[a] == now:
                for h, c in zip(held, cols):
                    h += c[a:z]
                continue
            if held is not None:
                yield pid, now, held, first, False
                first = False
            now, held = own[a], [c[a:z] for c in cols]
    if held is not None:
        yield pid, now, held, first, True


class Ranges:
    """Prepared rows with what each partition must know of the others."""

    def __init__(self, rows: DataFrame):
        bounded_batches()
        self.base = _prepared(rows)
        self.type = self.base.schema["conv_id"].dataType.simpleString()
        narrow = self.base.select("conv_id", "copies", "code", "_pid")

        def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, first = None, None
            for pid, conv, (_, copies, code), begins, ends in _runs(batches, ("conv_id", "copies", "code")):
                if begins or ends:
                    m = matrix(_expanded(code, copies)).ravel().tolist()
                    first = (conv, m) if begins else first
                    out = {"pid": pid, "first": first[0], "last": conv, "one": begins and ends, "m_first": first[1], "m_last": m}
            if out:
                kind = narrow_type
                yield pa.RecordBatch.from_pylist([out], schema=pa.schema([
                    ("pid", pa.int32()), ("first", kind), ("last", kind), ("one", pa.bool_()),
                    ("m_first", pa.list_(pa.int64())), ("m_last", pa.list_(pa.int64()))]))

        from pyspark.sql.pandas.types import to_arrow_type

        narrow_type = to_arrow_type(self.base.schema["conv_id"].dataType)
        self.arrow_type = narrow_type
        # one row for each partition
        side = sorted(narrow.mapInArrow(edges, f"pid int, first {self.type}, last {self.type}, one boolean, m_first array<long>, "
                                               "m_last array<long>").collect(), key=lambda r: r.pid)
        goes_on = {a.pid for a, b in zip(side, side[1:]) if a.last == b.first}
        self.after: dict[int, np.ndarray] = {}  # what the rest costs behind a partition whose last conversation goes on
        self.begin: dict[int, int] = {}  # state at the begin of a partition that goes on with a conversation
        for a, b in list(zip(side, side[1:]))[::-1]:
            if a.pid in goes_on:
                rest = self.after[b.pid] if b.one and b.pid in goes_on else np.array(END)
                self.after[a.pid] = before(np.array(b.m_first).reshape(4, 4), rest)
        after = self.after

        def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for pid, _, (_, copies, code), begins, ends in _runs(batches, ("conv_id", "copies", "code")):
                if ends and pid in after:
                    codes = _expanded(code, copies)
                    to = [solve(codes, q, after[pid], False)[1] if q == 0 or begins else 0 for q in range(4)]
                    yield pa.RecordBatch.from_pylist([{"pid": pid, "one": begins, "to": to}], schema=pa.schema(
                        [("pid", pa.int32()), ("one", pa.bool_()), ("to", pa.list_(pa.int32()))]))

        if goes_on:
            to = {r.pid: r.to for r in narrow.mapInArrow(leaves, "pid int, one boolean, to array<int>").collect()}
            for a, b in zip(side, side[1:]):
                if a.pid in goes_on:
                    self.begin[b.pid] = to[a.pid][self.begin.get(a.pid, 0) if a.one else 0]

    def edits(self, whole: bool | None = None) -> DataFrame:
        """The edits (see ``repair``); with ``whole``, those of the conversations that
        lie in one partition, or of the others."""
        after, begin, kind = self.after, self.begin, self.arrow_type
        out_type = pa.schema([("conv_id", kind), ("part", pa.int32()), ("n", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
                              ("old_role", pa.string()), ("fault", pa.string()), ("role", pa.string()), ("text", pa.string())])

        def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for pid, conv, (_, turn, role, text, copies, code), begins, ends in _runs(batches, _COLUMNS):
                on, from_ = ends and pid in after, begins and pid in begin
                if whole is not None and whole == (on or from_):
                    continue
                codes = _expanded(code, copies)
                q = begin[pid] if from_ else 0
                edits, _ = solve(codes, q, after[pid] if on else np.array(END), not on)
                each = ((t, r, x) for t, r, x, c in zip(turn, role, text, copies) for _ in range(c))
                if not any(copies):
                    held.append((conv, pid, 0, "", None, None, None, None, None))
                k = 0
                for n, edit in enumerate(edits):
                    to = NEXT[q]
                    if edit == "I":
                        held.append((conv, pid, n, edit, None, None, None, ROLE[q], ""))
                    else:
                        t, r, x = next(each)
                        new = None if edit == "D" else r if edit == "K" else ROLE[q]
                        held.append((conv, pid, n, edit, t, r, FAULTS[codes[k] // 4], new, None if edit == "D" else x))
                        size += len(x)
                        to = q if edit == "D" else _kept(q, codes[k]) if edit == "K" else to
                        k += 1
                    q = to
                    if len(held) >= 10_000 or size > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out_type)], schema=out_type)
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out_type)], schema=out_type)

        return self.base.select(*_COLUMNS[:1], F.col("turn").cast("long").alias("turn"), *_COLUMNS[2:], "_pid").mapInArrow(
            repaired, f"conv_id {self.type}, part int, n long, edit string, turn long, old_role string, fault string, role string, text string")


def repair(rows: DataFrame) -> DataFrame:
    """The edits of ``rows(conv_id, turn, role, text[, copies])`` in their order
    (``conv_id``, ``part``, ``n``): ``edit`` (K, R, D or I), the row's ``turn``,
    ``old_role`` and ``fault`` (blank, duplicate, truncated or empty), and the
    repaired ``role`` and ``text`` (null where deleted).

    Rows are taken by turn (nulls first), then role and text; a null role or text
    is one space, a null ``conv_id`` a conversation like any other. ``copies`` says
    how often a row stands there; a conversation with none but rows of 0 copies has
    one row without an edit. Blank rows and those whose role said the same before must
    go; a kept truncated row costs 1 more. An empty table stays empty.
    """
    return Ranges(rows).edits()


REPORT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def summary(rows: DataFrame) -> DataFrame:
    """A row for each conversation: turns missing between the first and the last
    (``gaps``), rows by fault, adjacent roles that can't follow each other
    (``illegal``), ``cost`` and initials (``audit``) of the cheapest edits, and the
    SHA-256 of the repaired ``role:text`` lines, streamed in their order."""
    ranges = Ranges(rows)
    schema = f"conv_id {ranges.type}, {REPORT}"
    kind = ranges.arrow_type

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in REPORT.split(", ")]
        types = pa.schema([("conv_id", kind)] + [(c, pa.string() if c in names[-2:] else pa.int64()) for c in names])
        done, now, own = [], None, None
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("conv_id", "edit", "turn", "old_role", "fault", "role", "text")]
            for conv, *row in zip(*cols):
                if own is None or conv != now:
                    if own is not None:
                        done.append((now, *own.row()))
                    now, own = conv, _Told()
                own.add(*row)
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), types)], schema=types)
                done = []
        if own is not None:
            done.append((now, *own.row()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), types)], schema=types)

    out = ranges.edits(True if ranges.begin else None).mapInArrow(told, schema)
    if not ranges.begin:
        return out
    spread = ranges.edits(False).repartition("conv_id").sortWithinPartitions("conv_id", "part", "n")
    return out.unionByName(spread.mapInArrow(told, schema))


class _Told:
    """Figures of one conversation, edit by edit."""

    def __init__(self):
        self.turns, self.low, self.high, self.turn = 0, None, None, None
        self.count = dict.fromkeys(FAULTS, 0)
        self.illegal = self.cost = 0
        self.initial, self.audit, self.sha, self.lines = None, [], hashlib.sha256(), 0

    def add(self, edit, turn, old_role, fault, role, text) -> None:
        if not edit:
            return
        self.audit.append(edit)
        self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            self.count[fault] += 1
            self.cost += fault == "truncated" and edit != "D"
            initial = old_role[:1]
            self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
            self.initial = initial
            if turn is not None and turn != self.turn:
                self.turns, self.turn, self.high = self.turns + 1, turn, turn
                self.low = turn if self.low is None else self.low
        if edit != "D":
            self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, self.count["blank"], self.count["duplicate"], self.count["truncated"], self.illegal, self.cost,
                "".join(self.audit), self.sha.hexdigest())
