"""Ordered scans: values carried along the rows of a key, however many it has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaflow.operators.dispatch import _group_starts
from voltaflow.session import checkpoint_root


def _packed(batch) -> bytes:
    import pyarrow as pa
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes):
    import pyarrow as pa
    return next(iter(pa.ipc.open_stream(data)))


class _Carry:
    """What a row needs of the rows of its key before it: their number, the last value
    of each ``lag`` column and the last value but null of each ``fill`` column."""

    def __init__(self, lag: list[str], fill: list[str]):
        self.lag, self.fill, self.rows, self.values = lag, fill, 0, {}

    def step(self, batch, starts):
        """Positions, values before each row and filled values of a batch; moves on to its end."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        n = batch.num_rows
        at = np.arange(n)
        begin = np.maximum.accumulate(np.where(starts, at, -1))
        inner = begin >= 0  # rows whose key began in this batch
        position = np.where(inner, at - begin, at + self.rows)
        out = []
        for name in self.lag:
            col = batch.column(name)
            before = self.values.get(("lag", name))
            first = pa.nulls(1, col.type) if before is None else before
            shifted = pa.concat_arrays([first, col.slice(0, n - 1)])
            out.append(pc.if_else(pa.array(starts), pa.scalar(None, col.type), shifted))
            self.values["lag", name] = col.slice(n - 1, 1)
        for name in self.fill:
            col = batch.column(name)
            known = np.asarray(col.is_valid().to_numpy(zero_copy_only=False), bool)
            last = np.maximum.accumulate(np.where(known | starts, at, -1))
            before = self.values.get(("fill", name))
            before = pa.nulls(1, col.type) if before is None else before
            filled = pa.concat_arrays([before, col]).take(pa.array(last + 1))
            out.append(filled)
            self.values["fill", name] = filled.slice(n - 1, 1)
        self.rows = int(position[-1]) + 1
        return pa.array(position.astype(np.int64)), out

    def packed(self) -> bytes:
        import pyarrow as pa
        cols = [pa.concat_arrays([self.values[k, c]]) for k, names in (("lag", self.lag), ("fill", self.fill)) for c in names]
        return _packed(pa.RecordBatch.from_arrays([pa.array([self.rows]), *cols], names=["rows", *[str(k) for k in range(len(cols))]]))

    def unpack(self, data: bytes) -> None:
        got = _unpacked(data)
        self.rows = got.column(0)[0].as_py()
        names = [("lag", c) for c in self.lag] + [("fill", c) for c in self.fill]
        self.values = dict(zip(names, got.columns[1:]))


def _edges(batches, keys: list[str], lag: list[str], fill: list[str]):
    """One row for the partition: its first and last key, and what the last one carries on."""
    import pyarrow as pa
    carry, prev, first, one = _Carry(lag, fill), None, None, True
    for rb in batches:
        if not rb.num_rows:
            continue
        cols = [rb.column(k) for k in keys]
        starts = _group_starts(cols, prev)
        if first is None:
            starts[0] = False
            pid, first = rb.column("_pid")[0].as_py(), _packed(rb.select(keys).take(pa.array([0])))
        one = one and not starts.any()
        carry.step(rb, starts)
        prev = tuple(c[rb.num_rows - 1].as_py() for c in cols)
        last = rb.select(keys).take(pa.array([rb.num_rows - 1]))
    if first is not None:
        yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([first], pa.binary()), pa.array([_packed(last)], pa.binary()),
                                          pa.array([one]), pa.array([carry.packed()], pa.binary())],
                                         names=["pid", "first", "last", "one", "carry"])


def _carried(sides: list, lag: list[str], fill: list[str]) -> dict[int, bytes]:
    """What reaches each partition that goes on with the key of the one before."""
    out: dict[int, bytes] = {}
    for a, b in zip(sides, sides[1:]):
        if not _unpacked(a["last"]).equals(_unpacked(b["first"])):
            continue
        carry = _Carry(lag, fill)
        carry.unpack(a["carry"])
        if a["one"] and a["pid"] in out:
            before = _Carry(lag, fill)
            before.unpack(out[a["pid"]])
            carry.rows += before.rows
            for name in fill:
                if not carry.values["fill", name][0].is_valid:
                    carry.values["fill", name] = before.values["fill", name]
        out[b["pid"]] = carry.packed()
    return out


def ordered_scan(df: DataFrame, keys: list[str], order: list[str], lag: dict[str, str] | None = None,
                 fill: dict[str, str] | None = None, position: str | None = None) -> DataFrame:
    """Add, for each row among those of its ``keys`` in ``order``: ``lag`` (new column:
    value of the row before), ``fill`` (new column: last value but null up to this row)
    and ``position`` (from 0).

    A window function would take all rows of a key in one task. Here rows are dealt
    out and sorted by ranges of (keys, order), so partitions are of nearly equal size
    and a key runs over as many as it needs. One pass learns what each partition hands
    on (one row each, on the driver), a second one adds the columns, batch by batch.
    Nulls come first and null keys are a key like any other; rows that are equal in keys
    and order stand in any order. No row is dropped.
    """
    lag, fill = lag or {}, fill or {}
    lags, fills = list(lag.values()), list(fill.values())
    checkpoint_root(df.sparkSession)
    by = [*keys, *order]
    base = (df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_pid", F.spark_partition_id()).checkpoint())
    narrow = base.select(*dict.fromkeys([*keys, *lags, *fills, "_pid"]))
    # a single partition hands nothing on
    sides = [] if base.rdd.getNumPartitions() < 2 else sorted(narrow.mapInArrow(lambda it: _edges(it, keys, lags, fills),
                                     "pid int, first binary, last binary, one boolean, carry binary").collect(), key=lambda r: r["pid"])
    carried = _carried([r.asDict() for r in sides], lags, fills)
    new = [*([(position, T.LongType())] if position else []), *[(n, df.schema[c].dataType) for n, c in [*lag.items(), *fill.items()]]]
    schema = T.StructType(df.schema.fields + [T.StructField(n, t) for n, t in new])

    def scan(batches):
        import pyarrow as pa
        carry, prev = _Carry(lags, fills), None
        for rb in batches:
            if not rb.num_rows:
                continue
            cols = [rb.column(k) for k in keys]
            starts = _group_starts(cols, prev)
            if prev is None and (data := carried.get(rb.column("_pid")[0].as_py())) is not None:
                carry.unpack(data)
                starts[0] = False
            places, values = carry.step(rb, starts)
            prev = tuple(c[rb.num_rows - 1].as_py() for c in cols)
            keep = [k for k, n in enumerate(rb.schema.names) if n != "_pid"]
            yield pa.RecordBatch.from_arrays([rb.column(k) for k in keep] + ([places] if position else []) + values,
                                             names=[rb.schema.names[k] for k in keep] + [n for n, _ in new])
    return base.mapInArrow(scan, schema)
