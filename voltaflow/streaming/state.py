"""Stateful stream operators: battery SOC per key, duplicate suppression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupStateTimeout

from voltaflow.functions import constants as C
from voltaflow.operators.dispatch import RESULT_FIELDS, _fold_batch, battery_key


def battery_dispatch_stream(df: DataFrame, scope: str = "location", order: tuple[str, ...] = ("ts", "event_id"),
                            initial_soc: float = C.BATTERY_INITIAL_SOC) -> DataFrame:
    """Streaming battery dispatch: SOC kept in the state store per battery.

    Within a micro-batch a battery's rows are ordered by ``order``; across
    micro-batches arrival order applies (as with a live feed). State is
    checkpointed, so SOC survives restarts (unlike an in-process variable).
    Memory per call is bounded by one battery's rows in one micro-batch
    (bounded by maxOffsetsPerTrigger / maxFilesPerTrigger).
    """
    keyed = df.withColumn("_battery_key", battery_key(scope))
    out_schema = T.StructType(keyed.schema.fields + [
        T.StructField("battery_charge_rate", T.DoubleType()),
        T.StructField("battery_discharge_rate", T.DoubleType()),
        T.StructField("soc_after", T.DoubleType()),
    ])
    sort_cols = list(order)

    def fold(key, pdfs: Iterator[pd.DataFrame], state):
        soc = state.get[0] if state.exists else initial_soc
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(sort_cols, kind="mergesort")
        # one battery, SOC from the state store: no resets inside the call
        charge, dis, socs, soc = _fold_batch(
            pa.array(pdf["power_balance"].to_numpy(dtype="float64")),
            pa.array(pdf["electricity_price"].to_numpy(dtype="float64")),
            np.zeros(len(pdf), dtype=bool), None, soc)
        state.update((soc,))
        yield pdf.assign(battery_charge_rate=charge, battery_discharge_rate=dis, soc_after=socs)

    return (keyed.groupBy("_battery_key")
            .applyInPandasWithState(fold, out_schema, T.StructType([T.StructField("soc", T.DoubleType())]),
                                    "append", GroupStateTimeout.NoTimeout)
            .drop("_battery_key"))


class _EventTimeBattery(StatefulProcessor):
    """SOC of one battery; rows wait in pieces of event time until the watermark has passed their piece."""

    def __init__(self, schema: pa.Schema, order: tuple[str, ...], initial_soc: float, piece_ms: int):
        self.schema, self.order, self.initial_soc, self.piece_ms = schema, list(order), initial_soc, piece_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.soc = handle.getValueState("soc", "soc double")
        self.pieces = handle.getMapState("pieces", "piece long", "rows binary")

    def _folded(self, rows: pa.Table, late: bool) -> pd.DataFrame:
        soc = self.soc.get()[0] if self.soc.exists() else self.initial_soc
        if late:
            nothing = [None] * rows.num_rows
            charge = dis = socs = nothing
        else:
            rows = rows.sort_by([(c, "ascending") for c in self.order])
            charge, dis, socs, soc = _fold_batch(rows["power_balance"].combine_chunks(), rows["electricity_price"].combine_chunks(),
                                                 np.zeros(rows.num_rows, dtype=bool), None, soc)
            self.soc.update((soc,))
        return rows.drop_columns(["_ms"]).to_pandas().assign(battery_charge_rate=charge, battery_discharge_rate=dis, soc_after=socs, late=late)

    def handleInputRows(self, key, rows, timerValues):
        passed = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            pdf.columns = self.schema.names  # names that begin with _ arrive as numbers
            table = pa.Table.from_pandas(pdf, schema=self.schema, preserve_index=False)
            piece = pdf["_ms"].to_numpy() // self.piece_ms
            for p in np.unique(piece).tolist():
                own = table.filter(pa.array(piece == p))
                if (p + 1) * self.piece_ms <= passed:  # its piece has been folded
                    yield self._folded(own, True)
                    continue
                if self.pieces.containsKey((p,)):
                    own = pa.concat_tables([pa.ipc.open_stream(self.pieces.getValue((p,))[0]).read_all(), own])
                else:
                    self.handle.registerTimer((p + 1) * self.piece_ms)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema) as out:
                    out.write_table(own)
                self.pieces.updateValue((p,), (sink.getvalue().to_pybytes(),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # timers may come in any order: fold whatever is due, oldest first
        due = sorted(k[0] for k in self.pieces.keys() if (k[0] + 1) * self.piece_ms <= timerValues.getCurrentWatermarkInMs())
        for p in due:
            rows = pa.ipc.open_stream(self.pieces.getValue((p,))[0]).read_all()
            self.pieces.removeKey((p,))
            yield self._folded(rows, False)

    def close(self) -> None:
        pass


def battery_event_time_stream(df: DataFrame, scope: str = "location", order: tuple[str, ...] = ("ts", "event_id"),
                              time_col: str = "ts", delay: str = C.WATERMARK_DELAY, piece: str = "1 hour",
                              initial_soc: float = C.BATTERY_INITIAL_SOC) -> DataFrame:
    """Streaming battery dispatch in event time, whatever the order of arrival.

    Rows wait in the state store in pieces (of an hour) per battery; when the
    watermark has passed a piece's end, its rows are folded in ``order`` and leave
    with ``late`` false. So shuffled arrival gives the batch fold, and a task holds
    one piece of one battery. Rows whose piece was folded already leave at once with
    ``late`` true and no results. Rows without a time are not part of an event-time
    stream and take no part. Needs the RocksDB state store.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.pandas.types import to_arrow_schema

    # the processor sees the time as a number, so that Spark does not drop late rows before they are listed
    at = F.col(time_col).cast("timestamp")
    keyed = (df.where(F.col(time_col).isNotNull()).withColumns({"_battery_key": battery_key(scope), "_ms": F.unix_millis(at), "_event": at})
             .withWatermark("_event", delay).drop("_event"))
    fields = [f for f in keyed.schema.fields if f.name != "_ms"]
    out = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + RESULT_FIELDS + [T.StructField("late", T.BooleanType())])
    piece_ms = int(pd.Timedelta(piece).total_seconds() * 1000)
    schema = to_arrow_schema(T.StructType([T.StructField(f.name, f.dataType) for f in keyed.schema.fields]))
    return (keyed.groupBy("_battery_key")
            .transformWithStateInPandas(_EventTimeBattery(schema, order, initial_soc, piece_ms), out, "append", "eventTime")
            .drop("_battery_key"))


def _covered(starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each offset lies in one of the sorted intervals [start, end)."""
    if not len(starts):
        return np.zeros(len(at), bool)
    k = np.searchsorted(starts, at, side="right") - 1
    return (k >= 0) & (at < ends[np.maximum(k, 0)])


def _merged(starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals with the offsets added; intervals that touch become one."""
    a, z = np.concatenate([starts, at]), np.concatenate([ends, at + 1])
    order = np.argsort(a, kind="stable")
    a, z = a[order], np.maximum.accumulate(z[order])
    first = np.concatenate([[True], a[1:] > z[:-1]])[:len(a)]
    last = np.concatenate([first[1:], [True]])[:len(a)]
    return a[first], z[last]


def dedup_stream(df: DataFrame, keys: tuple[str, str, str] = ("topic", "partition", "offset"), arrival: str | None = None) -> DataFrame:
    """The first delivery of each (topic, partition, offset), for ever.

    A topic partition's state is the intervals of offsets it has seen. Offsets are
    dense, so these are one interval and the gaps: re-deliveries are dropped however
    late they come, and a first delivery is kept however late it is; there is no
    watermark and nothing expires. Of several deliveries in one micro-batch the one
    of smallest ``arrival`` counts (then by content), without it the first read. A
    null key is a key like any other. A task holds the new rows of one topic
    partition in one micro-batch; bound that at the source.
    """
    topic, partition, offset = keys
    columns = df.columns

    def fresh(key, pdfs: Iterator[pd.DataFrame], state):
        starts, ends, null = (np.array(state.get[0], np.int64), np.array(state.get[1], np.int64), state.get[2]) if state.exists else (
            np.empty(0, np.int64), np.empty(0, np.int64), False)
        held = []
        for pdf in pdfs:
            at = pdf[offset]
            empty = at.isna().to_numpy()
            seen = np.full(len(pdf), null)
            seen[~empty] = _covered(starts, ends, at[~empty].to_numpy(np.int64))
            held.append(pdf[~seen])
        new = pd.concat(held, ignore_index=True) if held else pd.DataFrame(columns=columns)
        if not len(new):
            return
        if arrival:
            text = new.drop(columns=[arrival]).astype(str).agg("|".join, axis=1)
            new = new.assign(_text=text).sort_values([arrival, "_text"], kind="mergesort").drop(columns=["_text"])
        new = new.drop_duplicates(offset, keep="first")  # nulls are equal here
        at = new[offset].dropna().to_numpy(np.int64)
        starts, ends = _merged(starts, ends, at)
        state.update((starts.tolist(), ends.tolist(), bool(null or new[offset].isna().any())))
        yield new[columns]

    return df.groupBy(topic, partition).applyInPandasWithState(
        fresh, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]),
        "starts array<bigint>, ends array<bigint>, null_seen boolean", "append", GroupStateTimeout.NoTimeout)
