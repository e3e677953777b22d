"""Streams of detections and landmarks: clips as they come, short gaps filled, rates limited.

Each operator keeps a few values per key in the state store; rows of one key are taken in time order within a micro-batch, and rows older than what the key has already seen are dropped. With ``ttl_ms`` a key that has no rows for so long (processing time) is forgotten, so the store holds live tracks only; a key that comes again after that starts as a new one. Such a query runs on until it is stopped, also under an available-now trigger, as Spark goes on looking for what expires.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType


class _Ordered(StatefulProcessor):
    """Rows of a key in time order, one by one, past a small state."""

    STATE = "last double"
    ttl_ms: int | None = None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", self.STATE, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable")
        before = self.state.get() if self.state.exists() else None
        out, after = self.fold(frame, before)
        if after is not None:
            self.state.update(after)
        if len(out):
            yield out

    def close(self) -> None:
        pass


class _Clips(_Ordered):
    STATE = "last double, clip int"

    def __init__(self, order: str, gap: float):
        self.order, self.gap = order, gap

    def fold(self, frame, before):
        last, clip = before if before is not None else (None, -1)
        index = []
        for t in frame[self.order]:
            if last is not None and t < last:
                index.append(None)
                continue
            clip += last is None or not last + self.gap > t
            last = t
            index.append(clip)
        frame = frame.assign(clip_index=pd.array(index, "Int32"))
        return frame[frame["clip_index"].notna()].astype({"clip_index": "int32"}), (last, int(clip))


class _Rate(_Ordered):
    def __init__(self, order: str, interval: float):
        self.order, self.interval = order, interval

    def fold(self, frame, before):
        last, keep = before[0] if before is not None else None, []
        for t in frame[self.order]:
            keep.append(last is None or t - last >= self.interval)
            last = t if keep[-1] else last
        return frame[keep], None if last is None else (last,)


def _numbers(value) -> np.ndarray | None:
    """A number, or an array of numbers or points, as one flat array; None where there is no value."""
    if value is None:
        return None
    if np.ndim(value) == 0:
        return None if value != value else np.array([value], float)
    return np.concatenate([np.zeros(0), *(np.atleast_1d(np.asarray(v, float)) for v in value)])


def _shaped(flat: np.ndarray, like):
    """``flat`` in the shape of ``like``."""
    if np.ndim(like) == 0:
        return float(flat[0])
    ends = np.cumsum([np.size(v) for v in like])
    return [part.tolist() if np.ndim(v) else float(part[0]) for part, v in zip(np.split(flat, ends[:-1]), like, strict=True)] if len(like) else []


class _Gaps(_Ordered):
    STATE = "frame bigint, value array<double>"

    def __init__(self, order: str, value: str, most: int):
        self.order, self.value, self.most = order, value, most

    def fold(self, frame, before):
        left, out = before, []
        other = [c for c in frame.columns if c not in (self.order, self.value)]
        for row in frame.to_dict("records"):
            i, v = row[self.order], _numbers(row[self.value])
            if v is None or (left is not None and i <= left[0]):
                continue
            length = 0 if left is None else i - left[0] - 1
            short = left is not None and length <= self.most and len(left[1]) == len(v)
            for k in range(1, length + 1) if short else ():
                old = np.asarray(left[1], float)
                out.append({**{c: row[c] for c in other}, self.order: left[0] + k, self.value: _shaped(old + (v - old) / length * k, row[self.value]), "filled": True, "jumped": False})
            out.append({**row, self.value: _shaped(v, row[self.value]), "filled": False, "jumped": length > 0 and not short if left is not None else i > 0})
            left = (int(i), v.tolist())
        return pd.DataFrame(out, columns=[*frame.columns, "filled", "jumped"]), left


def _run(rows: DataFrame, keys: list[str], processor: _Ordered, schema: StructType, ttl_ms: int | None) -> DataFrame:
    processor.ttl_ms = ttl_ms
    return rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "None" if ttl_ms is None else "ProcessingTime")


def stream_clips(detections: DataFrame, keys: list[str], gap: float, ts: str = "ts", ttl_ms: int | None = None) -> DataFrame:
    """Adds ``clip_index`` as the batch operator does: a gap of exactly ``gap`` splits. A row older than its track's last one is dropped."""
    return _run(detections, keys, _Clips(ts, gap), StructType([*detections.schema.fields]).add("clip_index", IntegerType()), ttl_ms)


def stream_rate_limit(rows: DataFrame, keys: list[str], interval: float, ts: str = "ts", ttl_ms: int | None = None) -> DataFrame:
    """Rows at least ``interval`` after the last of their key that passed."""
    return _run(rows, keys, _Rate(ts, interval), StructType([*rows.schema.fields]), ttl_ms)


def stream_fill_gaps(frames: DataFrame, keys: list[str], order: str, value: str, max_gap: int, ttl_ms: int | None = None) -> DataFrame:
    """Values in order with short gaps filled as soon as their right side is known; adds ``filled`` and ``jumped`` (frames are missing right before, because a gap was too long or at the start).

    ``value`` is a number or a pose: an array of numbers or of points. Poses of another number of coordinates than the one before are not filled towards. Frames without a value may come or not.
    """
    schema = StructType([*(StructField(f.name, f.dataType) for f in frames.schema)]).add("filled", BooleanType()).add("jumped", BooleanType())
    return _run(frames, keys, _Gaps(order, value, max_gap), schema, ttl_ms)


class Progress(StreamingQueryListener):
    """Counts rows and batches of streams as they finish, by the query's name."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows[p.name or str(p.id)] = self.rows.get(p.name or str(p.id), 0) + p.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.append(str(event.id))
