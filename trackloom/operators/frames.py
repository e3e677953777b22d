"""Sampled frames of clips, and joins of points with intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frame_skip(fps: Column, rate: Column) -> Column:
    """Every how many frames one is kept: fps / rate, rounded half to even, at least 1."""
    return F.greatest(F.lit(1), F.bround(fps.cast("double") / rate.cast("double")).cast("bigint")).cast("bigint")


def sampled(frame_no: Column, fps: Column, rate: Column) -> Column:
    return F.pmod(frame_no, frame_skip(fps, rate)) == 0


def frame_grid(clips: DataFrame, rate: float, fps: str = "fps", start: str = "start", end: str = "end", total: str | None = None) -> DataFrame:
    """The frames of every clip, straight from its bounds: numbers from int(start * fps) up to, not with, int(end * fps), below ``total``, that the sampling keeps. Adds ``frame_no`` and ``ts``; a clip without such a number has no row."""
    f = F.col(fps).cast("double")
    skip = frame_skip(f, F.lit(float(rate)))
    low = F.ceil((F.col(start) * f).cast("bigint") / skip) * skip
    high = (F.col(end) * f).cast("bigint") - 1
    if total is not None:
        high = F.least(high, F.col(total) - 1)
    numbers = F.when(low <= high, F.sequence(low.cast("bigint"), F.greatest(low, high).cast("bigint"), skip)).otherwise(F.array().cast("array<bigint>"))
    return clips.withColumn("frame_no", F.explode(numbers)).withColumn("ts", F.col("frame_no") / f)


def in_interval(points: DataFrame, intervals: DataFrame, keys: Sequence[str], point: str, start: str, end: str, width: float, closed: bool = True) -> DataFrame:
    """Points with every interval of their key that holds them, by an equi-join on the key and buckets of ``width``; an interval stands in each bucket it touches."""
    cell = lambda x: F.floor(F.col(x) / F.lit(width)).cast("bigint")
    left = points.withColumn("_cell", cell(point))
    right = intervals.where(F.col(start) <= F.col(end)).withColumn("_cell", F.explode(F.sequence(cell(start), cell(end))))
    upper = F.col(point) <= F.col(end) if closed else F.col(point) < F.col(end)
    joined = left.join(right, [*keys, "_cell"]).where((F.col(point) >= F.col(start)) & upper)
    return joined.drop("_cell")


def frame_at(ts: Column, fps: Column) -> Column:
    """The number of the frame shown at a time."""
    return (ts * fps).cast("bigint")


def in_range(ts: Column, start: Column, end: Column | None) -> Column:
    """Half-open range; without an end it is open."""
    return (ts >= start) if end is None else (ts >= start) & (ts < end)
