"""Detections of a track, cut into clips at time gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRACK = ("source", "video", "person_id")


def latest_per_timestamp(detections: DataFrame, keys: Sequence[str] = TRACK, ts: str = "ts", order: str | None = None) -> DataFrame:
    """One detection per track and timestamp; of several the last by ``order`` (else any) stays, as a later box overwrites an earlier one."""
    if order is None:
        return detections.dropDuplicates([*keys, ts])
    rest = [c for c in detections.columns if c not in (*keys, ts)]
    best = F.max_by(F.struct(*rest), F.col(order)).alias("_best")
    return detections.groupBy(*keys, ts).agg(best).select(*keys, ts, *(F.col(f"_best.{c}").alias(c) for c in rest)).select(detections.columns)


def sessionize(detections: DataFrame, gap, keys: Sequence[str] = TRACK, ts: str = "ts", tie: Sequence[str] = ()) -> DataFrame:
    """Adds ``clip_index``, from 0 per track. A clip ends where the previous timestamp plus ``gap`` is not after the next one, so a gap of exactly ``gap`` splits."""
    order = Window.partitionBy(*keys).orderBy(ts, *tie)
    previous = F.lag(ts).over(order)
    starts = F.when(previous.isNull() | ~(previous + F.lit(gap) > F.col(ts)), 1).otherwise(0)
    return detections.withColumn("_starts", starts).withColumn("clip_index", (F.sum("_starts").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int")).drop("_starts")


def summarize(clips: DataFrame, keys: Sequence[str] = TRACK, ts: str = "ts") -> DataFrame:
    """One row per clip: start, end, the largest width and height (each on its own), and its boxes' number."""
    return clips.groupBy(*keys, "clip_index").agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"), F.max(F.col("x2") - F.col("x1")).alias("max_w"), F.max(F.col("y2") - F.col("y1")).alias("max_h"), F.count("*").alias("n_boxes")
    )


def assemble(clips: DataFrame, keys: Sequence[str] = TRACK, ts: str = "ts") -> DataFrame:
    """One row per clip with its boxes in time order."""
    box = F.struct(F.col(ts).alias("ts"), F.array("x1", "y1", "x2", "y2").alias("box"))
    return clips.groupBy(*keys, "clip_index").agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.array_sort(F.collect_list(box)).alias("boxes"))


def in_batches(rows: DataFrame, size: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``batch``: consecutive rows of a key in batches of ``size``, the last may be smaller."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("bigint"))
