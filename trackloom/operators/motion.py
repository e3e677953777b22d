"""Motion of a clip's bodies, and the verdict that discards still or short clips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import norm, unit

#: Body points that motion is measured on, as (first, number), counted from 1.
MOVING_POINTS = (6, 12)


def motion_feature(body: Column, first: int = MOVING_POINTS[0], number: int = MOVING_POINTS[1]) -> Column:
    """The moving points, each over its length, one after the other."""
    return F.flatten(F.transform(F.slice(body, first, number), unit))


def frame_changes(frames: DataFrame, keys: Sequence[str], order: str = "ts", body: str = "body", **points) -> DataFrame:
    """Frames with a body, with ``i`` (from 0 per clip) and ``change`` to the frame before (null for the first)."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = frames.where(F.col(body).isNotNull()).withColumn("_feature", motion_feature(F.col(body), **points))
    rows = rows.withColumn("i", (F.row_number().over(w) - 1).cast("bigint")).withColumn("_before", F.lag("_feature").over(w))
    return rows.withColumn("change", norm(F.zip_with("_feature", "_before", lambda a, b: a - b))).drop("_feature", "_before")


def verdicts(changes: DataFrame, keys: Sequence[str], fps: float, min_frames: int = 36, threshold: float = 0.25) -> DataFrame:
    """One row per clip: n, max_change, still, keep.

    A clip is still if it has more than ``min_frames`` frames and the largest of its first ``min_frames`` changes (a NaN counts as none) is below the threshold; what comes later cannot save it. A clip is kept unless it is still or has fewer frames than one second of them.
    """
    m = max(1, min_frames)
    counted = F.when((F.col("i") >= 1) & (F.col("i") <= m) & ~F.isnan("change"), F.col("change"))
    out = changes.groupBy(*keys).agg(F.count("*").alias("n"), F.greatest(F.lit(0.0), F.coalesce(F.max(counted), F.lit(0.0))).alias("max_change"))
    out = out.withColumn("still", (F.col("n") >= m + 1) & (F.col("max_change") < threshold))
    return out.withColumn("keep", ~F.col("still") & (F.col("n") >= fps))


def keep_moving(frames: DataFrame, keys: Sequence[str], fps: float, **options) -> DataFrame:
    """All frames of the clips that the verdict keeps; clips without any body go. Clip numbers keep their holes."""
    judged = verdicts(frame_changes(frames, keys), keys, fps, **options)
    return frames.join(judged.where("keep").select(*keys), [*keys], "left_semi")


def prefix_frames(grid: DataFrame, keys: Sequence[str], min_frames: int = 36) -> DataFrame:
    """The first ``min_frames`` + 1 frames of each clip: enough to tell still clips, so that the pose model need not see the rest of them."""
    w = Window.partitionBy(*keys).orderBy("frame_no")
    return grid.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= max(1, min_frames) + 1).drop("_i")
