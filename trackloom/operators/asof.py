"""As-of joins of frames with boxes.

Both sides are united and one window carries the last box forward: one shuffle and one sort on the key, where a join on a time condition would compare every frame with every box of its key. With ``bucket`` a key's rows are split over time and the last box of the buckets before is carried in, so a key with a large share of all rows is no single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _united(frames: DataFrame, boxes: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], boxes_first: bool) -> DataFrame:
    """Rows of both sides: keys, ts, _side (orders equal timestamps), _row (a frame's columns), _box (a box's values)."""
    left = frames.select(*keys, ts, F.lit(1).alias("_side"), F.struct(*frames.columns).alias("_row"), F.lit(None).cast(boxes.select(F.struct(ts, *values)).schema[0].dataType).alias("_box"))
    right = boxes.select(*keys, ts, F.lit(0 if boxes_first else 2).alias("_side"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), F.struct(ts, *values).alias("_box"))
    return left.unionByName(right)


def _flat(rows: DataFrame, frames: DataFrame, box: Column, values: Sequence[str]) -> DataFrame:
    return rows.select(*(F.col(f"_row.{c}").alias(c) for c in frames.columns), *(box[v].alias(v) for v in values))


def backward(frames: DataFrame, boxes: DataFrame, keys: Sequence[str], values: Sequence[str], ts: str = "ts", *, strict: bool = True, first_if_none: bool = True, bucket: float | None = None) -> DataFrame:
    """Each frame with the values of its key's last box before it (``strict``) or not after it.

    A frame before every box gets the key's first box if ``first_if_none``, else nulls; a key without boxes always gives nulls. ``boxes`` has one row per key and timestamp.
    """
    rows = _united(frames, boxes, keys, ts, values, boxes_first=not strict)
    part = [*keys]
    if bucket is not None:
        rows = rows.withColumn("_bucket", F.floor(F.col(ts) / F.lit(bucket)))
        part.append("_bucket")
    upto = Window.partitionBy(*part).orderBy(ts, "_side").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*part)
    rows = rows.withColumn("_last", F.last("_box", ignorenulls=True).over(upto))
    if bucket is None:
        rows = rows.withColumn("_first", F.min("_box").over(whole))
    else:
        each = rows.where("_box is not null").groupBy(*part).agg(F.min("_box").alias("_least"), F.max("_box").alias("_most"))
        spots = rows.select(*part).distinct().join(each, part, "left")
        along = Window.partitionBy(*keys).orderBy("_bucket")
        carried = spots.select(*part, F.last("_most", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"), F.min("_least").over(Window.partitionBy(*keys)).alias("_first"))
        rows = rows.join(carried, part).withColumn("_last", F.coalesce("_last", "_carried"))
    box = F.coalesce("_last", "_first") if first_if_none else F.col("_last")
    return _flat(rows.where("_row is not null").withColumn("_use", box), frames, F.col("_use"), values)


def nearest(frames: DataFrame, boxes: DataFrame, keys: Sequence[str], values: Sequence[str], ts: str = "ts") -> DataFrame:
    """Each frame with the values of its key's nearest box, however far; of two as near the earlier."""
    rows = _united(frames, boxes, keys, ts, values, boxes_first=True)
    order = Window.partitionBy(*keys).orderBy(ts, "_side")
    rows = rows.withColumn("_before", F.last("_box", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_after", F.first("_box", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)))
    sooner = F.col("_after").isNull() | ((F.col(ts) - F.col(f"_before.{ts}")) <= (F.col(f"_after.{ts}") - F.col(ts)))
    rows = rows.where("_row is not null").withColumn("_use", F.when(F.col("_before").isNotNull() & sooner, F.col("_before")).otherwise(F.col("_after")))
    return _flat(rows, frames, F.col("_use"), values)
