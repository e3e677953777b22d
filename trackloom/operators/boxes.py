"""Boxes: sizes, padded crops, rescaling, repaired timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: crops are this much larger than the clip's largest box.
PADDING = 1.2


def crop_region(x1: Column, y1: Column, x2: Column, y2: Column, max_w: Column, max_h: Column, padding: float = PADDING) -> Column:
    """Struct (y_start, y_end, x_start, x_end) around the box's centre; the low side is cut at 0, numbers are cut to whole ones, the high side is left to the reader of the frame."""
    cut = lambda c: c.cast("int")
    side = lambda low, high, most: (low + (high - low) / 2, most * padding / 2)
    (cx, dx), (cy, dy) = side(x1, x2, max_w), side(y1, y2, max_h)
    return F.struct(cut(F.greatest(F.lit(0.0), cy - dy)).alias("y_start"), cut(cy + dy).alias("y_end"), cut(F.greatest(F.lit(0.0), cx - dx)).alias("x_start"), cut(cx + dx).alias("x_end"))


def preview_region(x1: Column, y1: Column, x2: Column, y2: Column, max_w: Column, max_h: Column, padding: float = PADDING) -> Column:
    """Struct (x_start, y_start, x_size, y_size): as ``crop_region``, but cutting the start does not shrink the size."""
    dx, dy = max_w * padding / 2, max_h * padding / 2
    start = lambda low, high, d: F.greatest(F.lit(0.0), low + (high - low) / 2 - d).cast("int")
    return F.struct(start(x1, x2, dx).alias("x_start"), start(y1, y2, dy).alias("y_start"), (dx * 2).cast("int").alias("x_size"), (dy * 2).cast("int").alias("y_size"))


def rescale_box(box: Column, scale: Column, width: Column, height: Column) -> Column:
    """[x1, y1, x2, y2] times ``scale``, rounded half to even, inside the picture, corners in order. A box that is null or has fewer than four values is left as it is; what stands after the fourth is cut."""
    at = lambda i, most: F.greatest(F.lit(0), F.least(F.bround(F.element_at(box, i) * scale).cast("int"), (most - 1).cast("int")))
    x1, y1, x2, y2 = at(1, width), at(2, height), at(3, width), at(4, height)
    whole = F.array(F.least(x1, x2), F.least(y1, y2), F.greatest(x1, x2), F.greatest(y1, y2))
    return F.when(F.size(box) >= 4, F.transform(whole, lambda x: x.cast("double"))).otherwise(box)


def rescale_boxes(boxes: Column, scale: Column, width: Column, height: Column) -> Column:
    """:func:`rescale_box` over a map of boxes by track."""
    return F.transform_values(boxes, lambda _, b: rescale_box(b, scale, width, height))


def box_scale(height: Column, detected_height: int = 144) -> Column:
    """Factor from the height that boxes were detected at."""
    return height / F.lit(float(detected_height))


def frame_number_to_seconds(rows: DataFrame, fps: Column, column: str = "ts") -> DataFrame:
    """Repairs timestamps that are frame numbers; null where the rate is 0."""
    return rows.withColumn(column, F.try_divide(F.col(column), fps))
