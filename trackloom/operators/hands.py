"""Hands that were not seen, made from the last one that was and the arm of the moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import let, minus, norm, plus, scaled
from .landmarks import ARMS, HAND_AXIS, arm_hand_ratio, rotation, turned

#: Fixed value: forearm over hand where no frame before tells.
DEFAULT_RATIO = 6.1


def _forearm(pose: Column, side: str) -> Column:
    elbow, wrist = ARMS[side]
    return minus(F.element_at(pose, elbow + 1), F.element_at(pose, wrist + 1))


def posed_hand(hand: Column, old_forearm: Column, pose: Column, ratio: Column, side: str) -> Column:
    """``hand`` turned as the forearm turned since it was seen, sized by the ratio, and put on the pose's wrist. Without an old forearm the hand is laid along the present one."""
    def of(d: Column) -> Column:
        a, b = (F.element_at(d["still"], i + 1) for i in HAND_AXIS)
        size = norm(d["forearm"]) / F.coalesce(ratio, F.lit(DEFAULT_RATIO)) / norm(minus(a, b))
        r = rotation(F.coalesce(old_forearm, minus(a, b)), d["forearm"])
        return let(F.struct(r.alias("r"), size.alias("size"), F.element_at(pose, ARMS[side][1] + 1).alias("at")), lambda m: F.transform(d["still"], lambda p: plus(scaled(turned(m["r"], p), m["size"]), m["at"])))

    still = F.transform(hand, lambda p: minus(p, F.element_at(hand, 1)))
    return let(F.struct(still.alias("still"), _forearm(pose, side).alias("forearm")), of)


def complete_hand(frames: DataFrame, keys: Sequence[str], order: str, side: str, neutral: list[list[float]], hand: str | None = None, pose: str = "pose") -> DataFrame:
    """Fills missing hands of ``side``.

    The hand seen last (of all frames, also those without a pose) is posed anew; before the first a ``neutral`` one. The forearm it is turned from is that of the frame it was seen in. The ratio is that of the first frame up to now that has both a pose and the hand. Frames without a pose keep a missing hand. Poses are expected filled already.
    """
    column = hand or f"{side}_hand"
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    elbow, wrist = (F.element_at(pose, i + 1) for i in ARMS[side])
    seen = F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("hand"), _forearm(F.col(pose), side).alias("forearm")))
    ratio = F.when(F.col(column).isNotNull() & F.col(pose).isNotNull(), arm_hand_ratio(elbow, wrist, F.col(column)))
    rows = frames.withColumn("_seen", F.last(seen, ignorenulls=True).over(w)).withColumn("_ratio", F.first(ratio, ignorenulls=True).over(w))
    default = F.array(*[F.array(*map(F.lit, map(float, p))) for p in neutral])
    made = posed_hand(F.coalesce("_seen.hand", default), F.col("_seen.forearm"), F.col(pose), F.col("_ratio"), side)
    return rows.withColumn(column, F.when(F.col(column).isNull() & F.col(pose).isNotNull(), made).otherwise(F.col(column))).drop("_seen", "_ratio")
