"""Landmarks: parts of a whole-body pose, centring, feature vectors, overlay data.

Landmarks are arrays of [x, y, z]; a missing part is null, and NaN or infinity only stands in exports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import all_nan, cross, dot, let, minus, norm, unit

# Parts of the 133 whole-body points as (first, number), counted from 1; the six feet points after the body are not used.
BODY, FACE, LEFT_HAND, RIGHT_HAND = (1, 17), (24, 68), (92, 21), (113, 21)
# Hips of the 33-point pose and the pose points that the feature vector keeps, counted from 0.
HIPS = (23, 24)
FEATURE_POSE = (11, 12, 13, 14, 23, 24)
POSE_POINTS = 25
FACE_POINTS = 478
# Elbow and wrist of either arm in that pose, and the hand's wrist and middle knuckle.
ARMS = {"left": (13, 15), "right": (14, 16)}
HAND_AXIS = (0, 9)


def merge_keypoints(flat: Column, deep: Column) -> Column:
    """x and y from the 2-D points, z from the 3-D ones."""
    return F.zip_with(flat, deep, lambda a, b: F.array(F.element_at(a, 1), F.element_at(a, 2), F.element_at(b, 3)))


def split_keypoints(keypoints: Column) -> Column:
    """Struct (body, face, left_hand, right_hand) of the 133 points."""
    part = lambda at: F.slice(keypoints, *at)
    return F.struct(part(BODY).alias("body"), part(FACE).alias("face"), part(LEFT_HAND).alias("left_hand"), part(RIGHT_HAND).alias("right_hand"))


def to_arrays(landmarks: Column) -> Column:
    """Structs (x, y, z) as arrays."""
    return F.transform(landmarks, lambda p: F.array(p["x"], p["y"], p["z"]))


def trim_pose(pose: Column, points: int = POSE_POINTS) -> Column:
    """The first points; a pose without points is missing."""
    return F.when(F.size(pose) > 0, F.slice(pose, 1, points))


def hip_centre(pose: Column) -> Column:
    left, right = (F.element_at(pose, i + 1) for i in HIPS)
    return F.zip_with(right, left, lambda a, b: a - (a - b) / 2)


def centred(points: Column, centre: Column) -> Column:
    return F.transform(points, lambda p: minus(p, centre))


def make_hip_centric(pose: Column) -> Column:
    return let(hip_centre(pose), lambda centre: centred(pose, centre))


def wrist_centric(hand: Column) -> Column:
    """Fingers relative to the wrist; the wrist itself stays."""
    return let(F.element_at(hand, 1), lambda wrist: F.transform(hand, lambda p, i: F.when(i == 0, p).otherwise(minus(p, wrist))))


def feature_vector(pose: Column, left: Column, right: Column, face: Column, face_points: int = FACE_POINTS) -> Column:
    """One flat array: six pose points and both wrists relative to the hips, fingers relative to their wrist, the face as it is (infinity where it is missing)."""
    nowhere = F.array_repeat(F.array_repeat(F.lit(float("inf")), 3), face_points)

    def of(centre: Column) -> Column:
        kept = F.filter(centred(pose, centre), lambda p, i: i.isin(*FEATURE_POSE))
        fingers = lambda hand: let(centred(hand, centre), wrist_centric)
        return F.flatten(F.concat(kept, fingers(left), fingers(right), F.coalesce(face, nowhere)))

    return let(hip_centre(pose), of)


def arm_hand_ratio(elbow: Column, wrist: Column, hand: Column) -> Column:
    """Length of the forearm over that of the hand; null for a hand of no length."""
    a, b = (F.element_at(hand, i + 1) for i in HAND_AXIS)
    return F.try_divide(norm(minus(elbow, wrist)), norm(minus(a, b)))


def rotation(start: Column, to: Column) -> Column:
    """The rotation that brings the direction ``start`` to ``to``, as struct (axis, cos, sin).

    Directions as good as equal give none (cos 1, sin 0); opposite ones half a turn around an axis across ``start`` (with x, or with y where that is too short).
    """

    def of(d: Column) -> Column:
        a, b, c = d["a"], d["b"], dot(d["a"], d["b"])
        at = lambda i: F.element_at(a, i)
        zero = at(1) * 0.0
        with_x = F.array(zero, at(3), -at(2))
        across = F.when(at(2) * at(2) + at(3) * at(3) > 1e-12, with_x).otherwise(F.array(-at(3), zero, at(1)))
        return let(c, lambda c: F.when(c > 0.999999, F.struct(a.alias("axis"), F.lit(1.0).alias("cos"), F.lit(0.0).alias("sin"))).when(c < -0.999999, F.struct(unit(across).alias("axis"), F.lit(-1.0).alias("cos"), F.lit(0.0).alias("sin"))).otherwise(F.struct(unit(cross(a, b)).alias("axis"), c.alias("cos"), F.sqrt(F.greatest(F.lit(0.0), 1 - c * c)).alias("sin"))))

    return let(F.struct(unit(start).alias("a"), unit(to).alias("b")), of)


def turned(r: Column, v: Column) -> Column:
    """``v`` by the rotation ``r``."""
    return let(dot(r["axis"], v) * (1 - r["cos"]), lambda along: F.zip_with(F.zip_with(v, cross(r["axis"], v), lambda x, y: x * r["cos"] + y * r["sin"]), r["axis"], lambda x, k: x + k * along))


def rotate(v: Column, start: Column, to: Column) -> Column:
    """``v`` turned by the rotation that brings the direction ``start`` to ``to``."""
    return let(rotation(start, to), lambda r: turned(r, v))


def to_frame(landmarks: Column, x_start: Column, y_start: Column, x_size: Column, y_size: Column) -> Column:
    """Landmarks of a crop in coordinates of its frame; null without a crop or where all are NaN."""
    moved = F.transform(landmarks, lambda p: F.array(F.element_at(p, 1) * x_size + x_start, F.element_at(p, 2) * y_size + y_start, F.element_at(p, 3)))
    return F.when(x_start.isNotNull() & ~all_nan(landmarks), moved)


def to_pixels(landmarks: Column, width: Column, height: Column) -> Column:
    """Whole pixels [x, y] of landmarks in parts of the picture."""
    return F.transform(landmarks, lambda p: F.array((F.element_at(p, 1) * width).cast("int"), (F.element_at(p, 2) * height).cast("int")))


def needed_padding(pixels: Column, width: Column, height: Column) -> Column:
    """Struct (left, top, right, bottom): how far pixels stand out of the picture."""
    xs, ys = F.transform(pixels, lambda p: F.element_at(p, 1)), F.transform(pixels, lambda p: F.element_at(p, 2))
    out = lambda c: F.greatest(F.lit(0), c).cast("int")
    return F.struct(out(-F.array_min(xs)).alias("left"), out(-F.array_min(ys)).alias("top"), out(F.array_max(xs) - width + 1).alias("right"), out(F.array_max(ys) - height + 1).alias("bottom"))


def valid_points(frames: DataFrame, landmarks: str, keys: list[str]) -> DataFrame:
    """Rows (keys, point, x, y, z) of the points without NaN."""
    rows = frames.select(*keys, F.posexplode(landmarks).alias("point", "p"))
    return rows.where(F.forall("p", lambda x: ~F.isnan(x))).select(*keys, "point", *(F.element_at("p", i + 1).alias(c) for i, c in enumerate("xyz")))


def bones(points: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Segments (keys, a, b, x1, y1, x2, y2) whose two ends are there. ``edges`` (a, b) is a skeleton: some hundred rows at most."""
    end = lambda name, n: points.select(*keys, F.col("point").alias(name), F.col("x").alias(f"x{n}"), F.col("y").alias(f"y{n}"))
    return end("a", 1).join(F.broadcast(edges.select("a", "b")), "a").join(end("b", 2), [*keys, "b"]).select(*keys, "a", "b", "x1", "y1", "x2", "y2")


def hand_edges(spark: SparkSession) -> DataFrame:
    """The hand's skeleton: five fingers of four bones from the wrist, and the palm across the knuckles."""
    fingers = [(0 if j == 0 else 4 * f + j, 4 * f + j + 1) for f in range(5) for j in range(4)]
    palm = [(4 * f + 1, 4 * f + 5) for f in range(1, 4)]
    return spark.createDataFrame(fingers + palm, "a int, b int")


def pick_hands(hands: Column, strict: bool = False) -> Column:
    """Struct (left, right) from structs (side, points): of each side the last. Without ``strict`` whatever is not ``Right`` is left."""
    last = lambda keep: F.try_element_at(F.filter(hands, keep), F.lit(-1))["points"]
    return F.struct(last(lambda h: (h["side"] == "Left") if strict else (h["side"] != "Right")).alias("left"), last(lambda h: h["side"] == "Right").alias("right"))


def exported(points: Column, n: int, fill: float = float("nan")) -> Column:
    """Points for an export: a missing part is ``n`` points of ``fill``."""
    return F.coalesce(points, F.array_repeat(F.array_repeat(F.lit(fill), 3), n))
