"""From detections to a landmark dataset.

detections -> clips -> frame grid -> box of the moment -> pose -> parts -> verdict -> kept frames. Everything up to the verdict is keyed by track, and the pose model runs in two phases: on the first frames of every clip, which suffice to tell still clips and those under a second, then on the rest of the clips that are not still.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Landmarks
from ..operators import asof, clips, frames, landmarks, motion
from ..providers import estimate_poses

CLIP = ("source", "video", "person_id", "clip_index")


def clip_frames(detections: DataFrame, videos: DataFrame, options: Landmarks, order: str = "x1") -> tuple[DataFrame, DataFrame]:
    """Clips, and their sampled frames with the box of the moment (strictly before the frame, else the clip's first). Of several boxes of a track at one time the last by ``order`` counts."""
    cut = clips.sessionize(clips.latest_per_timestamp(detections, order=order), options.max_clip_frame_separation)
    summary = clips.summarize(cut)
    grid = frames.frame_grid(summary.join(videos.select("source", "video", "fps", "n_frames"), ["source", "video"]), options.fps, total="n_frames").select(*CLIP, "frame_no", "ts")
    boxes = cut.select(*CLIP, "ts", F.array("x1", "y1", "x2", "y2").alias("box"))
    return summary, asof.backward(grid, boxes, CLIP, ["box"])


def with_parts(frames_: DataFrame) -> DataFrame:
    return frames_.withColumn("_p", landmarks.split_keypoints(F.col("keypoints"))).select(*(c for c in frames_.columns if c not in ("keypoints", "data")), "_p.body", "_p.left_hand", "_p.right_hand", "_p.face")


def landmark_dataset(detections: DataFrame, videos: DataFrame, options: Landmarks | None = None, pose: str = "trackloom.providers:FakePose", decode=None, first_at: str | None = None) -> DataFrame:
    """Landmark frames of the clips that are kept.

    ``decode`` adds ``data`` to frames (by default none, for models that need only boxes); the caller writes the result with :func:`trackloom.sources.files.write_landmarks`. With ``first_at`` the first phase is written there, so that a lost executor does not run the model again; else it is cached until the caller clears the cache.
    """
    options = options or Landmarks()
    decode = decode or (lambda rows: rows.withColumn("data", F.lit(None).cast("binary")))
    _, grid = clip_frames(detections, videos, options)
    m = max(1, options.min_clip_duration_frames)
    first = with_parts(estimate_poses(decode(motion.prefix_frames(grid, CLIP, max(m, math.ceil(options.fps) - 1))), pose))
    if first_at is None:
        first = first.persist()
    else:
        first.write.mode("overwrite").parquet(first_at)
        first = detections.sparkSession.read.parquet(first_at)
    judged = motion.verdicts(motion.frame_changes(first, CLIP, "frame_no"), CLIP, options.fps, m, options.moving_threshold)
    keep = judged.where("keep").select(*CLIP)
    rest = grid.join(keep, [*CLIP], "left_semi").join(first.select(*CLIP, "frame_no"), [*CLIP, "frame_no"], "left_anti")
    return first.join(keep, [*CLIP], "left_semi").unionByName(with_parts(estimate_poses(decode(rest), pose)))
