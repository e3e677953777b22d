"""What needs models or media tools, behind small interfaces, each with a deterministic stand-in.

A provider is named ``module:class``, so tasks make their own, once a task.
"""

from __future__ import annotations

import importlib
import zlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class FrameDecoder(Protocol):
    """Frames of a video in [start, end) seconds: number in the video, timestamp, picture. Of the frames in that range the first and every ``skip``-th after it come."""

    def fps(self, path: str) -> float: ...
    def frames(self, path: str, start: float, end: float | None, skip: int) -> Iterator[tuple[int, float, bytes]]: ...


class Camera(Protocol):
    """A live picture source: the seconds on its clock and the next picture, None where it has ended."""

    def read(self) -> tuple[float, bytes] | None: ...


class MediaProbe(Protocol):
    def probe(self, path: str) -> dict: ...


class Detector(Protocol):
    """Boxes of tracked people; keeps its tracks from frame to frame of one video."""

    def start(self, video: str) -> None: ...
    def track(self, frame_no: int, data: bytes) -> dict[str, list[float]]: ...


class PoseModel(Protocol):
    def pose(self, frame_no: int, data: bytes, box: list[float]) -> np.ndarray: ...


class Transcriber(Protocol):
    def segments(self, path: str) -> list[tuple[float, float, str]]: ...


class SpeechDetector(Protocol):
    def speech(self, path: str) -> list[tuple[float, float]]: ...


def load(name: str):
    module, _, kind = name.partition(":")
    return getattr(importlib.import_module(module), kind)()


def _seed(text: str) -> int:
    return zlib.crc32(text.encode())


class FakeDecoder:
    """Videos of 25 frames a second and 4 to 11 seconds, whose frames are their numbers as bytes."""

    def fps(self, path: str) -> float:
        return 25.0

    def frames(self, path, start, end, skip):
        total = 25 * (4 + _seed(path) % 8)
        last = total if end is None else min(total, int(np.ceil(end * 25)))
        for n in range(max(0, int(np.ceil(start * 25))), last, skip):
            yield n, n / 25.0, n.to_bytes(4, "little")


class FakeCamera:
    """Fifty pictures, one every tenth of a second of its own clock."""

    def __init__(self):
        self.n = 0

    def read(self):
        self.n += 1
        return ((self.n - 1) / 10.0, (self.n - 1).to_bytes(4, "little")) if self.n <= 50 else None


class FakeProbe:
    def probe(self, path):
        s = _seed(path)
        return {"height": (144, 360, 720)[s % 3], "fps": 25.0, "n_frames": 25 * (4 + s % 8), "format_s": float(4 + s % 8) if s % 5 else None, "stream_s": 4.0 if s % 7 else None}


class FakeDetector:
    """One or two people that drift to the right; now and then nobody."""

    def start(self, video):
        self.seed = _seed(video)

    def track(self, frame_no, data):
        people = 0 if frame_no % 40 >= 36 else 1 + self.seed % 2
        return {f"{k + 1}.0": [10.0 * k + frame_no, 20.0, 60.0 * (k + 1) + frame_no, 140.0] for k in range(people)}


class FakePose:
    """133 points in the box that swing with the frame number."""

    def pose(self, frame_no, data, box):
        i = np.arange(133)
        x1, y1, x2, y2 = box
        return np.stack((x1 + (x2 - x1) * (0.5 + 0.4 * np.sin(i + frame_no / 5)), y1 + (y2 - y1) * (i / 133), np.cos(i * 0.1 + frame_no / 7)), axis=1)


class FakeTranscriber:
    def segments(self, path):
        return [(2.0 * k, 2.0 * k + 1.5, f" line {k} of {_seed(path) % 100} ") for k in range(1 + _seed(path) % 3)]


class FakeSpeech:
    def speech(self, path):
        return [] if _seed(path) % 3 == 0 else [(0.0, 1.0)]


class FakeLister:
    def items(self, url):
        return [(f"{url}/{k}", f"item {k}") for k in range(_seed(url) % 4)]


#: Pictures that a task holds at a time.
FRAMES_AT_ONCE = 32
DETECTED = "source string, video string, person_id string, ts double, x1 double, y1 double, x2 double, y2 double"


def detect(frames: DataFrame, detector: str = "trackloom.providers:FakeDetector") -> DataFrame:
    """Detections of frames (source, video, frame_no, ts, data). A tracker needs a video's frames in order, so they are sorted inside partitions by video and streamed through it, a batch at a time."""

    def run(batches):
        own, at = load(detector), None
        for batch in batches:
            out = []
            for source, video, number, ts, data in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if (source, video) != at:
                    at = (source, video)
                    own.start(f"{source}/{video}")
                out += [(source, video, person, ts, *map(float, box[:4])) for person, box in own.track(number, data).items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["source", "video", "person_id", "ts", "x1", "y1", "x2", "y2"])

    keys = ("source", "video", "frame_no", "ts", "data")
    return frames.select(*keys).repartition("source", "video").sortWithinPartitions("source", "video", "frame_no").mapInArrow(run, DETECTED)


def track_videos(videos: DataFrame, rate: float, decoder: str, detector: str) -> DataFrame:
    """Detections of videos (source, video, path): each is decoded and tracked in the task that has its row, so frames never leave it and nothing is shuffled but the paths. Videos go one by one to ``spark.sql.shuffle.partitions`` tasks."""

    def run(batches):
        reader, own = load(decoder), load(detector)
        for batch in batches:
            for source, video, path in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own.start(f"{source}/{video}")
                out = [(source, video, person, ts, *map(float, box[:4])) for number, ts, data in reader.frames(path, 0.0, None, max(1, round(reader.fps(path) / rate))) for person, box in own.track(number, data).items()]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["source", "video", "person_id", "ts", "x1", "y1", "x2", "y2"])

    return videos.select("source", "video", "path").repartition("source", "video").mapInArrow(run, DETECTED)


def decode_frames(rows: DataFrame, videos: DataFrame, decoder: str) -> DataFrame:
    """Adds ``data``, the picture of each frame (source, video, frame_no), read in the task that has the rows of a video's clip, in runs of frames that follow each other."""
    paths = rows.join(videos.select("source", "video", "path"), ["source", "video"])
    dealt = paths.repartition("source", "video", "person_id", "clip_index").sortWithinPartitions("source", "video", "person_id", "clip_index", "frame_no")

    def run(batches):
        reader = load(decoder)
        for batch in batches:
            names = batch.schema.names
            path, number = (batch.column(names.index(c)).to_pylist() for c in ("path", "frame_no"))
            lo = 0
            while lo < batch.num_rows:
                hi = lo + 1
                while hi < min(batch.num_rows, lo + FRAMES_AT_ONCE) and path[hi] == path[lo] and number[hi] > number[hi - 1]:
                    hi += 1
                fps, asked = reader.fps(path[lo]), set(number[lo:hi])
                seen = {k: x for k, _, x in reader.frames(path[lo], number[lo] / fps, (number[hi - 1] + 1) / fps, 1) if k in asked}
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([seen.get(k) for k in number[lo:hi]], pa.binary())], names=[*names, "data"])
                lo = hi

    return dealt.mapInArrow(run, T.StructType([*dealt.schema.fields]).add("data", T.BinaryType())).drop("path")


def estimate_poses(frames: DataFrame, model: str = "trackloom.providers:FakePose") -> DataFrame:
    """Adds ``keypoints`` (133 x 3, null without a box) to frames with frame_no, data and box; the model is made once a task."""

    def run(batches):
        own = load(model)
        for batch in batches:
            names = batch.schema.names
            at = [batch.column(names.index(c)).to_pylist() for c in ("frame_no", "data", "box")]
            poses = [None if box is None else own.pose(n, d, box).tolist() for n, d, box in zip(*at, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(poses, pa.list_(pa.list_(pa.float64())))], names=[*names, "keypoints"])

    out = T.StructType([*frames.schema.fields]).add("keypoints", T.ArrayType(T.ArrayType(T.DoubleType())))
    return frames.mapInArrow(run, out)


def probe_media(videos: DataFrame, path: str = "path", probe: str = "trackloom.providers:FakeProbe") -> DataFrame:
    """Adds height, fps, n_frames and duration_s: the container's, else the stream's, else 0. What cannot be read is null."""

    def run(batches):
        own = load(probe)
        for batch in batches:
            names = batch.schema.names
            rows = [own.probe(p) or {} for p in batch.column(names.index(path)).to_pylist()]
            columns = [pa.array([r.get(k) for r in rows], t) for k, t in (("height", pa.int32()), ("fps", pa.float64()), ("n_frames", pa.int64()), ("format_s", pa.float64()), ("stream_s", pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*names, "height", "fps", "n_frames", "_format_s", "_stream_s"])

    out = T.StructType([*videos.schema.fields])
    for name, kind in (("height", T.IntegerType()), ("fps", T.DoubleType()), ("n_frames", T.LongType()), ("_format_s", T.DoubleType()), ("_stream_s", T.DoubleType())):
        out = out.add(name, kind)
    return videos.mapInArrow(run, out).withColumn("duration_s", F.coalesce("_format_s", "_stream_s", F.lit(0.0))).drop("_format_s", "_stream_s")


def listen(videos: DataFrame, path: str = "path", detector: str = "trackloom.providers:FakeSpeech") -> DataFrame:
    """Adds ``speech``: intervals, empty where nobody speaks, null where listening failed."""
    kind = pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())]))

    def one(own, p):
        try:
            return [{"start": a, "end": b} for a, b in own.speech(p)]
        except OSError:
            return None

    def run(batches):
        own = load(detector)
        for batch in batches:
            names = batch.schema.names
            found = [one(own, p) for p in batch.column(names.index(path)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*names, "speech"])

    return videos.mapInArrow(run, T.StructType([*videos.schema.fields]).add("speech", T.ArrayType(T.StructType().add("start", T.DoubleType()).add("end", T.DoubleType()))))


def transcribe(videos: DataFrame, path: str = "path", model: str = "trackloom.providers:FakeTranscriber") -> DataFrame:
    """Cues (source, video, seq, start, end, text) of videos (source, video and their path)."""

    def run(batches):
        own = load(model)
        for batch in batches:
            out = [(s, v, i, *map(float, seg[:2]), seg[2]) for s, v, p in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True) for i, seg in enumerate(own.segments(p))]
            if out:
                s, v, i, a, b, t = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(v), pa.array(i, pa.int32()), pa.array(a), pa.array(b), pa.array(t)], ["source", "video", "seq", "start", "end", "text"])

    return videos.select("source", "video", path).mapInArrow(run, "source string, video string, seq int, start double, end double, text string")
