"""Decoded frames as a data source, and fetching as a table function; decoders are providers (see ``providers``)."""

from __future__ import annotations

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader


class FrameSource(DataSource):
    """``spark.read.format("frames")``: sampled frames of videos, one partition per video.

    Options: ``videos`` (paths by lines), ``rate``, ``start``, ``end`` (half-open, seconds), ``decoder`` (``module:class``). Rows: path, frame_no, ts, data. For tables of videos see ``providers.track_videos``, which needs no list of paths. Sampling and range reach the decoder, so that frames that nobody asked for are not converted.
    """

    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return "path string, frame_no bigint, ts double, data binary"

    def reader(self, schema):
        return FrameReader(self.options)


class VideoPartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


class FrameReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options.get("videos", "").split("\n") if p]
        self.rate, self.start = float(options.get("rate", "6")), float(options.get("start", "0"))
        self.end = float(options["end"]) if "end" in options else None
        self.decoder = options.get("decoder", "trackloom.providers:FakeDecoder")

    def partitions(self):
        return [VideoPartition(p) for p in self.paths]

    def read(self, partition):
        from ..providers import load

        decoder = load(self.decoder)
        fps = decoder.fps(partition.path)
        skip = max(1, round(fps / self.rate))
        for number, ts, data in decoder.frames(partition.path, self.start, self.end, skip):
            yield partition.path, number, ts, data


class CameraSource(DataSource):
    """``spark.readStream.format("camera")``: a live camera, at most ``fps`` pictures a second of its clock; a picture that comes earlier than 1 / ``fps`` after the last one kept is dropped.

    Options: ``camera`` (``module:class``), ``fps``, ``batch`` (pictures read at most a micro-batch). Rows: frame_no (of all pictures, dropped ones too), ts, data. One machine has the camera, so the driver reads it. A camera cannot go back: pictures of a batch that a restarted query asks for again are gone, and such a batch is empty.
    """

    @classmethod
    def name(cls) -> str:
        return "camera"

    def schema(self) -> str:
        return "frame_no bigint, ts double, data binary"

    def simpleStreamReader(self, schema):
        return CameraReader(self.options)


class CameraReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.name, self.gap, self.batch = options.get("camera", "trackloom.providers:FakeCamera"), 1 / float(options.get("fps", "24")), int(options.get("batch", "256"))
        self.camera, self.kept_at = None, None

    def initialOffset(self) -> dict:
        return {"frame": 0}

    def read(self, start: dict):
        from ..providers import load

        self.camera = self.camera or load(self.name)
        rows, at = [], start["frame"]
        for _ in range(self.batch):
            if (shot := self.camera.read()) is None:
                break
            if self.kept_at is None or shot[0] - self.kept_at >= self.gap:
                self.kept_at = shot[0]
                rows.append((at, *shot))
            at += 1
        return iter(rows), {"frame": at}

    def readBetweenOffsets(self, start: dict, end: dict):
        return iter([])

    def commit(self, end: dict) -> None:
        pass


class ChannelSource(DataSource):
    """``spark.read.format("channel")``: what a channel lists, without fetching it. Options: ``urls`` (by lines), ``lister`` (``module:class``). Rows: url, item, title; something that is no playlist lists itself."""

    @classmethod
    def name(cls) -> str:
        return "channel"

    def schema(self) -> str:
        return "url string, item string, title string"

    def reader(self, schema):
        return ChannelReader(self.options)


class ChannelReader(DataSourceReader):
    def __init__(self, options):
        self.urls, self.lister = [u for u in options.get("urls", "").split("\n") if u], options.get("lister", "trackloom.providers:FakeLister")

    def partitions(self):
        return [VideoPartition(u) for u in self.urls]

    def read(self, partition):
        from ..providers import load

        for item, title in load(self.lister).items(partition.path) or [(partition.path, "")]:
            yield partition.path, item, title
