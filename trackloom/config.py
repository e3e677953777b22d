"""Configuration: sources and options of every step, from YAML. Unknown keys are ignored, missing ones have defaults; only a source's name is required."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from . import schemas


def _of(kind: type, values: dict | None) -> Any:
    known = {f.name for f in fields(kind)}
    return kind(**{k: v for k, v in (values or {}).items() if k in known})


# The keys of the YAML file and their defaults.
@dataclass(frozen=True)
class Download:
    format: str = "(bestvideo[vcodec^=avc][height<=1080]/bestvideo[vcodec^=avc])+bestaudio[ext=m4a]/best"
    sub_langs: tuple[str, ...] = ("es.*",)
    cookies_from_browser: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "sub_langs", tuple(self.sub_langs))


@dataclass(frozen=True)
class Separation:
    delete_original: bool = False


@dataclass(frozen=True)
class Whisper:
    model: str = "large-v3-turbo"
    device: str = "cuda"
    language: str = "es"


@dataclass(frozen=True)
class BoundingBoxes:
    model_path: str = "models/yolo11m.pt"
    fps: int = 6
    batch_size: int = 32
    batch_queue: int = 32

    def __post_init__(self):
        object.__setattr__(self, "fps", int(self.fps))


@dataclass(frozen=True)
class Landmarks:
    fps: float = 6
    num_workers: int = 1
    max_clip_frame_separation: float = 1.0
    min_clip_duration_frames: int = 36
    moving_threshold: float = 0.25
    write_buffer_size: int = 160
    mode: str = "balanced"
    backend: str = "onnxruntime"
    device: str = "cuda"


@dataclass(frozen=True)
class Options:
    download: Download = field(default_factory=Download)
    video_audio_separation: Separation = field(default_factory=Separation)
    whisper: Whisper = field(default_factory=Whisper)
    bounding_boxes: BoundingBoxes = field(default_factory=BoundingBoxes)
    landmarks: Landmarks = field(default_factory=Landmarks)


@dataclass(frozen=True)
class Providers:
    """Who does what needs models or media tools, each as ``module:class``; there are no defaults, as stand-ins must be asked for."""

    lister: str | None = None
    worker: str | None = None
    probe: str | None = None
    decoder: str | None = None
    detector: str | None = None
    pose: str | None = None
    speech: str | None = None
    transcriber: str | None = None


@dataclass(frozen=True)
class Source:
    name: str
    url: str | None = None
    path: str | None = None
    subs: bool = False
    auto_subs: bool = False
    generate_subs: bool = False


@dataclass(frozen=True)
class Config:
    sources: tuple[Source, ...] = ()
    options: Options = field(default_factory=Options)
    providers: Providers = field(default_factory=Providers)

    def provider(self, name: str) -> str:
        """The provider of that name; a step that needs one which is not configured stops."""
        if not (found := getattr(self.providers, name)):
            raise ValueError(f"this step needs providers.{name} (module:class) in the configuration")
        return found

    @classmethod
    def from_dict(cls, values: dict) -> Config:
        for s in values.get("sources") or ():
            if "name" not in s:
                raise ValueError(f"a source needs a name: {s}")
        given = values.get("options") or {}
        kinds = {"download": Download, "video_audio_separation": Separation, "whisper": Whisper, "bounding_boxes": BoundingBoxes, "landmarks": Landmarks}
        return cls(tuple(_of(Source, s) for s in values.get("sources") or ()), Options(**{k: _of(kind, given.get(k)) for k, kind in kinds.items()}), _of(Providers, values.get("providers")))

    @classmethod
    def from_yaml(cls, path: str | Path) -> Config:
        import yaml

        return cls.from_dict(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})

    def sources_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(s.name, s.url, s.path, s.subs, s.auto_subs, s.generate_subs) for s in self.sources]
        return spark.createDataFrame(rows, schemas.SOURCES)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="trackloom")
    parser.add_argument("--config", required=True)
    parser.add_argument("--workdir", default=str(Path.cwd() / "working"))
    parser.add_argument("step", nargs="?", choices=("download", "separate", "sort", "transcribe", "boxes", "landmarks", "stats", "all"), default="all")
    return parser.parse_args(argv)
