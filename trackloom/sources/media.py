"""Work on media files as table operations: fetching, separating, resizing, cleaning up. What is done already is left out by an anti join, and every action leaves a row that says how it went."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..providers import load

RESULT = "target string, ok boolean, message string"
#: Fixed value: the height that videos are brought to.
HEIGHT = 144


def _act(worker: str, action: str):
    """Calls ``worker.action(source, target)`` row by row; an OSError or a text that is returned is a failure, not the end of the job."""

    def run(batches):
        own = getattr(load(worker), action)
        for batch in batches:
            messages = []
            for source, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    messages.append(own(source, target) or "")
                except OSError as e:
                    messages.append(str(e) or type(e).__name__)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([not m for m in messages]), pa.array(messages)], ["target", "ok", "message"])

    return run


def not_yet(wanted: DataFrame, archive: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What the archive does not list."""
    return wanted.join(archive.select(*keys), [*keys], "left_anti")


def fetch(items: DataFrame, archive: DataFrame, worker: str = "trackloom.sources.media:FakeWorker") -> DataFrame:
    """Results of fetching items (item, target) that the archive (item) does not list; an item is fetched once however often it is listed."""
    return not_yet(items, archive, ["item"]).select("item", "target").dropDuplicates(["item"]).mapInArrow(_act(worker, "fetch"), RESULT)


def archive_of(items: DataFrame, results: DataFrame) -> DataFrame:
    """What goes into the archive: items whose fetch is good."""
    return items.join(results.where("ok").select("target"), "target", "left_semi").select("item").distinct()


def separate(videos: DataFrame, existing: DataFrame, kind: str, worker: str = "trackloom.sources.media:FakeWorker") -> DataFrame:
    """Results of extracting ``audio`` or ``video`` of videos (path, target) whose target is not among ``existing`` (target)."""
    return not_yet(videos, existing, ["target"]).select("path", "target").mapInArrow(_act(worker, f"extract_{kind}"), RESULT)


def resize(videos: DataFrame, existing: DataFrame, height: int = HEIGHT, worker: str = "trackloom.sources.media:FakeWorker") -> DataFrame:
    """Results for every video (path, target, height): ``exists`` and ``already there`` without work, else those of the worker. An unknown height is worked on."""
    known = videos.join(existing.select("target").distinct().withColumn("_exists", F.lit(True)), "target", "left")
    skip = F.when(F.col("_exists"), "exists").when(F.col("height") == height, f"already {height}p")
    marked = known.withColumn("_skip", skip)
    left = marked.where("_skip is not null").select("target", F.lit(True).alias("ok"), F.col("_skip").alias("message"))
    return left.unionByName(marked.where("_skip is null").select("path", "target").mapInArrow(_act(worker, "resize"), RESULT))


def discard_files(paths: DataFrame, worker: str = "trackloom.sources.media:FakeWorker") -> DataFrame:
    """Results of deleting files (path); one that is not there is no failure of the job."""
    return paths.select("path", F.col("path").alias("target")).mapInArrow(_act(worker, "delete"), RESULT)


def failures(*results: DataFrame) -> DataFrame:
    """Rows of all results that are not good."""
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out.where("not ok")


def numbered(files: DataFrame, name: str = "name") -> DataFrame:
    """Adds ``number``, the one after the last hyphen of the stem, to order by; null without one."""
    stem = F.substring_index(F.col(name), ".", 1)
    return files.withColumn("number", F.regexp_extract(stem, r"-(\d+)$", 1).try_cast("int"))


class FakeWorker:
    """Does nothing, and fails for names that hold ``bad``."""

    def _do(self, source, target):
        if "bad" in source:
            raise OSError(f"cannot read {source}")

    fetch = extract_audio = extract_video = resize = delete = _do
