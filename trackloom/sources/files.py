"""Files as DataFrames: listings, detections, captions, URL lists, manifests, landmarks."""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import base_name, extension, path_category, source_of, stem_first_dot, stem_last_dot

#: Media extensions, for conversion and for statistics.
CONVERTIBLE = (".mp4", ".mkv", ".mov", ".avi", ".webm", ".flv", ".m4v")
COUNTED = (*CONVERTIBLE, ".mpg", ".mpeg")
#: Folders whose files are not videos.
NOT_VIDEO = ("audio", "subtitles")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return any(True for _ in (p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or ()))


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """path, name, stem (first dot), last_stem and extension of the files; contents are not read. A missing folder is empty."""
    if not exists(spark, path):
        rows = spark.createDataFrame([], "path string")
    else:
        rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path).select("path")
    name = base_name(F.col("path"))
    return rows.select("path", name.alias("name"), stem_first_dot(name).alias("stem"), stem_last_dot(name).alias("last_stem"), extension(name).alias("extension"))


def find_media(spark: SparkSession, inputs: list[str], recursive: bool = True, extensions: tuple[str, ...] = CONVERTIBLE) -> DataFrame:
    """Distinct media files of folders and globs, by extension; a file that is named itself is taken whatever its extension."""
    out = spark.createDataFrame([], "path string")
    for item in inputs:
        p = spark._jvm.org.apache.hadoop.fs.Path(item)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(p) and fs.getFileStatus(p).isFile():
            out = out.unionByName(spark.createDataFrame([(fs.getFileStatus(p).getPath().toString(),)], "path string"))
        else:
            out = out.unionByName(list_files(spark, item, recursive=recursive).where(F.col("extension").isin(*extensions)).select("path"))
    return out.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path")).distinct()


def media_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Media below ``root`` with source and category, without files in audio or subtitle folders."""
    rows = list_files(spark, root, recursive=True).where(F.col("extension").isin(*COUNTED))
    parts = F.split("path", "/")
    rows = rows.where(~F.arrays_overlap(parts, F.array(*map(F.lit, NOT_VIDEO))))
    return rows.select("path", "name", "stem", source_of(F.col("path")).alias("source"), path_category(F.col("path")).alias("category"))


def parse_frames(texts: DataFrame, text: str = "value", keys: tuple[str, ...] = ("source", "video")) -> DataFrame:
    """Detections of JSON texts, each a list of {timestamp, boxes by track}: one row per box. A frame without boxes has none; a repeated track in a frame counts with its last box."""
    frames = texts.select(*keys, F.inline(F.from_json(text, schemas.FRAMES_JSON)))
    pair = r'"((?:[^"\\]|\\.)*)"\s*:\s*\[([^\]]*)\]'
    numbers = lambda x: F.transform(F.split(F.regexp_replace(x, r'[\s"]', ""), ","), lambda n: n.try_cast("double"))
    found = F.transform(F.regexp_extract_all("boxes", F.lit(pair), F.lit(0)), lambda m: F.struct(F.regexp_extract(m, pair, 1).alias("id"), numbers(F.regexp_extract(m, pair, 2)).alias("box")))
    rows = frames.select(*keys, "timestamp", found.alias("found"))
    last = F.filter("found", lambda p, i: ~F.exists(F.slice("found", i + 2, F.size("found")), lambda q: q["id"] == p["id"]))
    boxes = rows.select(*keys, F.col("timestamp").alias("ts"), F.explode(last).alias("b")).select(*keys, "ts", F.col("b.id").alias("person_id"), F.col("b.box").alias("box"))
    return boxes.select(*keys, "person_id", "ts", *(F.try_element_at("box", F.lit(i + 1)).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))))


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """Detections of the JSON files at ``path`` (.../source/status/boxes/file): keyed by source and the file's name up to its last dot."""
    rows = spark.read.text(path, wholetext=True).withColumn("_path", F.input_file_name())
    return parse_frames(rows.select("value", F.coalesce(source_of(F.col("_path")), F.lit("")).alias("source"), stem_last_dot(base_name(F.col("_path"))).alias("video")))


def frames_json(detections: DataFrame, keys: tuple[str, ...] = ("source", "video")) -> DataFrame:
    """One JSON text per video from detections, frames in time order."""
    box = F.struct("person_id", F.array("x1", "y1", "x2", "y2").alias("box"))
    frames = detections.groupBy(*keys, "ts").agg(F.map_from_entries(F.array_sort(F.collect_list(box))).alias("boxes"))
    rows = frames.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("ts").alias("timestamp"), F.to_json("boxes").alias("boxes")))).alias("f"))
    one = lambda f: F.concat(F.lit('{"timestamp":'), f["timestamp"].cast("string"), F.lit(',"boxes":'), f["boxes"], F.lit("}"))
    return rows.select(*keys, F.concat(F.lit("["), F.array_join(F.transform("f", one), ","), F.lit("]")).alias("value"))


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    """Whole caption files: source, stem, vtt. A missing folder is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], "source string, stem string, vtt string")
    rows = spark.read.text(path, wholetext=True).withColumn("_path", F.input_file_name())
    return rows.select(F.coalesce(source_of(F.col("_path")), F.lit("")).alias("source"), stem_first_dot(base_name(F.col("_path"))).alias("stem"), F.col("value").alias("vtt"))


def captions_of(videos: DataFrame, captions: DataFrame) -> DataFrame:
    """Adds ``subtitles``: the caption text of labeled videos, else an empty text."""
    text = captions.select("source", "stem", F.col("vtt").alias("_vtt"))
    return videos.join(text, ["source", "stem"], "left").withColumn("subtitles", F.when(F.col("labeled"), F.coalesce("_vtt", F.lit(""))).otherwise("")).drop("_vtt")


def with_audio(videos: DataFrame, audio: DataFrame) -> DataFrame:
    """Adds ``audio``: the path of the sound file of the same source and stem, else null; of several files the first by path."""
    first = audio.groupBy("source", "stem").agg(F.min("path").alias("audio"))
    return videos.join(first, ["source", "stem"], "left")


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """The list's lines that are not blank, as ``url``."""
    return spark.read.text(path).select(F.trim("value").alias("url")).where("url <> ''")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """What earlier runs finished; empty where no run has been. Unknown counts as not done."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.MANIFEST)
    return spark.read.schema(schemas.MANIFEST).parquet(path).withColumn("done", F.coalesce("done", F.lit(False)))


def write_landmarks(frames: DataFrame, path: str, mode: str = "append") -> None:
    """Landmark frames by source and label; a commit is whole or not there."""
    frames.write.mode(mode).partitionBy("source", "labeled").parquet(path)


def read_landmarks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_neutral_hand(spark: SparkSession, path: str) -> list[list[float]]:
    """The hand that ``operators.hands.complete_hand`` starts from: 21 points (x, y, z) of a NumPy file in any store that Spark reads. Any other shape is an error."""
    data = spark.read.format("binaryFile").load(path).select("content").head()[0]
    hand = np.load(io.BytesIO(data), allow_pickle=False)
    if hand.shape != (21, 3):
        raise ValueError(f"{path}: a hand has 21 points of 3 numbers, not {hand.shape}")
    return hand.astype(float).tolist()


def heights_json(videos: DataFrame) -> DataFrame:
    """One JSON object of heights by name; unknown heights are null."""
    return videos.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("video", F.col("height").cast("int")))))).alias("value"))


def output_path(path, root: str, target: str, new_extension: str = ".mp4"):
    """Where a converted file goes: its place below ``root`` kept below ``target``, with another extension."""
    return F.concat(F.lit(target.rstrip("/") + "/"), F.regexp_replace(F.replace(path, F.lit(root.rstrip("/") + "/"), F.lit("")), r"\.[^./]*$", new_extension))
