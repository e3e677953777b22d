"""``python -m trackloom.cli --config c.yaml --workdir w STEP`` under spark-submit: download, separate, sort, transcribe, boxes, landmarks, stats, or all of them.

The working folder holds ``videos/{source}/...`` as fetched; results are tables below ``tables``. What a table or manifest has as done is not done again. Models and media tools are the providers that the configuration names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config, parse_args
from .operators import captions, curation, merge, stats
from .plans.landmarks import landmark_dataset
from .providers import decode_frames, listen, probe_media, track_videos, transcribe
from .sources import files, media
from .sources.frames import ChannelSource

KEYS = ["source", "video"]


def catalog(spark: SparkSession, workdir: str) -> DataFrame:
    """Every mp4 file below ``videos/{source}``: source, video (name up to its last dot), stem, path."""
    rows = files.list_files(spark, f"{workdir}/videos", "*.mp4", recursive=True)
    source = F.regexp_extract("path", r"/videos/([^/]+)/", 1)
    return rows.select(source.alias("source"), F.col("last_stem").alias("video"), "stem", "path").dropDuplicates(KEYS)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)


def download(spark: SparkSession, config: Config, workdir: str) -> DataFrame:
    """Results of fetching what the sources' channels list and the archive does not: item, target, ok, message."""
    spark.dataSource.register(ChannelSource)
    urls = {s.url: s.name for s in config.sources if s.url}
    listed = spark.read.format("channel").option("urls", "\n".join(urls)).option("lister", config.provider("lister")).load()
    named = listed.join(F.broadcast(spark.createDataFrame(list(urls.items()), "url string, source string")), "url")  # one row a configured source
    items = named.select("item", F.concat(F.lit(f"{workdir}/videos/"), "source", F.lit("/"), F.sha2("item", 256), F.lit(".mp4")).alias("target"))
    archive = _table(spark, f"{workdir}/tables/archive", "item string")
    return media.fetch(items, archive, config.provider("worker")).join(items.dropDuplicates(["item"]), "target").select("item", "target", "ok", "message")


def sort_videos(spark: SparkSession, config: Config, workdir: str) -> DataFrame:
    """Videos of the configured sources with their status."""
    subtitles = files.list_files(spark, f"{workdir}/videos", "*.vtt", recursive=True).select(F.regexp_extract("path", r"/videos/([^/]+)/", 1).alias("source"), "name")
    heard = listen(catalog(spark, workdir), detector=config.provider("speech"))
    return curation.curate(heard, config.sources_frame(spark), curation.one_subtitle_per_stem(subtitles))


def ready(videos: DataFrame, transcribed: DataFrame) -> DataFrame:
    """Videos that are labeled or unlabeled now; those whose captions are still to be made are not among them."""
    waiting = (F.col("sorted_status") == "pending") & (F.col("status") == "labeled")
    made = videos.where(waiting).join(transcribed.select(*KEYS), KEYS, "left_semi")
    return videos.where(F.col("status").isin("labeled", "unlabeled") & ~waiting).unionByName(made)


def run(spark: SparkSession, config: Config, workdir: str, step: str = "all") -> None:
    at = lambda name: f"{workdir}/tables/{name}"
    wanted = lambda name: step in (name, "all")
    if step == "download" or (step == "all" and any(s.url for s in config.sources)):
        download(spark, config, workdir).write.mode("append").parquet(at("downloads"))
        media.archive_of(spark.read.parquet(at("downloads")).select("item", "target"), spark.read.parquet(at("downloads"))).write.mode("overwrite").parquet(at("archive_next"))
        spark.read.parquet(at("archive_next")).write.mode("overwrite").parquet(at("archive"))
    if step == "separate" or (step == "all" and config.providers.worker):
        rows = catalog(spark, workdir)
        for kind, folder, ending in (("audio", "audio", ".mp3"), ("video", "silent", ".mp4")):
            there = files.list_files(spark, f"{workdir}/{folder}", f"*{ending}", recursive=True).select(F.concat_ws("/", F.lit(f"{workdir}/{folder}"), F.regexp_extract("path", rf"/{folder}/([^/]+/[^/]+)$", 1)).alias("target"))
            target = F.concat(F.lit(f"{workdir}/{folder}/"), "source", F.lit("/"), "video", F.lit(ending))
            results = media.separate(rows.select("path", target.alias("target")), there, kind, config.provider("worker"))
            results.withColumn("kind", F.lit(kind)).write.mode("append").parquet(at("separations"))
    if wanted("sort"):
        sort_videos(spark, config, workdir).drop("speech").write.mode("overwrite").parquet(at("videos"))
    transcribed = lambda: _table(spark, at("captions"), "source string, video string, vtt string")
    if step == "transcribe" or (step == "all" and any(s.generate_subs for s in config.sources)):
        videos = spark.read.parquet(at("videos")).where("sorted_status = 'pending' and status = 'labeled'").join(transcribed().select(*KEYS), KEYS, "left_anti")
        cues = transcribe(videos, model=config.provider("transcriber"))
        captions.write_vtt(cues, KEYS).write.mode("append").parquet(at("captions"))
    if wanted("boxes"):
        todo = merge.todo(ready(spark.read.parquet(at("videos")), transcribed()), _table(spark, at("detected"), "source string, video string, done boolean"))
        todo.select(*KEYS, "path").write.mode("overwrite").parquet(at("detect_next"))
        todo = spark.read.parquet(at("detect_next"))
        track_videos(todo, config.options.bounding_boxes.fps, config.provider("decoder"), config.provider("detector")).write.mode("append").parquet(at("detections"))
        todo.select(*KEYS, F.lit(True).alias("done")).write.mode("append").parquet(at("detected"))  # also videos with nobody in them
    if wanted("landmarks"):
        # Only videos that were searched for people count as done afterwards.
        videos = ready(spark.read.parquet(at("videos")), transcribed()).join(spark.read.parquet(at("detected")).select(*KEYS).distinct(), KEYS, "left_semi")
        merge.todo(probe_media(videos, probe=config.provider("probe")), files.read_manifest(spark, at("manifest"))).write.mode("overwrite").parquet(at("landmarks_next"))
        todo = spark.read.parquet(at("landmarks_next"))
        found = spark.read.parquet(at("detections")).join(todo.select(*KEYS), KEYS, "left_semi")
        labels = todo.select(*KEYS, (F.col("status") == "labeled").alias("labeled"), "fps")
        made = landmark_dataset(found, todo, config.options.landmarks, config.provider("pose"), lambda rows: decode_frames(rows, todo, config.provider("decoder")), at("landmarks_first"))
        files.write_landmarks(made.join(labels.select(*KEYS, "labeled"), KEYS), at("landmarks"))
        labels.withColumn("done", F.lit(True)).write.mode("append").parquet(at("manifest"))
    if wanted("stats"):
        rows = probe_media(spark.read.parquet(at("videos")), probe=config.provider("probe"))
        stats.report_lines(stats.report(rows.select("source", F.col("status").alias("category"), F.col("duration_s").alias("seconds")))).orderBy("is_total", "source").select("line").show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("trackloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run(spark, Config.from_yaml(args.config), args.workdir, args.step)


if __name__ == "__main__":
    main()
