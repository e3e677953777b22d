"""Videos with and without subtitles, and where each stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stem_first_dot


def one_subtitle_per_stem(subtitles: DataFrame, name: str = "name", keys: tuple[str, ...] = ("source",)) -> DataFrame:
    """Subtitles ``stem.language.vtt`` as ``stem.vtt``; of several languages the least name stays."""
    stem = stem_first_dot(F.col(name))
    return subtitles.groupBy(*keys, stem.alias("stem")).agg(F.min(name).alias("original")).withColumn(name, F.concat("stem", F.lit(".vtt")))


def with_label(videos: DataFrame, subtitles: DataFrame, keys: tuple[str, ...] = ("source", "stem")) -> DataFrame:
    """Adds ``labeled``: whether a subtitle of the stem is there. One left join, so videos are read once."""
    there = subtitles.select(*keys).distinct().withColumn("_there", F.lit(True))
    return videos.join(there, [*keys], "left").withColumn("labeled", F.coalesce("_there", F.lit(False))).drop("_there")


def labeled(videos: DataFrame, subtitles: DataFrame, keys: tuple[str, ...] = ("source", "stem")) -> DataFrame:
    return videos.join(subtitles, [*keys], "left_semi")


def unlabeled(videos: DataFrame, subtitles: DataFrame, keys: tuple[str, ...] = ("source", "stem")) -> DataFrame:
    return videos.join(subtitles, [*keys], "left_anti")


def silent(speech: Column) -> Column:
    """No speech interval was found; null where nobody listened."""
    return F.size(speech) == 0


def status_after_sorting(subs: Column, auto: Column, generate: Column, has_vtt: Column, has_speech: Column) -> Column:
    """``labeled``, ``unlabeled`` or ``pending``: with subtitles of its own (``subs`` or ``auto`` sources) a video is labeled; sources that only take published ones leave the rest unlabeled; others keep what has speech pending and leave silent videos unlabeled. ``has_speech`` null (listening failed) is pending."""
    listened = F.when(has_speech.isNotNull() & ~has_speech, "unlabeled").otherwise("pending")
    return F.when((subs | auto) & has_vtt, "labeled").when(auto | generate, listened).otherwise("unlabeled")


def status_after_transcribing(status: Column, generate: Column) -> Column:
    """Pending videos of sources that generate subtitles become labeled; others stay pending."""
    return F.when((status == "pending") & generate, "labeled").otherwise(status)


def curate(videos: DataFrame, sources: DataFrame, subtitles: DataFrame) -> DataFrame:
    """Videos (source, stem, speech) of the configured sources with ``status`` after sorting and after transcribing."""
    flags = sources.select(F.col("name").alias("source"), "subs", "auto_subs", "generate_subs")
    rows = with_label(videos, subtitles).join(flags, "source")
    rows = rows.withColumn("sorted_status", status_after_sorting(F.col("subs"), F.col("auto_subs"), F.col("generate_subs"), F.col("labeled"), ~silent(F.col("speech"))))
    return rows.withColumn("status", status_after_transcribing(F.col("sorted_status"), F.col("generate_subs")))


def speech_counts(videos: DataFrame) -> DataFrame:
    """Per source: videos with speech, and silent ones; those that nobody could listen to count in neither."""
    return videos.groupBy("source").agg(F.count_if(F.size("speech") > 0).alias("with_speech"), F.count_if(silent(F.col("speech"))).alias("silent"))
