"""Durations by source, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import format_hours


def by_category(videos: DataFrame, source: str = "source", category: str = "category", seconds: str = "seconds") -> DataFrame:
    """count and seconds per source and category; unknown durations count as 0."""
    return videos.groupBy(source, category).agg(F.count("*").alias("videos"), F.sum(F.coalesce(seconds, F.lit(0.0))).alias("seconds"))


def report(videos: DataFrame, source: str = "source", category: str = "category", seconds: str = "seconds") -> DataFrame:
    """Per source and in total (source ``TOTAL``): videos and seconds, labeled, unlabeled (with what is neither), together. One pass, by rollup."""
    is_labeled, s = F.col(category) == "labeled", F.coalesce(F.col(seconds), F.lit(0.0)).cast("double")
    n = lambda c: F.sum(c.cast("bigint"))
    rows = videos.rollup(source).agg(
        F.grouping(source).alias("_all"), n(is_labeled).alias("labeled"), n(~is_labeled).alias("unlabeled"), F.count("*").alias("videos"),
        F.sum(F.when(is_labeled, s).otherwise(0.0)).alias("labeled_s"), F.sum(F.when(~is_labeled, s).otherwise(0.0)).alias("unlabeled_s"), F.sum(s).alias("total_s"),
    )
    return rows.select(F.when(F.col("_all") == 1, F.lit("TOTAL")).otherwise(F.col(source)).alias("source"), "labeled", "unlabeled", "videos", "labeled_s", "unlabeled_s", "total_s")


def report_lines(rows: DataFrame) -> DataFrame:
    """The report as text, one line a source; the total has ``is_total`` set."""
    line = F.format_string("%-24s %s %s %s", F.col("source"), *(format_hours(F.col(c)) for c in ("labeled_s", "unlabeled_s", "total_s")))
    return rows.select((F.col("source") == "TOTAL").alias("is_total"), "source", line.alias("line"))


def outcome(results: DataFrame, ok: str = "ok") -> DataFrame:
    """How many results are good and how many are not."""
    return results.agg(F.count_if(F.col(ok)).alias("success"), F.count_if(~F.col(ok)).alias("failed"))


def examples(results: DataFrame, most: int = 10, ok: str = "ok", order: str = "target") -> DataFrame:
    """At most ``most`` results that are not good, by ``order``: a top-k, not a full sort."""
    return results.where(~F.col(ok)).orderBy(order).limit(most)


def download_progress(archive: DataFrame, wanted: int) -> DataFrame:
    """Items done, by the archive of all sources, and how many of ``wanted`` that can be."""
    return archive.agg(F.count("*").alias("completed"), F.least(F.count("*"), F.lit(wanted)).alias("already"))
