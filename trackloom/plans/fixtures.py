"""The library's inputs out of the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import points


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as boxes of tracks: the event type is the video, the user the track."""
    rows = table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    i = F.col("event_id")
    return rows.select(
        "event_id", F.col("event_type").alias("video"), F.col("user_id").alias("person_id"), us.alias("us"), (i % 640).cast("double").alias("x1"), (i % 360).cast("double").alias("y1"), (i % 640 + 20 + i % 37).cast("double").alias("x2"), (i % 360 + 40 + i % 53).cast("double").alias("y2")
    )


DETECTIONS_SQL = """detections AS (
  SELECT event_id, event_type AS video, user_id AS person_id, epoch_us(ts) AS us,
         CAST(event_id % 640 AS DOUBLE) AS x1, CAST(event_id % 360 AS DOUBLE) AS y1,
         CAST(event_id % 640 + 20 + event_id % 37 AS DOUBLE) AS x2, CAST(event_id % 360 + 40 + event_id % 53 AS DOUBLE) AS y2
  FROM events)"""


def frames_with_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as bodies of 17 points: the label is the clip, vec_id the time."""
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(F.col("label").alias("clip"), F.col("vec_id").alias("ts"), points(F.col("embedding"), 17).alias("body"))


def cyclic_points(embedding: Column, n: int) -> Column:
    """``n`` points that run through the embedding again and again."""
    at = lambda k: F.element_at(embedding, (k % 64 + 1).cast("int")).cast("double")
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.array(at(i * 3), at(i * 3 + 1), at(i * 3 + 2)))


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as media clips: source, video, start, end, fps."""
    rows = table(spark, sf_dir, "documents")
    fps = F.element_at(F.array(*map(F.lit, (23.976, 25.0, 30.0, 50.0, 15.0))), (F.col("doc_id") % 5 + 1).cast("int"))
    start = (F.col("doc_id") % 10) * F.lit(0.5)
    return rows.select("source", F.col("doc_id").alias("video"), start.alias("start"), (start + (F.col("n_chars") % 50) / F.lit(4.0)).alias("end"), fps.alias("fps"))


MEDIA_SQL = """media AS (
  SELECT source, doc_id AS video, (doc_id % 10) * 0.5::DOUBLE AS start, (doc_id % 10) * 0.5::DOUBLE + (n_chars % 50) / 4.0::DOUBLE AS "end",
         list_extract([23.976::DOUBLE, 25.0::DOUBLE, 30.0::DOUBLE, 50.0::DOUBLE, 15.0::DOUBLE], doc_id % 5 + 1) AS fps
  FROM documents)"""


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as cues."""
    rows = table(spark, sf_dir, "conversations")
    start = F.col("turn") * F.lit(2.3)
    return rows.select(F.col("conv_id").alias("video"), F.col("turn").alias("seq"), start.alias("start"), (start + F.lit(1.7)).alias("end"), F.coalesce("text", F.lit("")).alias("text"))
