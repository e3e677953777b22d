"""Captions: writing and reading of cues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import format_timestamp, parse_timestamp, strip

#: One cue: start, end and its text up to a blank line or the next cue.
CUE = r"(?m)^\s*((?:\d+:)?\d{1,2}:\d{1,2}[.,]\d{3})\s*-->\s*((?:\d+:)?\d{1,2}:\d{1,2}[.,]\d{3})[^\n]*\n((?:(?!\s*$)(?![^\n]*-->)[^\n]+(?:\n|\z))*)"


def cue_text(start: Column, end: Column, text: Column) -> Column:
    return F.concat(format_timestamp(start), F.lit(" --> "), format_timestamp(end), F.lit("\n"), strip(text), F.lit("\n\n"))


def write_vtt(cues: DataFrame, keys: Sequence[str], order: str = "seq", start: str = "start", end: str = "end", text: str = "text") -> DataFrame:
    """One row per key with the whole caption file; cues by ``order``."""
    rows = cues.withColumn("_cue", F.struct(F.col(order), cue_text(F.col(start), F.col(end), F.col(text)).alias("cue")))
    return rows.groupBy(*keys).agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list("_cue")), lambda c: c["cue"]), "")).alias("vtt"))


def read_vtt(files: DataFrame, keys: Sequence[str], vtt: str = "vtt") -> DataFrame:
    """Rows (keys, seq from 0, start, end, text) of the cues; notes, identifiers and settings are skipped."""
    text = F.regexp_replace(F.col(vtt), "\r\n?", "\n")
    found = files.select(*keys, F.posexplode(F.regexp_extract_all(text, F.lit(CUE), F.lit(0))).alias("seq", "cue"))
    part = lambda i: F.regexp_extract("cue", CUE, i)
    return found.select(*keys, "seq", parse_timestamp(part(1)).alias("start"), parse_timestamp(part(2)).alias("end"), F.regexp_replace(part(3), r"\n$", "").alias("text"))
