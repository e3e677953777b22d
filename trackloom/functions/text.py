"""Text and path functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_timestamp(seconds: Column) -> Column:
    """``HH:MM:SS.mmm``; every field is cut, not rounded, and hours may take more than two digits."""
    s = seconds.cast("double")
    whole = lambda x: F.floor(x).cast("bigint")
    return F.format_string("%02d:%02d:%02d.%03d", whole(s / 3600), whole(s % 3600 / 60), whole(s % 60), (s % 1 * 1000).cast("bigint"))


def parse_timestamp(text: Column) -> Column:
    """Seconds of ``HH:MM:SS.mmm`` or ``MM:SS.mmm``; null where the text is neither."""
    part = lambda i: F.regexp_extract(text, r"^\s*(?:(\d+):)?(\d{1,2}):(\d{1,2})[.,](\d{3})\s*$", i)
    return F.when(part(4) != "", F.coalesce(F.nullif(part(1), F.lit("")).cast("double"), F.lit(0.0)) * 3600 + part(2).cast("double") * 60 + part(3).cast("double") + part(4).cast("double") / 1000)


def stem_first_dot(name: Column) -> Column:
    """What stands before the first dot; curation matches files by it."""
    return F.substring_index(name, ".", 1)


def stem_last_dot(name: Column) -> Column:
    """The name without its last extension; a leading dot does not start an extension."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def swap_extension(name: Column, old: str, new: str) -> Column:
    """Every ``old`` in the name becomes ``new``."""
    return F.replace(name, F.lit(old), F.lit(new))


def extension(name: Column) -> Column:
    """The last extension in lower case, with its dot; empty without one."""
    return F.lower(F.regexp_extract(name, r".(\.[^./]*)$", 1))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def source_of(path: Column) -> Column:
    """The folder three levels above the file (source/status/video/file)."""
    return F.try_element_at(F.split(path, "/"), F.lit(-4))


def strip(text: Column) -> Column:
    """The text without any white space around it."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def path_category(path: Column) -> Column:
    """``labeled``, ``unlabeled`` or ``other`` by a whole path component; ``labeled`` wins."""
    parts = F.split(path, "/")
    return F.when(F.array_contains(parts, "labeled"), "labeled").when(F.array_contains(parts, "unlabeled"), "unlabeled").otherwise("other")


def person_of(key: Column) -> Column:
    """The id in a key like ``person_7``."""
    return F.try_element_at(F.split(key, "_"), F.lit(2))


def is_number(key: Column) -> Column:
    return key.rlike(r"^[0-9]+$")


def seconds_to_millis(seconds: Column) -> Column:
    return (seconds * 1000).cast("bigint")


def hours(seconds: Column) -> Column:
    return seconds / F.lit(3600.0)


def format_hours(seconds: Column) -> Column:
    """Hours with two decimals; a number right between two goes to the even one."""
    return F.format_string("%6.2fh", F.rint(hours(seconds).cast("double") * 100) / 100)


def minutes_and_seconds(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("bigint")
    return F.struct(F.floor(whole / 60).alias("minutes"), (whole % 60).alias("seconds"))


def falsy_default(value: Column, default) -> Column:
    """``default`` where the value is null or zero."""
    return F.coalesce(F.nullif(value, F.lit(0).cast("double")), F.lit(default))


def cyclic(index: Column, step: int, n: Column) -> Column:
    """The index ``step`` places further, around ``n``."""
    return F.pmod(index + F.lit(step), n)
