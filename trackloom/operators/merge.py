"""Outputs that grow by runs: what is new, what is done, first come first kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def todo(wanted: DataFrame, manifest: DataFrame, keys: Sequence[str] = ("source", "video"), done: str = "done") -> DataFrame:
    """What the manifest does not have as done; unknown counts as not done."""
    return wanted.join(manifest.where(F.coalesce(F.col(done), F.lit(False))).select(*keys), [*keys], "left_anti")


def first_wins(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Existing rows and those of ``incoming`` whose key is new; of several with one key the first by ``order``. Doing it again changes nothing."""
    new = incoming.join(existing.select(*keys), [*keys], "left_anti")
    if order is not None:
        rest = [c for c in new.columns if c not in keys]
        new = new.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_first")).select(*keys, *(F.col(f"_first.{c}").alias(c) for c in rest))
    return existing.unionByName(new.select(existing.columns))


def unite(labeled: DataFrame, unlabeled: DataFrame) -> DataFrame:
    """Both sets, told apart by ``labeled``."""
    return labeled.withColumn("labeled", F.lit(True)).unionByName(unlabeled.withColumn("labeled", F.lit(False)))
