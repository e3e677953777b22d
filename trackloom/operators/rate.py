"""Throttling: of each key only rows at least an interval after the last one that passed."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def _pass(keys: int, interval):
    def run(batches):
        last_key, last = None, None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(keys + 1)]
            keep = np.zeros(batch.num_rows, bool)
            for i, (*key, t) in enumerate(zip(*columns, strict=True)):
                if key != last_key or t - last >= interval:
                    keep[i], last_key, last = True, key, t
            yield batch.filter(pa.array(keep))

    return run


def rate_limit(rows: DataFrame, keys: Sequence[str], ts: str, interval) -> DataFrame:
    """Rows of each key in time order, without those less than ``interval`` after the last one kept.

    Whether a row passes depends on the one that passed before, so it is a fold; rows are streamed through it in order, and a task holds one batch whatever a key's size. Rows without a time are dropped.
    """
    first = [*keys, ts]
    rest = [c for c in rows.columns if c not in first]
    ordered = rows.where(rows[ts].isNotNull()).select(*first, *rest).repartition(*keys).sortWithinPartitions(*first, *rest)
    return ordered.mapInArrow(_pass(len(keys), interval), ordered.schema).select(rows.columns)
