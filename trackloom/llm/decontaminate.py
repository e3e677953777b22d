"""Benchmark decontamination by q-gram lemma filtering.

Texts are lower-cased, runs of white space become one space, and what follows works on the UTF-8 bytes. Each benchmark item is cut into windows of ``WINDOW`` bytes every ``STRIDE`` (and one at its end; a shorter item is one window). A window of length L matches a region of a document within k = L // ``PER_EDIT`` edits. By the q-gram lemma such a region shares at least L - q + 1 - k * q of the window's q-grams, all within k diagonals, where q is ``Q`` or as much less as keeps that bound at least 1; so hits are counted in bands of 2(k + 1) diagonals that overlap by half, and only bands that reach the bound are aligned, by a banded edit-distance recursion that decides. An item of fewer than ``Q`` bytes is its own only q-gram: it matches where its bytes stand between borders (no letter, digit or underscore beside them). Windows of equal bytes are one probe.

The benchmark is the query set: it is read in blocks of at most ``BLOCK_BYTES`` of text, each broadcast alone and held against all documents, so its size is bounded whatever the benchmark's. Documents are never shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import share, table, text_or_empty, tidy

Q = 12
WINDOW = 64
STRIDE = 32
PER_EDIT = 16
BLOCK_BYTES = 4 << 20
CHUNK = 1 << 20
GAP = 16  # zero bytes between documents: crossing them costs more than any edit budget
SLOTS = 22
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def normalize(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode("utf-8", "replace")


def budget(length: int) -> tuple[int, int, int]:
    """For a window of ``length`` bytes: the edits allowed, the q of its q-grams, and how many of them it must then share."""
    k = length // PER_EDIT
    q = min(Q, length // (k + 1))
    return k, q, length - q + 1 - k * q


def _grams(buffer: np.ndarray, q: int) -> np.ndarray:
    """A hash of the ``q`` bytes from each position on; ``buffer`` has at least ``Q`` bytes more than there are positions."""
    words = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
    n = len(buffer) - Q
    if q < 8:
        return (words[:n] & np.uint64((1 << 8 * q) - 1)) * _C1
    return words[:n] * _C1 + words[q - 8 : n + q - 8] * _C2


class Grams:
    """The q-grams, for one q, of windows (number, bytes), and where in which windows they stand."""

    def __init__(self, q: int, windows: list[tuple[int, bytes]]):
        self.q = q
        parts = [_grams(np.frombuffer(t + bytes(Q), np.uint8), q)[: len(t) - q + 1] for _, t in windows]
        flat, sizes = np.concatenate(parts), np.array([len(g) for g in parts])
        order = np.argsort(flat, kind="stable")
        self.grams, first = np.unique(flat[order], return_index=True)
        self.cuts = np.append(first, len(flat)).astype(np.int64)
        self.window = np.repeat(np.array([i for i, _ in windows], np.int64), sizes)[order]
        self.offset = (np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[order]
        self.slots = np.zeros(1 << SLOTS, bool)
        self.slots[(self.grams >> np.uint64(64 - SLOTS)).astype(np.int64)] = True

    def hits(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, diagonal) of every q-gram that stands in the buffer."""
        h = _grams(buffer, self.q)
        pos = np.flatnonzero(self.slots[(h >> np.uint64(64 - SLOTS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.grams, h[pos]), len(self.grams) - 1)
        hit = self.grams[at] == h[pos]
        pos, at = pos[hit], at[hit]
        times = self.cuts[at + 1] - self.cuts[at]
        entry = np.repeat(self.cuts[at] - np.cumsum(times) + times, times) + np.arange(times.sum())
        return self.window[entry], np.repeat(pos, times) - self.offset[entry]


class Probes:
    """Windows of one block of the benchmark, each once with the items it comes from, and their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        seen: dict[bytes, list] = {}
        for item_id, text in items:
            body = normalize(text)
            last = max(0, len(body) - WINDOW)
            for start in sorted({*range(0, last, STRIDE), last}) if body else ():
                seen.setdefault(body[start : start + WINDOW], []).append(item_id)
        self.text = list(seen)
        self.items = [sorted(set(x), key=lambda i: (i is None, i)) for x in seen.values()]
        self.times = [len(x) for x in seen.values()]
        self.length = np.array([len(t) for t in self.text], np.int64)
        budgets = np.array([budget(len(t)) for t in self.text], np.int64).reshape(-1, 3)
        self.k, self.least = budgets[:, 0], budgets[:, 2]
        self.rows = np.zeros((len(self.text), WINDOW), np.uint8)
        for i, t in enumerate(self.text):
            self.rows[i, : len(t)] = np.frombuffer(t, np.uint8)
        self.groups = [Grams(int(q), [(i, self.text[i]) for i in np.flatnonzero(budgets[:, 1] == q).tolist()]) for q in np.unique(budgets[:, 1])]


def banded_distance(pattern: np.ndarray, region: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits between each row of ``pattern`` and a part of the same row of ``region`` that starts in its first ``width`` bytes, within that band of diagonals; and the diagonal on which the best one ends."""
    n, length = pattern.shape
    cost, steps = np.zeros((n, width), np.int32), np.arange(width, dtype=np.int32)
    for i in range(length):
        change = cost + (region[:, i : i + width] != pattern[:, i : i + 1])
        change[:, :-1] = np.minimum(change[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(change - steps, axis=1) + steps
    best = cost.argmin(axis=1)
    return cost[np.arange(n), best], best


#: Bytes beside which there is no border: letters, digits and underscores, in lower case, and all bytes of characters beyond ASCII.
_WORD = np.array([b >= 128 or chr(b).isalnum() or b == 95 for b in range(256)])


def find_regions(texts: list[bytes], probes: Probes) -> list[tuple[int, int, int]]:
    """(text number, window, first byte) of every verified band; texts are normalised."""
    starts = np.cumsum([GAP] + [len(t) + GAP for t in texts])[:-1]
    buffer = np.frombuffer(bytes(GAP) + b"".join(t + bytes(GAP) for t in texts) + bytes(WINDOW * 2), np.uint8)
    found: list[tuple[int, int, int]] = []

    def add(window, begin, length):
        doc = np.searchsorted(starts, begin + length // 2, side="right") - 1
        found.extend(zip(doc.tolist(), window.tolist(), np.maximum(0, begin - starts[np.maximum(doc, 0)]).tolist(), strict=True))

    for grams in probes.groups:
        window, diagonal = grams.hits(buffer)
        short = probes.length[window] < Q
        if short.any():
            for length in np.unique(probes.length[window[short]]).tolist():
                w, begin = (x[short & (probes.length[window] == length)] for x in (window, diagonal))
                good = ~_WORD[buffer[begin - 1]] & ~_WORD[buffer[begin + length]]
                for i in range(length):
                    good &= buffer[begin + i] == probes.rows[w, i]
                add(w[good], begin[good], length)
            window, diagonal = window[~short], diagonal[~short]
        band = diagonal // (probes.k[window] + 1)
        span = np.int64(len(buffer) + 2 * WINDOW)
        key, counts = np.unique(np.concatenate((window * span + band + WINDOW, window * span + band - 1 + WINDOW)), return_counts=True)
        window, band = key // span, key % span - WINDOW
        enough = counts >= probes.least[window]
        window, band = window[enough], band[enough]
        for length in np.unique(probes.length[window]).tolist():
            same = np.flatnonzero(probes.length[window] == length)
            k = int(probes.k[window[same[0]]])
            width = 2 * (k + 1) + 2 * k + 1
            base = band[same] * (k + 1) - k
            for lo in range(0, len(same), 4096):
                part, first = window[same[lo : lo + 4096]], base[lo : lo + 4096]
                take = np.clip(first[:, None] + np.arange(width + length), 0, len(buffer) - 1)
                cost, best = banded_distance(probes.rows[part, :length], buffer[take], width)
                good = np.flatnonzero(cost <= k)
                add(part[good], first[good] + best[good], length)
    return found


RESULT = "contaminated boolean, n_windows int, item_ids array<long>, first_bytes array<long>"


def _scan(probes):
    def run(batches):
        p: Probes = probes.value
        for batch in batches:
            ids, texts, n = batch.column(0), batch.column(1).to_pylist(), batch.num_rows
            lo = 0
            while lo < n:
                part, size = [], 0
                while lo + len(part) < n and (not part or size < CHUNK):
                    part.append(normalize(texts[lo + len(part)]))
                    size += len(part[-1])
                per: list[dict] = [{} for _ in part]
                for doc, window, begin in find_regions(part, p):
                    per[doc].setdefault(window, begin)
                firsts: list[dict] = [{} for _ in part]
                for own, x in zip(firsts, per, strict=True):
                    for w, begin in x.items():
                        for i in p.items[w]:
                            own[i] = min(begin, own.get(i, begin))
                items = [sorted(x, key=lambda i: (i is None, i)) for x in firsts]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, len(part)), batch.column(2).slice(lo, len(part)), pa.array([bool(x) for x in per]), pa.array([sum(p.times[w] for w in x) for x in per], pa.int32()), pa.array(items, pa.list_(pa.int64())), pa.array([[x[i] for i in own] for x, own in zip(firsts, items, strict=True)], pa.list_(pa.int64()))],
                    ["doc_id", "tag", "contaminated", "n_windows", "item_ids", "first_bytes"],
                )
                lo += len(part)

    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of at most ``most`` characters of text (one item at least), of which the driver holds one at a time."""
    block: list = []
    size = 0
    for item, text in benchmark.select(F.col(item_col).cast("long").alias("item_id"), text_or_empty(text_col).alias("text")).orderBy("item_id", "text").toLocalIterator():
        if block and size + len(text) > most:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    yield block


def _clean(probes, text: int):
    """Passes on the rows whose text, in column number ``text``, meets no window."""

    def run(batches):
        for batch in batches:
            texts, lo = batch.column(text).to_pylist(), 0
            while lo < len(texts):
                part, size = [], 0
                while lo + len(part) < len(texts) and (not part or size < CHUNK):
                    part.append(normalize(texts[lo + len(part)]))
                    size += len(part[-1])
                met = np.zeros(len(part), bool)
                met[[d for d, _, _ in find_regions(part, probes.value)]] = True
                yield batch.slice(lo, len(part)).filter(pa.array(~met))
                lo += len(part)

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, that no benchmark window meets; documents are not shuffled."""
    names = docs.columns
    rows = docs.toDF(*(f"c{i}" for i in range(len(names))))
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = share(docs.sparkSession, Probes(items))
        rows = rows.mapInArrow(tidy(_clean(shared, names.index(text_col))), rows.schema)
    return rows.toDF(*names)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, n_windows (verified benchmark windows), item_ids (ascending), first_bytes (where each item's first region starts in the normalised text), and tag, a hash of the text.

    A null or empty text matches nothing; a null benchmark text counts as empty, an empty item or benchmark marks nothing; a null item id comes last. Rows that repeat are judged alike.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("tag", F.xxhash64("text"))
    scans = []
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        scans.append(base.select("doc_id", "text", "tag").mapInArrow(tidy(_scan(share(spark, Probes(items)))), f"doc_id long, tag long, {RESULT}"))
    if len(scans) == 1:
        return scans[0]
    out = functools.reduce(DataFrame.unionByName, [x.where("contaminated").withColumn("block", F.lit(number)) for number, x in enumerate(scans)])
    whole = out.dropDuplicates(["doc_id", "tag", "block"]).groupBy("doc_id", "tag").agg(F.sum("n_windows").cast("int").alias("n_windows"), F.flatten(F.collect_list(F.arrays_zip("item_ids", "first_bytes"))).alias("all"))
    items = whole.select("doc_id", "tag", "n_windows", F.explode("all").alias("m")).groupBy("doc_id", "tag", "n_windows", F.col("m.item_ids").alias("item")).agg(F.min("m.first_bytes").alias("first"))
    per = items.groupBy(F.col("doc_id").alias("of"), F.col("tag").alias("of_tag"), "n_windows").agg(F.sort_array(F.collect_list(F.struct("item", "first"))).alias("m"))
    ids = base.select("doc_id", "tag")
    return ids.join(per, ids.doc_id.eqNullSafe(per.of) & (ids.tag == per.of_tag), "left").select(
        "doc_id", "tag", F.col("m").isNotNull().alias("contaminated"), F.coalesce("n_windows", F.lit(0)).alias("n_windows"), F.coalesce(F.col("m.item"), F.array().cast("array<long>")).alias("item_ids"), F.coalesce(F.col("m.first"), F.array().cast("array<long>")).alias("first_bytes")
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tag")


QUERIES = {"op9_decontaminate": op9_decontaminate}
ORACLES: dict = {}
