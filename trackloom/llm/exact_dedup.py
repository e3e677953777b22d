"""Exact deduplication by a Golomb-coded fingerprint exchange.

1. One pass over the documents writes ids and SHA-256 digests. Read back, that table packs many input partitions into one, and is written as blocks of at most ``block_rows`` documents (a table in the shared folder, so block numbers stay fixed if a task runs again).
2. Each block sorts its distinct ``fp_bits``-bit fingerprints, cuts them by owner (ranges of the fingerprint space) and sends each owner one Golomb-coded gap list.
3. An owner decodes the lists it got, finds fingerprints that more than one block sent, and answers each block with a bitmap over that block's sorted list.
4. Documents whose fingerprint repeats inside the block or is marked in a bitmap are suspects. Only their texts are shuffled, and grouped by their bytes; that grouping decides.

A block sends a fingerprint once however often it occurs there, and texts are grouped with map-side combining, so a group of copies that holds a third of all rows costs an owner one entry a block. Nothing is collected to the driver but the number of documents.

There are blocks times owners messages. Owners are at most ``block_rows / MESSAGE``, so with full blocks a message carries ``MESSAGE`` fingerprints or more on average, and the number of messages grows in proportion to the documents, not with their square. Copies learn their group by a join on the digest; groups of more than a ``HOT``-th of all rows, of which there can be no more than ``HOT``, take part by a broadcast, so no task gets a whole hot group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, table, text_or_empty, tidy

FINGERPRINT_BITS = 48
BLOCK_ROWS = 1 << 19
OWNER_FINGERPRINTS = 1 << 20
MESSAGE = 64
HOT = 1 << 16
HOT_ROWS = 1 << 10


def golomb_encode(values: np.ndarray, low: int) -> tuple[int, bytes]:
    """Gaps of sorted distinct ``values`` (all >= ``low``) as a Golomb code whose divisor is 2**k: a unary stream of quotients, then a stream of k-bit remainders."""
    if not len(values):
        return 0, b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(low)).astype(np.uint64)
    gaps[1:] -= np.uint64(1)
    k = max(0, int(math.log2(max(1.0, float(gaps.mean()) * math.log(2)))))
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotient + 1)
    unary = np.ones(int(ends[-1]), np.uint8)
    unary[ends - 1] = 0
    rest = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return k, np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def golomb_decode(data: bytes, n: int, k: int, low: int) -> np.ndarray:
    """The inverse of :func:`golomb_encode`."""
    if not n:
        return np.empty(0, np.uint64)
    tail = (n * k + 7) // 8
    raw = np.frombuffer(data, np.uint8)
    zeros = np.flatnonzero(np.unpackbits(raw[: len(raw) - tail]) == 0)[:n]
    quotient = np.diff(zeros, prepend=-1) - 1
    bits = np.unpackbits(raw[len(raw) - tail :])[: n * k].reshape(n, k).astype(np.uint64)
    gaps = (quotient.astype(np.uint64) << np.uint64(k)) + (bits << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    gaps[1:] += np.uint64(1)
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(low)


def _fingerprints(digests: bytes, bits: int) -> np.ndarray:
    """The leading bits of each 32-byte digest."""
    raw = np.frombuffer(digests, np.uint8).reshape(-1, 32)[:, :8]
    return np.ascontiguousarray(raw).view(">u8").ravel().astype(np.uint64) >> np.uint64(64 - bits)


def _cuts(owners: int, bits: int) -> np.ndarray:
    return np.array([(i << bits) // owners for i in range(owners + 1)], np.uint64)


def _blocks(block_rows: int):
    def run(batches):
        from pyspark import TaskContext

        part, seq, ids, digests, n = TaskContext.get().partitionId(), 0, [], [], 0

        def out():
            return pa.RecordBatch.from_pydict({"block": pa.array([(part << 24) + seq], pa.int64()), "n": pa.array([n], pa.int64()), "ids": pa.array([pa.concat_arrays(ids)], pa.list_(pa.int64())), "digests": pa.array([b"".join(digests)], pa.binary())})

        for batch in batches:
            col = batch.column(1).cast(pa.binary())
            if n and n + batch.num_rows > block_rows:
                yield out()
                seq, ids, digests, n = seq + 1, [], [], 0
            ids.append(batch.column(0).cast(pa.int64()))
            digests.append(b"".join(col.to_pylist()))
            n += batch.num_rows
        if n:
            yield out()

    return run


def _send(owners: int, bits: int):
    def run(batches):
        cuts = _cuts(owners, bits)
        for batch in batches:
            for block, digests in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fps = np.unique(_fingerprints(digests, bits))
                at = np.searchsorted(fps, cuts)
                rows = [(o, block, int(at[o + 1] - at[o]), *golomb_encode(fps[at[o] : at[o + 1]], int(cuts[o]))) for o in range(owners) if at[o + 1] > at[o]]
                own, blk, n, k, data = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(blk, pa.int64()), pa.array(n, pa.int32()), pa.array(k, pa.int32()), pa.array(data, pa.binary())], ["owner", "block", "n", "k", "data"])

    return run


def _answer(owners: int, bits: int):
    def run(key, lists):
        owner = key[0].as_py()
        low = int(_cuts(owners, bits)[owner])
        lists = lists.sort_by("block")
        parts = [golomb_decode(d, n, k, low) for n, k, d in zip(*(lists.column(c).to_pylist() for c in ("n", "k", "data")), strict=True)]
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        repeated = values[counts > 1]
        maps = [np.packbits(np.isin(p, repeated, assume_unique=True)).tobytes() for p in parts]
        return pa.table({"block": lists.column("block"), "owner": pa.array([owner] * len(maps), pa.int32()), "bitmap": pa.array(maps, pa.binary())})

    return run


def _mark(owners: int, bits: int):
    def run(batches):
        cuts = _cuts(owners, bits)
        for batch in batches:
            for block, ids, digests, answers in zip(*(batch.column(i) for i in range(4)), strict=True):
                raw = digests.as_py()
                fps, inverse, counts = np.unique(_fingerprints(raw, bits), return_inverse=True, return_counts=True)
                at, seen = np.searchsorted(fps, cuts), counts > 1
                for a in answers.as_py():
                    lo, hi = at[a["owner"]], at[a["owner"] + 1]
                    seen[lo:hi] |= np.unpackbits(np.frombuffer(a["bitmap"], np.uint8))[: hi - lo].astype(bool)
                n, start = len(inverse), block.as_py() << 20
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(n) + start), ids.values, pa.array([raw[i : i + 32] for i in range(0, 32 * n, 32)], pa.binary()), pa.array(seen[inverse])], ["row", "doc_id", "digest", "suspect"])

    return run


def owners_for(total: int, block_rows: int, least: int) -> int:
    """How many owners ``total`` documents need: ``OWNER_FINGERPRINTS`` each, but no more than leaves ``MESSAGE`` fingerprints for a message of a full block."""
    return max(least, min(-(-total // OWNER_FINGERPRINTS), max(1, block_rows // MESSAGE)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, fp_bits: int = FINGERPRINT_BITS, block_rows: int = BLOCK_ROWS, owners: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their UTF-8 bytes are; a null text counts as empty, so null and empty texts form one group. Of a group the row with the largest id stays; a null id loses to any other, and of rows that repeat the same id and text exactly one is ``kept``. ``keep_id`` is null only where every id of the group is. An empty table gives an empty result. Only ``id_col`` and ``text_col`` are read, so other columns may have any name.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    digests = materialize(base.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest")), "digests")
    total = digests.count()
    blocks = materialize(digests.mapInArrow(tidy(_blocks(block_rows)), "block long, n long, ids array<long>, digests binary"), "blocks")
    owners = owners or owners_for(total, block_rows, shuffle_partitions(spark))
    sent = blocks.select("block", "digests").mapInArrow(tidy(_send(owners, fp_bits)), "owner int, block long, n int, k int, data binary")
    answers = sent.groupBy("owner").applyInArrow(_answer(owners, fp_bits), "block long, owner int, bitmap binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("owner", "bitmap")).alias("answers"))
    marked = materialize(blocks.join(answers, "block").select("block", "ids", "digests", "answers").mapInArrow(tidy(_mark(owners, fp_bits)), "row long, doc_id long, digest binary, suspect boolean"), "marked")

    suspects = marked.where("suspect")
    # Semi join without a hint: broadcast only where Spark has measured the suspect ids as small, else by a shuffle on the id.
    ids = suspects.select(F.col("doc_id").alias("suspect_id")).distinct()
    texts = base.join(ids, base.doc_id.eqNullSafe(ids.suspect_id), "left_semi")
    same = texts.groupBy(F.unhex(F.sha2("text", 256)).alias("digest"), "text").agg(F.count("*").alias("copies")).where("copies > 1")
    # Different texts under one digest would be an error of the digest, which no join by digest may hide.
    same = same.groupBy("digest").agg(F.count("*").alias("texts"), F.first("copies").alias("copies")).select("digest", F.when(F.col("texts") == 1, F.col("copies")).otherwise(F.raise_error(F.lit("different texts share a SHA-256 digest")).cast("long")).alias("copies"))
    groups = materialize(same.join(suspects.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("best")), "digest"), "groups")
    hot = F.col("copies") > max(HOT_ROWS, -(-total // HOT))
    large = F.broadcast(groups.where(hot).select("digest", F.col("copies").alias("large_copies"), F.col("best").alias("large_best")))
    suspects = suspects.join(large, "digest", "left")
    few = suspects.where("large_copies is null").drop("large_copies", "large_best").join(groups.where(~hot), "digest", "left")
    many = suspects.where("large_copies is not null").withColumnsRenamed({"large_copies": "copies", "large_best": "best"})
    one = marked.where("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    more = few.unionByName(many).select(
        "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("best.row"), F.lit(True)).alias("kept"),
        "digest",
    )
    return one.unionByName(more).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op1_exact_dedup": op1_exact_dedup}
ORACLES = {
    "op1_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
}
