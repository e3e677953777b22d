"""Token ids in a binary format: patched frame-of-reference blocks.

A shard holds the ids of consecutive documents, each closed by an end id, cut into blocks of ``BLOCK`` ids. A block stores its minimum and the differences to it in ``width`` bits, where the width is that of the ``PERCENTILE`` of its differences; what is wider is patched from an exception list (position, high part). A shard's index gives the byte at which each block starts, so one block can be read alone.

Shard layout, little endian: magic ``TLPF``, uint32 version, uint32 ids, uint32 blocks, uint32 start of each block and of the end, then blocks: uint32 minimum, uint8 width, uint8 bytes of each high part (1, 2 or 4, the same in a shard), uint16 exceptions, packed low parts, uint8 exception positions, high parts.

Shards are rows of a Parquet table (part, seq, offset in the part, document index, image), so that any store that Spark can write to holds them, commits are atomic, and a lost executor leaves no half shard. Documents are dealt by ranges of their id, so shards in order of (part, seq) hold ascending ids.
"""

from __future__ import annotations

import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, table, text_or_empty, tidy

BLOCK = 256
PERCENTILE = 0.95
SHARD_IDS = 1 << 18
END_ID = 2
CACHE_PIECES = 1 << 18
MAGIC = b"TLPF"


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of unsigned values as rows of bytes, ``width`` bits each, high bits first. Eight values fill ``width`` bytes, so each of the eight has its own bytes and shift."""
    rows, n = values.shape
    groups = -(-n // 8)
    padded = np.zeros((rows, groups * 8), np.uint64)
    padded[:, :n] = values
    padded = padded.reshape(rows, groups, 8)
    out = np.zeros((rows, groups, width + 5), np.uint8)
    span = (width + 7) // 8 + 1  # bytes that one value may touch
    for j in range(8 if width else 0):
        at, off = divmod(j * width, 8)
        moved = padded[:, :, j] << np.uint64(8 * span - width - off)
        for b in range(span):
            out[:, :, at + b] |= (moved >> np.uint64(8 * (span - 1 - b))).astype(np.uint8)
    return out[:, :, :width].reshape(rows, -1)[:, : -(-n * width // 8)]


def _unpack(raw: np.ndarray, n: int, width: int) -> np.ndarray:
    """The inverse of :func:`_pack`, for n values a row."""
    if not width:
        return np.zeros((len(raw), n), np.uint32)
    padded = np.zeros((len(raw), raw.shape[1] + 8), np.uint8)
    padded[:, : raw.shape[1]] = raw
    bit = np.arange(n) * width
    words = np.ndarray((len(raw), raw.shape[1] + 1), ">u8", padded, strides=(padded.strides[0], 1))[:, bit >> 3].astype(np.uint64)
    return ((words >> (64 - width - (bit & 7)).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1))).astype(np.int64) + 1, 0)


def encode_shard(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """The image of a shard that holds ``ids`` (unsigned 32-bit). All blocks are laid out together; there is no step per block."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    head = MAGIC + np.array([1, n, blocks], "<u4").tobytes()
    if not n:
        return head + np.array([20], "<u4").tobytes()
    grid = np.full((blocks, BLOCK), ids[-1], np.uint32)
    grid.ravel()[:n] = ids
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    rank = min(BLOCK - 1, int(BLOCK * percentile))
    width = _bits(np.partition(rest, rank, axis=1)[:, rank])
    high = rest >> width[:, None].astype(np.uint32)
    where, pos = np.nonzero(high)
    patched = high[where, pos]
    bytes_each = next(k for k in (1, 2, 4) if patched.max(initial=0) < 1 << 8 * k)
    times = np.bincount(where, minlength=blocks)
    body = BLOCK * width // 8
    sizes = 8 + body + times * (1 + bytes_each)
    starts = 16 + 4 * (blocks + 1) + np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros(int(starts[-1]), np.uint8)
    out[:16] = np.frombuffer(head, np.uint8)
    out[16 : starts[0]] = starts.astype("<u4").view(np.uint8)
    at = starts[:-1]
    heads = np.column_stack((low.astype("<u4").view(np.uint8).reshape(-1, 4), width, np.full(blocks, bytes_each), times.astype("<u2").view(np.uint8).reshape(-1, 2)))
    out[at[:, None] + np.arange(8)] = heads.astype(np.uint8)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            out[at[own][:, None] + 8 + np.arange(BLOCK * int(w) // 8)] = _pack(rest[own] & np.uint32((1 << int(w)) - 1), int(w))
    order = np.arange(len(where)) - np.repeat(np.cumsum(times) - times, times)
    spot = (at + 8 + body)[where] + order
    out[spot] = pos
    spot += (times[where] - order) + order * bytes_each
    for k in range(bytes_each):
        out[spot + k] = (patched >> np.uint32(8 * k)).astype(np.uint8)
    return out.tobytes()


def _decode(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ids (blocks x BLOCK) of the blocks that begin at ``starts``. Blocks of one width are unpacked together, all exceptions at once."""
    head = raw[starts[:, None] + np.arange(8)]
    low, width, bytes_each, times = np.ascontiguousarray(head[:, :4]).view("<u4").ravel(), head[:, 4].astype(np.int64), head[:, 5].astype(np.int64), np.ascontiguousarray(head[:, 6:]).view("<u2").ravel().astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            out[own] = _unpack(raw[starts[own][:, None] + 8 + np.arange(BLOCK * int(w) // 8)], BLOCK, int(w))
    where = np.repeat(np.arange(len(starts)), times)
    if len(where):
        order = np.arange(len(where)) - np.repeat(np.cumsum(times) - times, times)
        spot, each = (starts + 8 + BLOCK * width // 8)[where], int(bytes_each[0])
        pos = raw[spot + order]
        spot = spot + times[where] + order * each
        high = np.zeros(len(where), np.uint32)
        for k in range(each):
            high |= raw[spot + k].astype(np.uint32) << np.uint32(8 * k)
        out[where, pos] |= high << width[where].astype(np.uint32)
    return out + low[:, None]


def decode_block(image: bytes, i: int) -> np.ndarray:
    """Ids of block ``i``, found through the index; the last block may be padded."""
    return _decode(np.frombuffer(image, np.uint8), np.frombuffer(image, "<u4", 1, 16 + 4 * i).astype(np.int64))[0]


def decode_shard(image: bytes) -> np.ndarray:
    """All ids of a shard."""
    if image[:4] != MAGIC:
        raise ValueError("not a shard")
    _, n, blocks = np.frombuffer(image, "<u4", 3, 4)
    if not n:
        return np.empty(0, np.uint32)
    return _decode(np.frombuffer(image, np.uint8), np.frombuffer(image, "<u4", blocks, 16).astype(np.int64)).ravel()[:n]


class Encoder:
    """Ids of whole texts by the tokenizers library.

    The tokenizer's pre-tokenizer always cuts before a single space or line break between two non-blank characters, and between a letter and the signs after it that end the piece, so pieces between such cuts can be encoded apart without changing any id. Pieces met before are looked up; new ones are encoded joined, and the ids cut where the pieces end. Pieces are kept in two generations of at most about ``CACHE_PIECES``: when the young one is full it becomes the old one, and what is used again moves on.
    """

    SAFE = re.compile(r"(?<=\S) (?=\S)")
    #: Where none of these occurs, white space is single spaces and line breaks, and no two of them touch at a space.
    ODD = ("  ", " \n", "\n ", *(chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"))

    SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
    #: What a piece after a line break begins with.
    LINE = "\0\n"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that the library takes as one token wherever they occur; a text that holds one is not cut.
        self.marks = ("\0", *(t.content for t in self.tokenizer.get_added_tokens_decoder().values()))
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # Bytes that each id stands for: a byte-level token has one character a byte.
        self.width = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.width[i] = len(token)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, missing: list[str]) -> None:
        """Puts the pieces, each of which follows a single space or begins with ``LINE``, among the young ones."""
        known, old, joined, lines, tails = self.young, self.old, [], [], []
        for p in missing:
            if (found := old.get(p)) is not None:
                known[p] = found
            elif p in known:
                continue
            elif p and not p[0].isspace() and not p[-1].isspace():
                base = p.rstrip(self.SIGNS)
                if len(base) < len(p) and base[-1:].isalpha():
                    tails.append((p, base))
                    if base in known:
                        continue
                    if (found := old.get(base)) is not None:
                        known[base] = found
                        continue
                else:
                    base = p
                known[base] = b""
                (lines if base[0] == "\0" else joined).append(base)
            else:
                known[p] = self._ids("\n" if p == self.LINE else " " + p).tobytes()
        for new, space, skip in ((joined, " ", 0), (lines, "\n", len(self.LINE))):
            for lo in range(0, len(new), 4096):
                few = new[lo : lo + 4096]
                bare = [p[skip:] for p in few] if skip else few
                ids = self._ids(space + space.join(bare))
                ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(p.encode()) + 1 for p in bare])) + 1
                raw, at = ids.tobytes(), 0
                for p, end in zip(few, (4 * ends).tolist(), strict=True):
                    known[p] = raw[at:end]
                    at = end
        for p, base in tails:
            tail = "\0" + p[len(base) :]
            if tail not in known:
                known[tail] = self._ids(tail[1:]).tobytes()
            known[p] = known[base] + known[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        firsts, cut, rows, holes, get = [], [], [], [], self.young.get
        for text in texts:
            if any(x in text for x in self.marks):
                first, pieces = text, []
            elif any(x in text for x in self.ODD):
                first, *pieces = self.SAFE.split(text)
            elif "\n\n" in text:
                first, *pieces = text.split(" ")
            else:
                first, *pieces = text.replace("\n", " \0\n").split(" ")
            ids = list(map(get, pieces))
            firsts.append(first)
            cut.append(pieces)
            rows.append(ids)
            holes.append([k for k, x in enumerate(ids) if x is None] if None in ids else ())
        self._learn(list(dict.fromkeys([pieces[k] for pieces, at in zip(cut, holes, strict=True) for k in at])))
        known = self.young
        for pieces, ids, at in zip(cut, rows, holes, strict=True):
            for k in at:
                ids[k] = known[pieces[k]]
        heads = self.tokenizer.encode_batch_fast(firsts, add_special_tokens=False)
        out = [np.array(h.ids, "<u4").tobytes() + b"".join(ids) for h, ids in zip(heads, rows, strict=True)]
        if len(known) > CACHE_PIECES:
            self.young, self.old = {}, known
        return out


@functools.lru_cache(1)
def _encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


SHARD = "part int, seq int, offset long, n_tokens long, doc_ids array<long>, lengths array<long>, image binary"


def _shards(path: str, end_id: int, shard_ids: int):
    def run(batches):
        from pyspark import TaskContext

        encoder, end, part, seq = _encoder(path), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), 0
        ids, data, size, offset = [], [], 0, 0

        def out():
            lengths = [len(x) // 4 for x in data]
            image = encode_shard(np.frombuffer(b"".join(data), "<u4"))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "offset": pa.array([offset], pa.int64()), "n_tokens": pa.array([sum(lengths)], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64())), "lengths": pa.array([lengths], pa.list_(pa.int64())), "image": pa.array([image], pa.binary())})

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                few = batch.slice(lo, 512)
                for doc_id, x in zip(few.column(0).to_pylist(), encoder.encode(few.column(1).to_pylist()), strict=True):
                    ids.append(doc_id)
                    data.append(x + end)
                    size += len(data[-1]) // 4
                    if size >= shard_ids:
                        yield out()
                        seq, offset, ids, data, size = seq + 1, offset + size, [], [], 0
        if ids:
            yield out()

    return run


def write_token_blocks(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shard_ids: int = SHARD_IDS, partitions: int | None = None, path: str | None = None) -> DataFrame:
    """Encode every text and write shards; returns the written table (part, seq, offset, n_tokens, doc_ids, lengths, image), read back from ``path`` or a scratch table.

    Ids ascend over (part, seq) and inside a shard; a null id comes first, and rows that share an id follow the hash of their text. A null or empty text is its end id alone. A document is never cut, so one longer than ``shard_ids`` makes a longer shard. An empty table gives no shard.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    dealt = base.repartitionByRange(partitions or shuffle_partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows = dealt.select("doc_id", "text").mapInArrow(tidy(_shards(tokenizer_path, end_id, shard_ids)), SHARD)
    if path is None:
        return materialize(rows, "shards")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _read(batches):
    for batch in batches:
        for start, doc_ids, lengths, image in zip(*(batch.column(i) for i in range(4)), strict=True):
            ids, n = decode_shard(image.as_py()), np.array(lengths.as_py(), np.int64)
            ends = np.cumsum(n)
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([doc_ids.values, pa.array(start.as_py() + ends - n), pa.array(n), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_blocks(shards: DataFrame) -> DataFrame:
    """One row per document from the shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A shard knows the ids before it in its part, so only the parts' totals are summed up: one row for each partition that wrote, which is also what bounds the broadcast. Images are not shuffled.
    """
    parts = shards.groupBy(F.col("part").alias("of_part")).agg(F.max(F.col("offset") + F.col("n_tokens")).alias("ids"))
    before = Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("of_part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))
    rows = shards.join(F.broadcast(parts), F.col("part") == F.col("of_part")).select((F.col("part_start") + F.col("offset")).alias("start"), "doc_ids", "lengths", "image")
    return rows.mapInArrow(tidy(_read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return read_token_blocks(write_token_blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


QUERIES = {"op3_token_blocks": op3_token_blocks}
ORACLES: dict = {}
