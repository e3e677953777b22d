"""Quality classifier: random-indexing vectors pooled per document, then a two-layer network with calibrated probabilities.

A token between white space is two units, its word (lower-cased, without outer punctuation, hashed to ``WORDS`` buckets) and its shape (case and outer punctuation, hashed to ``SHAPES``). Every unit has a sparse ternary index vector that its number alone decides. A unit's vector is the sum of the index vectors of the tokens beside it and of its own token's other unit, over all occurrences in all documents: each partition sums into a table of fixed size, and tables are added by rows. Documents pool the normalised vectors of their units; a token that repeats the one before it pools one more unit.

The network learns from a sample of at most ``SAMPLE`` labelled rows of the training fold, chosen by a hash of the id; its temperature is fitted on a part of that sample that it has not learned from. Vectors, pooling and scores cover every document.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_up, bucket_of, share, table, text_or_empty, tidy

WORDS = 1 << 14
SHAPES = 1 << 10
UNITS = WORDS + SHAPES
DIMS = 32
NONZERO = 4
SAMPLE = 20_000
FOLDS = 5
THRESHOLD = 0.3
HIDDEN = 32
CHUNK_CHARS = 1 << 20
ROWS = 128  # units a message carries when tables are added
FEATURES = 2 * DIMS + 3
SCORE = "_quality_score"
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class Units(dict):
    """A token's word bucket and, above it, its shape bucket."""

    def __missing__(self, token: str) -> int:
        core = token.strip(PUNCTUATION)
        kind = "d" if core.isdigit() else "u" if core.isupper() and len(core) > 1 else "l" if core.islower() else "t" if core[:1].isupper() and core[1:].islower() else "m" if core else ""
        at = token.find(core) if core else len(token)
        shape = f"{token[: min(at, 3)]} {kind} {token[at + len(core) :][:3]}"
        word = zlib.crc32(core.lower().encode("utf-8", "replace")) % WORDS
        if len(self) > 1 << 17:
            self.clear()
        self[token] = found = word | (zlib.crc32(shape.encode("utf-8", "replace")) % SHAPES) << 14
        return found


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and signs (units x NONZERO) of every unit's index vector."""
    x = np.arange(UNITS * NONZERO, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)
    for shift in (33, 29, 32):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(0x9FB21C651E98DF25)
    return (x >> np.uint64(40)).astype(np.int64).reshape(UNITS, NONZERO) % DIMS, np.where(x >> np.uint64(63), 1.0, -1.0).reshape(UNITS, NONZERO)


def _chunks(batch, text: int):
    """Slices of a batch with about CHUNK_CHARS characters, as (offset, texts)."""
    texts = batch.column(text).to_pylist()
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size < CHUNK_CHARS):
            size += len(texts[hi])
            hi += 1
        yield lo, texts[lo:hi]
        lo = hi


def _tokens(texts: list[str], units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word units, shape units, and the tokens of each text."""
    split = [t.split() for t in texts]
    n = np.array([len(s) for s in split], np.int64)
    both = np.fromiter((units[w] for s in split for w in s), np.int64, int(n.sum()))
    return both & (WORDS - 1), WORDS + (both >> 14), n


def _contexts(batches):
    units, (dims, signs), total = Units(), index_vectors(), np.zeros(UNITS * DIMS)
    for batch in batches:
        for _, texts in _chunks(batch, 0):
            words, shapes, n = _tokens(texts, units)
            if not len(words):
                continue
            doc = np.repeat(np.arange(len(n)), n)
            beside = np.flatnonzero(doc[1:] == doc[:-1])
            for at, near in ((beside, beside + 1), (beside + 1, beside)):
                for own in (words, shapes):
                    for other in (words, shapes):
                        for j in range(NONZERO):
                            total += np.bincount(own[at] * DIMS + dims[other[near], j], signs[other[near], j], UNITS * DIMS)
            for own, other in ((words, shapes), (shapes, words)):
                for j in range(NONZERO):
                    total += np.bincount(own * DIMS + dims[other, j], signs[other, j], UNITS * DIMS)
    rows = total.reshape(-1, ROWS * DIMS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows)), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())], ["part", "sums"])


def unit_vectors(texts: DataFrame) -> np.ndarray:
    """Normalised random-indexing vectors (units x DIMS) of all rows of ``texts``; what reaches the driver has a fixed size."""
    parts = add_up(texts.mapInArrow(tidy(_contexts), "part int, sums binary"))
    out = np.zeros((UNITS * DIMS // (ROWS * DIMS), ROWS * DIMS))
    for i, data in parts.collect():
        out[i] += np.frombuffer(data)
    out = out.reshape(UNITS, DIMS)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _features(vectors):
    def run(batches):
        units = Units()
        for batch in batches:
            for lo, texts in _chunks(batch, 2):
                out = _pooled(texts, units, vectors.value)
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, len(texts)).columns[:2], pa.array([r.tobytes() for r in out], pa.binary())], ["doc_id", "label", "features"])

    return run


class Network:
    """Two layers, trained by Adam on the log loss; ``temperature`` divides the logit."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 7):
        self.hidden, self.seed, self.temperature = hidden, seed, 1.0
        self.mean = self.scale = None
        self.w: list[np.ndarray] = []

    def logits(self, x: np.ndarray) -> np.ndarray:
        if not self.w:
            return np.full(len(x), self.bias)
        w1, b1, w2, b2 = self.w
        return (np.maximum(0, (x - self.mean) / self.scale @ w1 + b1) @ w2 + b2).ravel()

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4) -> Network:
        share = (y.sum() + 1) / (len(y) + 2)
        self.bias = float(np.log(share / (1 - share)))
        if len(set(y.tolist())) < 2:
            return self
        rng = np.random.default_rng(self.seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        z, k = ((x - self.mean) / self.scale).astype(np.float32), x.shape[1]
        w = [rng.normal(0, (2 / k) ** 0.5, (k, self.hidden)), np.zeros(self.hidden), rng.normal(0, (1 / self.hidden) ** 0.5, (self.hidden, 1)), np.full(1, self.bias)]
        first, second, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for epoch in range(epochs):
            for at in np.array_split(rng.permutation(len(z)), max(1, len(z) // batch)):
                h = np.maximum(0, z[at] @ w[0] + w[1])
                g = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30))) - y[at, None]) / len(at)
                gh = (g @ w[2].T) * (h > 0)
                step += 1
                for i, grad in enumerate((z[at].T @ gh + decay * w[0], gh.sum(0), h.T @ g + decay * w[2], g.sum(0))):
                    first[i] = 0.9 * first[i] + 0.1 * grad
                    second[i] = 0.999 * second[i] + 0.001 * grad**2
                    w[i] -= rate * (0.5 if epoch > epochs * 0.7 else 1) * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        self.w = w
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Network:
        """The temperature of least log loss, on rows that were not learned from."""
        if len(y) and self.w:
            z = self.logits(x)
            loss = lambda t: np.logaddexp(0, -np.where(y > 0, 1, -1) * z / t).mean()
            self.temperature = float(min(np.geomspace(0.25, 8, 141), key=loss))
        return self


def fit_quality(texts: DataFrame, labels: DataFrame, vectors: np.ndarray, *, label_col: str = "quality", sample: int = SAMPLE, folds: int = FOLDS, fold: int = 0) -> Network:
    """The network, from at most ``sample`` labelled rows outside the held-out fold; rows with a null label do not count."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where((F.col("label").isNotNull()) & F.col("doc_id").isNotNull() & (bucket_of("doc_id", folds) != fold))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    shared = share(texts.sparkSession, vectors)
    rows = texts.join(F.broadcast(known), "doc_id").select("doc_id", "label", "text").mapInArrow(tidy(_features(shared)), "doc_id long, label int, features binary").select("doc_id", "features", "label").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[2], bytes(r[1])))
    x = np.array([np.frombuffer(r[1], np.float32) for r in rows]).reshape(len(rows), FEATURES)
    y = np.array([float(r[2] > 0) for r in rows])
    aside = np.arange(len(rows)) % 6 == 5
    return Network().fit(x[~aside], y[~aside]).calibrate(x[aside], y[aside])


def _pooled(texts: list[str], units: Units, v: np.ndarray) -> np.ndarray:
    """Features (texts x FEATURES) of whole texts."""
    words, shapes, n = _tokens(texts, units)
    some = np.flatnonzero(n)
    out = np.zeros((len(n), FEATURES), np.float32)
    if len(some):
        starts = (np.cumsum(n) - n)[some]
        repeat = np.zeros(len(words), np.float32)
        repeat[1:] = (words[1:] == words[:-1]) & (shapes[1:] == shapes[:-1])
        repeat[starts] = 0
        per = n[some, None]
        out[some, :DIMS] = np.add.reduceat(v[words], starts) / per
        out[some, DIMS : 2 * DIMS] = np.add.reduceat(v[shapes], starts) / per
        out[some, -3:-2] = np.add.reduceat(repeat, starts)[:, None] / per
        out[some, -2] = np.log1p(n[some]) / 10
    out[:, -1] = n == 0
    return out


def _score(shared, text: int):
    """Adds the score to rows whose column number ``text`` is the text."""

    def run(batches):
        units, (v, net) = Units(), shared.value
        for batch in batches:
            for lo, texts in _chunks(batch, text):
                part = batch.slice(lo, len(texts))
                score = pa.array(net.probability(_pooled(texts, units, v)), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, score], names=[*(f"c{i}" for i in range(part.num_columns)), SCORE])

    return run


def _scored(docs: DataFrame, vectors: np.ndarray, network: Network, text_col: str) -> DataFrame:
    """All columns of ``docs`` by position (c0, c1, ...), as they may have any names, and the column ``SCORE``."""
    shared, names = share(docs.sparkSession, (vectors, network)), docs.columns
    inner = docs.toDF(*(f"c{i}" for i in range(len(names)))).withColumn(f"c{len(names)}", text_or_empty(f"c{names.index(text_col)}"))
    out = inner.mapInArrow(tidy(_score(shared, len(names))), T.StructType([*inner.schema.fields, T.StructField(SCORE, T.DoubleType())]))
    return out.drop(f"c{len(names)}")


def _fitted(docs: DataFrame, labels: DataFrame, text_col: str, id_col: str, **options) -> tuple[np.ndarray, Network]:
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    vectors = unit_vectors(base.select("text"))
    return vectors, fit_quality(base, labels, vectors, **options)


def quality_filter(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches ``threshold``; documents are not shuffled."""
    vectors, network = _fitted(docs, labels, text_col, id_col, **options)
    return _scored(docs, vectors, network, text_col).where(F.col(SCORE) >= threshold).drop(SCORE).toDF(*docs.columns)


def quality_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, folds: int = FOLDS, fold: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (the probability of label 1), predicted.

    A null text counts as empty; texts without words share one score. Labels of the fold crc32(doc_id as text) mod ``folds`` = ``fold`` are never learned from; a null id is treated as the empty text there. Without labels every score is 0.5, with one label only they are that label's smoothed share. An empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    vectors, network = _fitted(base, labels, "text", "doc_id", sample=sample, folds=folds, fold=fold)
    scored = _scored(base, vectors, network, "text").select(F.col("c0").alias("doc_id"), F.col(SCORE).alias("score"))
    return scored.select("doc_id", (bucket_of("doc_id", folds) == fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op4_quality": op4_quality}
ORACLES: dict = {}
