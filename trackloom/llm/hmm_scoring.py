"""Language-model scores by a hidden Markov model over words.

Tokens are the words between white space of the text with A-Z lower-cased, then one end token. The ``HEAD`` most frequent tokens are symbols of their own; every other word is one of ``TAIL`` symbols that its last three bytes decide, and within a symbol has the probability (c + 1) / (N_s + V_s + 1), where c is its count and N_s and V_s are the symbol's tokens and distinct words in training. As that factor does not depend on the state, an exact likelihood needs two things: the forward recursion over symbols, whose tables have a fixed size, and the count of every word, however rare, which is a join with the whole vocabulary.

1. Each partition counts its training words; the counts are added to a vocabulary table.
2. All documents are written as symbol sequences, with their rare words beside them.
3. Baum-Welch: each partition runs scaled forward-backward over its training sequences; expected counts are added over partitions; over all training documents, until a round gains less than ``GAIN`` a token. It starts from states that stand for clusters of the head words by their byte pairs.
4. The scaled forward recursion scores every sequence, and the rare words' counts are joined in.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import add_up, bucket_of, discard, materialize, share, table, text_or_empty, tidy

STATES = 8
HEAD = 1 << 16
TAIL = 1 << 10
GAIN = 0.05  # log10 probability a token
FOLDS = 7
FOLD = 2
END = b""
BATCH_TOKENS = 1 << 20
LENGTHS = (1 << 10, 1 << 12)  # sequences run beside others of their class of lengths
COUNTER_WORDS = 1 << 18
CHUNK = 4096  # symbols a message carries when expected counts are added


def tokens(text: str) -> list[bytes]:
    """Words of a text, without the end token."""
    return text.encode("utf-8", "replace").lower().split()


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % TAIL


def _count(batches):
    counts: Counter = Counter()

    def out():
        words = list(counts)
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([tail_class(w) for w in words], pa.int32()), pa.array(list(counts.values()), pa.int64())], ["word", "tail", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(tokens(text))
            if len(counts) > COUNTER_WORDS:
                yield out()
                counts.clear()
        counts[END] += batch.num_rows
    if counts:
        yield out()


class Vocabulary:
    """What every task needs to turn words into symbols: head tokens and, for tail symbols, the logarithm of N_s + V_s + 1."""

    def __init__(self, head: list[tuple[bytes, int]], tail: dict[int, tuple[int, int]], total: int, distinct: int):
        self.words = [END, *[w for w, _ in head if w != END]]
        by = dict(head)
        self.counts = np.array([by.get(w, 0) for w in self.words], np.int64)
        self.tail_tokens = np.array([tail.get(i, (0, 0))[0] for i in range(TAIL)], np.int64)
        self.tail_log = np.log10([sum(tail.get(i, (0, 0))) + 1.0 for i in range(TAIL)])
        self.total, self.distinct = total, distinct
        self.symbols = len(self.words) + TAIL
        self.log = np.log10(self.counts + 1.0)

    def number(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}


def _encode(shared):
    def run(batches):
        v: Vocabulary = shared.value
        known, heads = v.number(), len(v.words)
        for batch in batches:
            sequences, rare, logs, heads_known, n = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                words = tokens(text)
                ids = list(map(known.get, words))
                own: list = []
                if None in ids:
                    own = [w for w, i in zip(words, ids, strict=True) if i is None]
                    ids = [heads + tail_class(w) if i is None else i for w, i in zip(words, ids, strict=True)]
                ids.append(0)
                s = np.array(ids, np.int32)
                at = s[s < heads]
                sequences.append(s.tobytes())
                rare.append(list(Counter(own).items()))
                logs.append(float(v.log[at].sum()))
                heads_known.append(int((v.counts[at] > 0).sum()))
                n.append(len(s))
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0] + [len(r) for r in rare]), pa.int32()), pa.StructArray.from_arrays([pa.array([w for r in rare for w, _ in r], pa.binary()), pa.array([k for r in rare for _, k in r], pa.int32())], ["word", "times"])
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(heads_known, pa.int64()), pa.array(logs), pa.array(sequences, pa.binary()), lists], ["doc_id", "n_tokens", "head_known", "head_log", "symbols", "rare"])

    return run


ENCODED = "doc_id long, n_tokens long, head_known long, head_log double, symbols binary, rare array<struct<word: binary, times: int>>"


class Model:
    """Start, transition (state x state) and emission (symbol x state) probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start.astype(np.float32), move.astype(np.float32), emit.astype(np.float32)

    @classmethod
    def first(cls, v: Vocabulary, states: int = STATES) -> Model:
        """States from clusters of the head words by their byte pairs, weighted by their counts."""
        heads = len(v.words)
        x = np.zeros((heads, 64))
        for i, w in enumerate(v.words):
            marked = b"^" + w + b"$"
            for a, b in zip(marked, marked[1:], strict=False):
                x[i, (a * 31 + b * 17 + (a * b >> 3)) % 64] += 1
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        weight = v.counts + 1.0
        centre = [x[np.argmax(weight)]]
        for _ in range(states - 1):  # each next centre is the heaviest word far from those before
            far = 1 - np.max(x @ np.array(centre).T, axis=1)
            centre.append(x[np.argmax(far**2 * np.sqrt(weight))])
        centre = np.array(centre)
        for _ in range(12):
            near = np.argmax(x @ centre.T, axis=1)
            centre = np.array([(x * weight[:, None])[near == s].sum(axis=0) if (near == s).any() else centre[s] for s in range(states)])
            centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
        share = np.full((v.symbols, states), 0.15 / states)
        share[np.arange(heads), near] += 0.85
        share[0] = 1 / states
        suffix = np.array([tail_class(w) for w in v.words])
        for s in range(states):
            share[heads:, s] = np.bincount(suffix, share[:heads, s], TAIL) + 1 / states
        share[heads:] /= share[heads:].sum(axis=1, keepdims=True)
        emit = share * (np.concatenate((v.counts, v.tail_tokens)) + 0.5)[:, None]
        return cls(np.full(states, 1 / states), np.eye(states) * 0.9 + 0.1 / states, emit / emit.sum(axis=0))

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, v: Vocabulary) -> Model:
        """Probabilities from expected counts; every symbol keeps a little mass in every state."""
        back = (np.concatenate((v.counts, v.tail_tokens)) + 0.5) / (v.total + 0.5 * v.symbols)
        emit = emit + 5.0 * back[:, None]
        start, move = start + 0.1, move + 0.1
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _steps(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences by falling length; how many are still running at each step; where each step's cells begin."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    running = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
    return order, running, np.concatenate(([0], np.cumsum(running)))


def _by_step(flat: np.ndarray, lengths: np.ndarray, order: np.ndarray, running: np.ndarray) -> np.ndarray:
    """Symbols of sequences laid one after the other, laid step by step."""
    starts = (np.cumsum(lengths) - lengths)[order]
    step = np.repeat(np.arange(len(running)), running)
    lane = np.arange(len(flat)) - np.repeat(np.cumsum(running) - running, running)
    return flat[starts[lane] + step]


def forward(model: Model, flat: np.ndarray, lengths: np.ndarray, keep: bool = False):
    """Log10 likelihood of each sequence by the scaled forward recursion; with ``keep`` also what the backward pass needs."""
    order, running, cells = _steps(lengths)
    symbols = _by_step(flat, lengths, order, running)
    alpha = np.empty((len(flat), len(model.start)), np.float32) if keep else None
    scale = np.empty(len(flat), np.float32)
    emit = model.emit.take(symbols, axis=0)
    state = np.broadcast_to(model.start, (len(lengths), len(model.start)))
    for t, n in enumerate(running.tolist()):
        at = slice(cells[t], cells[t] + n)
        state = (state[:n] @ model.move if t else state[:n]) * emit[at]
        total = state.sum(axis=1)
        scale[at] = total
        state = state / total[:, None]
        if keep:
            alpha[at] = state
    lane = np.arange(len(flat)) - np.repeat(cells[:-1], running)
    out = np.empty(len(lengths))
    out[order] = np.bincount(lane, np.log10(scale.astype(np.float64)), len(lengths))
    return (out, alpha, scale, symbols, emit, running, cells) if keep else out


def expected_counts(model: Model, flat: np.ndarray, lengths: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Log10 likelihood, and expected starts, moves and emissions, of sequences under the model (one step of Baum-Welch)."""
    likelihood, alpha, scale, symbols, emitted, running, cells = forward(model, flat, lengths, True)
    states = len(model.start)
    move = np.zeros((states, states))
    beta, back = np.ones((0, states), np.float32), model.move.T.copy()
    emitted /= scale[:, None]
    for t in range(len(running) - 1, -1, -1):
        n, at = int(running[t]), slice(cells[t], cells[t] + int(running[t]))
        now = np.ones((n, states), np.float32)
        if len(beta):
            later = slice(cells[t + 1], cells[t + 1] + len(beta))
            ahead = emitted[later] * beta
            move += alpha[at][: len(beta)].T @ ahead
            now[: len(beta)] = ahead @ back
        beta = now
        alpha[at] *= beta
    emit = np.stack([np.bincount(symbols, alpha[:, s], len(model.emit)) for s in range(states)], axis=1)
    return float(likelihood.sum()), alpha[: int(running[0])].sum(axis=0, dtype=np.float64) if len(running) else np.zeros(states), move * model.move, emit


def _groups(batches, column: int):
    """Rows until BATCH_TOKENS symbols are together: (batch parts, symbols one after the other, lengths).

    A recursion takes as many steps as its longest sequence has symbols, so long sequences wait for others of their class; what is left at the end runs together where it fits.
    """
    waiting: list = [([], [], 0) for _ in range(len(LENGTHS) + 1)]

    def group(parts, data):
        return parts, np.frombuffer(b"".join(data), np.int32), np.array([len(d) // 4 for d in data])

    for batch in batches:
        values = batch.column(column).to_pylist()
        kinds = np.searchsorted(LENGTHS, [len(x) // 4 for x in values], side="right")
        for kind in np.unique(kinds).tolist():
            parts, data, size = waiting[kind]
            at, lo = np.flatnonzero(kinds == kind), 0
            for i, j in enumerate(at.tolist()):
                data.append(values[j])
                size += len(values[j]) // 4
                if size >= BATCH_TOKENS:
                    yield group([*parts, batch.take(pa.array(at[lo : i + 1]))], data)
                    parts, data, size, lo = [], [], 0, i + 1
            if lo < len(at):
                parts.append(batch.take(pa.array(at[lo:])))
            waiting[kind] = (parts, data, size)
    if sum(size for _, _, size in waiting) <= BATCH_TOKENS:
        waiting = [(sum((p for p, _, _ in waiting), []), sum((d for _, d, _ in waiting), []), 0)]
    for parts, data, _ in waiting:
        if data:
            yield group(parts, data)


def _learn(shared):
    def run(batches):
        model: Model = shared.value
        sums, found = None, 0.0
        for _, flat, lengths in _groups(batches, 0):
            likelihood, *got = expected_counts(model, flat, lengths)
            found += likelihood
            sums = got if sums is None else tuple(a + b for a, b in zip(sums, got, strict=True))
        if sums is not None:
            start, move, emit = sums
            rows = [(-1, np.concatenate((start, move.ravel(), [found])))] + [(i // CHUNK, emit[i : i + CHUNK].ravel()) for i in range(0, len(emit), CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([x.astype(np.float64).tobytes() for _, x in rows], pa.binary())], ["part", "sums"])

    return run


def _score(shared):
    def run(batches):
        model, tail_log, heads = shared.value
        for parts, flat, lengths in _groups(batches, 5):
            out = forward(model, flat, lengths)
            rare = np.flatnonzero(flat >= heads)
            doc = np.searchsorted(np.cumsum(lengths), rare, side="right")
            out -= np.bincount(doc, tail_log[flat[rare] - heads], len(lengths))
            rows = pa.Table.from_batches(parts).drop_columns(["symbols"]).append_column("part_score", pa.array(out)).combine_chunks()
            yield from rows.to_batches()

    return run


def count_words(texts: DataFrame) -> DataFrame:
    """(word, tail, c) of every token of ``texts``; the end token is the empty word."""
    parts = texts.mapInArrow(tidy(_count), "word binary, tail int, n long")
    return materialize(parts.groupBy("word", "tail").agg(F.sum("n").alias("c")), "vocabulary")


def _head(words: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The end token, if it occurs, and the words whose count is so high that at most ``most`` words reach it.

    The least such count comes from a histogram of counts, so only the chosen words reach the driver.
    """
    is_end = F.length("word") == 0
    above = F.sum("words").over(Window.orderBy(F.desc("c")))
    least = words.where(~is_end).groupBy("c").agg(F.count("*").alias("words")).withColumn("above", above).where(F.col("above") <= most).agg(F.min("c")).first()[0]
    chosen = words.where(is_end | (F.col("c") >= F.lit(least))) if least is not None else words.where(is_end)
    return sorted(((bytes(w), c) for w, c in chosen.select("word", "c").collect()), key=lambda x: (x[0] != END, -x[1], x[0]))


def fit(encoded: DataFrame, v: Vocabulary, gain: float = GAIN) -> Model:
    """Baum-Welch over the symbol sequences in ``encoded``, until a round gains less than ``gain`` a token (log10). Each round gains at least that and the likelihood is bounded, so it ends."""
    spark, model, before = encoded.sparkSession, Model.first(v), None
    while True:
        shared = spark.sparkContext.broadcast(model)
        sums = add_up(encoded.select("symbols").mapInArrow(tidy(_learn(shared)), "part int, sums binary")).collect()
        shared.destroy()
        got = {i: np.frombuffer(x) for i, x in sums}
        if not got:
            return model
        s, found = len(model.start), got[-1][-1] / v.total
        emit = np.concatenate([got[i] for i in range(-(-v.symbols // CHUNK))]).reshape(-1, s)
        model = Model.of_counts(got[-1][:s], got[-1][s:-1].reshape(s, s), emit, v)
        if before is not None and found - before < gain:
            return model
        before = found


def hmm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, fold: int = FOLD, head: int = HEAD, gain: float = GAIN) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32(doc_id as text) mod ``folds`` is not ``fold`` (a null id as the empty text). A null text counts as empty: it is the end token alone. ``base_score`` sums log10((c + 1) / (N + V + 1)); ``score`` is the model's log10 probability of all tokens. Rows that repeat count as often as they occur. An empty table gives an empty result; with no row to learn from every word is unknown.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    train = bucket_of("doc_id", folds) != fold
    words = count_words(base.where(train).select("text"))
    total, distinct = (x or 0 for x in words.agg(F.sum("c"), F.count("*")).first())
    top = _head(words, head)
    heads = spark.createDataFrame([(w,) for w, _ in top], "word binary")
    rest = words.join(F.broadcast(heads), "word", "left_anti")
    tail = {i: (n, k) for i, n, k in rest.groupBy("tail").agg(F.sum("c"), F.count("*")).collect()}
    v = Vocabulary(top, tail, total, distinct)

    encoded = materialize(base.mapInArrow(tidy(_encode(share(spark, v))), ENCODED).withColumn("row", F.monotonically_increasing_id()), "encoded")
    model = fit(encoded.where(train), v, gain)
    shared = share(spark, (model, v.tail_log, len(v.words)))
    scored = encoded.select("row", "doc_id", "n_tokens", "head_known", "head_log", "symbols").mapInArrow(tidy(_score(shared)), "row long, doc_id long, n_tokens long, head_known long, head_log double, part_score double")
    rare = encoded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    rare = rare.join(rest.select("word", "c"), "word").groupBy("row").agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("rare_log"))
    out = scored.join(rare, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return out.select(
        "doc_id",
        (bucket_of("doc_id", folds) == fold).alias("held_out"),
        "n_tokens",
        (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_log") + rare_log - F.col("n_tokens") * F.lit(float(np.log10(total + distinct + 1)))).alias("base_score"),
        (F.col("part_score") + rare_log).alias("score"),
    )


def op6_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_scores(table(spark, sf_dir, "documents"))


QUERIES = {"op6_hmm_scores": op6_hmm_scores}
ORACLES: dict = {}
