"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs, in numpy.

A word's inputs are the smoothed log-odds of its hashed form, the mean and the largest log-odds of its hashed character 4-grams (bytes, with marks at both ends), its length, and ``NOISE`` fixed pseudo-random numbers of its form. The log-odds are document counts over the labelled sample. Every text is cut into all its windows of ``WINDOW`` words, ``STRIDE`` apart, and the highest window decides the text.

Learning takes a bounded sample, at most ``SAMPLE`` labelled rows of each class from the training folds, chosen by a hash of the id. A toxic text does not say which window is: the network first learns from the windows of highest log-odds, then from those that it itself scores highest.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_up, bucket_of, materialize, share, table, text_or_empty, tidy

WINDOW = 32
STRIDE = 4
HIDDEN = 8
NOISE = 3
INPUTS = 4 + NOISE
WORD_BUCKETS = 1 << 17
GRAM_BUCKETS = 1 << 16
SAMPLE = 6_000
FOLDS = 4
FOLD = 2
THRESHOLD = 0.3
PRIOR = 10.0
CHUNK_WORDS = 1 << 17
PART = 1 << 13  # numbers a message carries when tables are added
CACHE_WORDS = 1 << 18
WINDOWS_AT_ONCE = 2048
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def _hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, 4-gram buckets of all words one after the other, and where each word's begin."""
    forms = [w.strip(EDGE).encode("utf-8", "replace") for w in words]
    marked = [b"^" + f + b"$\0\0" for f in forms]
    sizes = np.array([len(m) - 3 for m in marked], np.int64)
    flat = np.frombuffer(b"".join(marked) + b"\0\0\0", np.uint8)
    grams = np.ndarray((len(flat) - 3,), "<u4", flat, strides=(1,))
    starts = np.cumsum(sizes + 3) - sizes - 3
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    buckets = ((grams[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 16)).astype(np.int64)
    return np.array([zlib.crc32(f) % WORD_BUCKETS for f in forms], np.int64), buckets, np.cumsum(sizes) - sizes


class Inputs:
    """Rows of inputs for words, from tables of log-odds; ``project`` turns them into what the network adds at each step."""

    def __init__(self, word_odds: np.ndarray, gram_odds: np.ndarray, project=None):
        self.word_odds, self.gram_odds, self.project = word_odds, gram_odds, project or (lambda x: x)
        self.reset()

    def reset(self) -> None:
        self.number: dict[str, int] = {}
        blank = self.project(np.zeros((1, INPUTS), np.float32))
        self.rows, self.used = np.zeros((1024, blank.shape[1]), np.float32), 1  # row 0: no word

    def features(self, words: list[str]) -> np.ndarray:
        word, gram, starts = _hashed(words)
        odds = self.gram_odds[gram]
        counts = np.diff(starts, append=len(gram))
        noise = (word[:, None] * np.array([2654435761, 40503, 2246822519][:NOISE]) >> 7) % 1024 / 512.0 - 1.0
        return np.column_stack((self.word_odds[word], np.add.reduceat(odds, starts) / counts, np.maximum.reduceat(odds, starts), np.minimum(counts, 30) / 10, noise)).astype(np.float32)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of all words, and the words of each text."""
        if self.used > CACHE_WORDS:
            self.reset()
        split = [t.lower().split() for t in texts]
        n = np.array([len(s) for s in split], np.int64)
        number = self.number
        new = list({w: None for s in split for w in s if w not in number})
        if new:
            number.update(zip(new, range(self.used, self.used + len(new)), strict=True))
            need = self.used + len(new)
            if need > len(self.rows):
                self.rows = np.concatenate((self.rows, np.zeros((need, self.rows.shape[1]), np.float32)))
            self.rows[self.used : need] = self.project(self.features(new))
            self.used = need
        return np.fromiter((number[w] for s in split for w in s), np.int64, int(n.sum())), n


def windows(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the overlapping windows of texts of ``n`` words begin, and the text of each; a text without words has one empty window."""
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n)), count)
    return (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * STRIDE, text


def words_of(ids: np.ndarray, n: np.ndarray, begin: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Row numbers of the words of windows, 0 after the end."""
    at = begin[:, None] + np.arange(WINDOW)
    start = (np.cumsum(n) - n)[text, None]
    return np.where(at < n[text, None], np.append(ids, 0)[np.minimum(at + start, len(ids))], 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Two gated recurrent passes, attention over their states, one logit a window."""

    def __init__(self, seed: int = 3):
        rng, h = np.random.default_rng(seed), HIDDEN
        draw = lambda *shape: rng.normal(0, 0.4 / shape[0] ** 0.5, shape)
        self.p = {"w": draw(2, INPUTS, 3 * h), "b": np.zeros((2, 3 * h)), "u": draw(2, h, 3 * h), "v": draw(2 * h), "o": draw(2 * h) * 2, "c": np.array([-1.0])}
        self.scale = np.ones(INPUTS)

    def project(self, x: np.ndarray) -> np.ndarray:
        """What each word adds to the gates of both passes."""
        x = x / self.scale
        return np.concatenate([x @ self.p["w"][d] + self.p["b"][d] for d in (0, 1)], axis=1).astype(np.float32)

    def _pass(self, gates: np.ndarray, mask: np.ndarray, d: int, keep: bool):
        """States (steps, windows, HIDDEN) of pass ``d`` over gates (steps, windows, 3 HIDDEN)."""
        h, u = HIDDEN, self.p["u"][d].astype(gates.dtype)
        state, out, saved = np.zeros((gates.shape[1], h), gates.dtype), np.empty((*gates.shape[:2], h), gates.dtype), {}
        for t in range(len(gates)) if d == 0 else range(len(gates) - 1, -1, -1):
            s = state @ u
            zr = 1 / (1 + np.exp(-(gates[t, :, : 2 * h] + s[:, : 2 * h])))
            new = np.tanh(gates[t, :, 2 * h :] + zr[:, h:] * s[:, 2 * h :])
            after = new + zr[:, :h] * (state - new)
            after = np.where(mask[t], after, state)
            if keep:
                saved[t] = (state, zr, new, s[:, 2 * h :])
            out[t] = state = after
        return out, saved

    def logits(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; gates (steps, windows, 6 HIDDEN), mask (steps, windows, 1)."""
        h = HIDDEN
        one, save0 = self._pass(gates[:, :, : 3 * h], mask, 0, keep)
        two, save1 = self._pass(gates[:, :, 3 * h :], mask, 1, keep)
        states = np.concatenate((one, two), axis=2)
        weight = np.where(mask[:, :, 0], states @ self.p["v"].astype(gates.dtype), -30)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        out = pooled @ self.p["o"].astype(gates.dtype) + self.p["c"][0]
        return (out, states, weight, pooled, (save0, save1)) if keep else out

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
        """Gradients of the mean log loss; x (steps, windows, INPUTS), already scaled."""
        h, p = HIDDEN, self.p
        gates = np.concatenate([x @ p["w"][d] + p["b"][d] for d in (0, 1)], axis=2)
        out, states, weight, pooled, saves = self.logits(gates, mask, True)
        g = {k: np.zeros_like(a) for k, a in p.items()}
        dout = (_sigmoid(out) - y) / len(y)
        g["c"][0], g["o"] = dout.sum(), pooled.T @ dout
        dpooled = dout[:, None] * p["o"]
        dweight = (states * dpooled).sum(axis=2)
        dscore = weight * (dweight - (weight * dweight).sum(axis=0))
        dscore = np.where(mask[:, :, 0], dscore, 0)
        g["v"] = np.tensordot(dscore, states, ((0, 1), (0, 1)))
        dstates = weight[:, :, None] * dpooled + dscore[:, :, None] * p["v"]
        for d in (0, 1):
            dh, u = np.zeros((x.shape[1], h)), p["u"][d]
            for t in range(len(x) - 1, -1, -1) if d == 0 else range(len(x)):
                dh = dh + dstates[t, :, d * h : (d + 1) * h]
                state, zr, new, sn = saves[d][t]
                live = np.where(mask[t], dh, 0)
                z, r = zr[:, :h], zr[:, h:]
                dn = live * (1 - z) * (1 - new**2)
                dz = live * (state - new) * z * (1 - z)
                dr = dn * sn * r * (1 - r)
                ds = np.concatenate((dz, dr, dn * r), axis=1)
                dgate = np.concatenate((dz, dr, dn), axis=1)
                g["u"][d] += state.T @ ds
                g["w"][d] += x[t].T @ dgate
                g["b"][d] += dgate.sum(axis=0)
                dh = np.where(mask[t], live * z + ds @ u.T, dh)
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 1) -> Network:
        """Adam over windows x (windows, steps, INPUTS); an all-zero step is no word."""
        rng = np.random.default_rng(seed)
        real = (x != 0).any(axis=2)
        m, s, step = {k: np.zeros_like(a) for k, a in self.p.items()}, {k: np.zeros_like(a) for k, a in self.p.items()}, 0
        for epoch in range(epochs):
            for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
                g = self.gradients(np.swapaxes(x[at], 0, 1) / self.scale, real[at].T[:, :, None], y[at])
                size, step = np.sqrt(sum((a**2).sum() for a in g.values())), step + 1
                for k in self.p:
                    a = g[k] * min(1.0, 1.0 / (size + 1e-9))
                    m[k], s[k] = 0.9 * m[k] + 0.1 * a, 0.999 * s[k] + 0.001 * a**2
                    self.p[k] = self.p[k] - rate * 0.7**epoch * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
        return self


def window_logits(network: Network, rows: np.ndarray, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Logits of the windows that :func:`windows` names; ``ids`` are row numbers into projected rows.

    The same recursion as :meth:`Network.logits`, laid out so that every operation runs along windows: texts begin at multiples of ``STRIDE`` in one stream, so step t of neighbouring windows is a run of the stream's words t mod ``STRIDE``. Windows that begin too near a text's end to be asked for are computed and left out.
    """
    s, h, p = STRIDE, HIDDEN, network.p
    room = -(-np.maximum(n, 1) // s)
    total, more = int(room.sum()), -(-WINDOW // s)
    first, text = np.cumsum(room) - room, np.repeat(np.arange(len(n)), room)
    begin = (np.arange(total) - first[text]) * s
    stream = np.zeros((total + more) * s, np.int64)
    stream[np.repeat(first * s - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
    sign = np.tile(np.repeat(np.array([-1, 1], np.float32), (2 * h, h)), 2)  # 1 / (1 + exp(-x)) without the minus
    turn = [np.ascontiguousarray((p["u"][d] * sign[: 3 * h]).T, np.float32) for d in (0, 1)]
    heads = np.stack((p["v"], p["o"])).astype(np.float32)
    out = np.empty(total, np.float32)
    for lo in range(0, total, WINDOWS_AT_ONCE):
        hi = min(total, lo + WINDOWS_AT_ONCE)
        gates = (rows[stream[lo * s : (hi + more) * s]] * sign).reshape(-1, s, 6 * h).transpose(1, 2, 0).copy()
        live = np.arange(WINDOW)[:, None] < (n[text[lo:hi]] - begin[lo:hi])
        whole, states = live.all(axis=1), np.empty((WINDOW, 2 * h, hi - lo), np.float32)
        gate, zr, new = np.empty((3 * h, hi - lo), np.float32), np.empty((2 * h, hi - lo), np.float32), np.empty((h, hi - lo), np.float32)
        for d in (0, 1):
            state = np.zeros((h, hi - lo), np.float32)
            for t in range(WINDOW) if d == 0 else range(WINDOW - 1, -1, -1):
                x = gates[t % s, d * 3 * h : (d + 1) * 3 * h, t // s : t // s + hi - lo]
                np.matmul(turn[d], state, out=gate)
                np.add(gate[: 2 * h], x[: 2 * h], out=zr)
                with np.errstate(over="ignore"):
                    np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                np.multiply(zr[h:], gate[2 * h :], out=new)
                new += x[2 * h :]
                np.tanh(new, out=new)
                after = states[t, d * h : (d + 1) * h]
                np.subtract(state, new, out=after)
                after *= zr[:h]
                after += new
                if not whole[t]:
                    np.copyto(after, state, where=~live[t])
                state = after
        both = np.matmul(heads, states)
        weight = np.where(live, both[:, 0], np.float32(-30))
        weight = np.exp(weight - weight.max(axis=0))
        out[lo:hi] = (weight * both[:, 1]).sum(axis=0) / weight.sum(axis=0) + np.float32(p["c"][0])
    return out[begin < np.maximum(1, -(-(n - WINDOW) // s) + 1)[text] * s]


def _chunks(texts: list[str]):
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size < 6 * CHUNK_WORDS):
            size += len(texts[hi])
            hi += 1
        yield lo, texts[lo:hi]
        lo = hi


def _count(batches):
    """Texts of each class that hold each bucket, as parts of one flat table: texts, words, grams (2 x buckets each)."""
    word, gram, texts_of = np.zeros((2, WORD_BUCKETS), np.int32), np.zeros((2, GRAM_BUCKETS), np.int32), np.zeros(2, np.int64)
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            texts_of[label] += 1
            if words := list(set(text.lower().split())):
                w, g, _ = _hashed(words)
                word[label, np.unique(w)] += 1
                gram[label, np.unique(g)] += 1
    if texts_of.any():
        flat = np.concatenate((texts_of, word.ravel(), gram.ravel())).astype(np.float64)
        parts = [flat[lo : lo + PART] for lo in range(0, len(flat), PART)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts)), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], ["part", "sums"])


def _odds(counts: np.ndarray, texts: np.ndarray, without: int | None = None) -> np.ndarray:
    """Smoothed log-odds of label 1 against its share, by document counts (2 x buckets); ``without`` leaves out one text of that label, as a text that is learned from must not count itself."""
    if without is not None:
        counts, texts = counts.copy(), texts.copy()
        counts[without] = np.maximum(counts[without] - 1, 0)
        texts[without] = max(0, texts[without] - 1)
    share = (texts[1] + 1) / (texts.sum() + 2)
    return np.log((counts[1] + PRIOR * share) / (counts[0] + PRIOR * (1 - share))).astype(np.float32) - np.float32(np.log(share / (1 - share)))


def _pick(inputs, network):
    """Inputs of the windows to learn from: the highest of each text, and for label 0 also one that the text's hash picks."""

    def run(batches):
        by_label = [Inputs(*tables) for tables in inputs.value]
        for batch in batches:
            both = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for label, few in ((x, few) for x in (0, 1) for _, few in _chunks([t for t, y in both if y == x])):
                own = by_label[label]
                ids, n = own.ids(few)
                begin, text = windows(n)
                if network is None:
                    odds = np.maximum(own.rows[:, 0], 0) + np.maximum(own.rows[:, 2], 0)
                    upto = np.append(0, np.cumsum(np.rint(odds * (1 << 20)).astype(np.int64)[ids]))  # whole numbers: sums are exact
                    start = (np.cumsum(n) - n)[text]
                    scores = upto[start + np.minimum(begin + WINDOW, n[text])] - upto[start + begin]
                else:
                    scores = window_logits(network, network.project(own.rows[: own.used]), ids, n)
                order = np.lexsort((-scores, text))
                firsts = np.searchsorted(text[order], np.arange(len(few)))
                chosen = []
                for i, t in enumerate(few):
                    here = [int(order[firsts[i]])]
                    if not label:
                        total = int((firsts[i + 1] if i + 1 < len(few) else len(order)) - firsts[i])
                        here.append(int(order[firsts[i] + zlib.crc32(t.encode("utf-8", "replace")) % total]))
                    chosen += here
                x = own.rows[words_of(ids, n, begin[chosen], text[chosen])]
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(chosen), pa.int32()), pa.array([w.tobytes() for w in x], pa.binary())], ["label", "inputs"])

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", sample: int = SAMPLE, folds: int = FOLDS, fold: int = FOLD) -> tuple[tuple[np.ndarray, np.ndarray], Network, bool]:
    """Tables of log-odds, the network, and whether both labels were there to learn from."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col(label_col).cast("int") > 0).cast("int").alias("label")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (bucket_of("doc_id", folds) != fold))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id")
    known = known.where("label = 1").limit(sample).union(known.where("label = 0").limit(sample))
    texts = materialize(docs.join(F.broadcast(known), "doc_id").select("text", "label"), "sample")
    parts = sorted((i, x) for i, x in add_up(texts.mapInArrow(tidy(_count), "part int, sums binary")).collect())
    flat = np.frombuffer(b"".join(bytes(x) for _, x in parts)) if parts else np.zeros(2)
    n = flat[:2].astype(np.int64)
    network = Network()
    if not n.all():
        network.p["o"][:] = 0
        network.p["c"][0] = np.log((n[1] + 1) / (n[0] + 1))
        return (np.zeros(WORD_BUCKETS, np.float32), np.zeros(GRAM_BUCKETS, np.float32)), network, False
    word, gram = flat[2 : 2 + 2 * WORD_BUCKETS].reshape(2, -1), flat[2 + 2 * WORD_BUCKETS :].reshape(2, -1)
    tables = _odds(word, n), _odds(gram, n)
    shared = share(spark, [(_odds(word, n, label), _odds(gram, n, label)) for label in (0, 1)])
    seen: list = []
    for turn in range(3):
        rows = texts.mapInArrow(tidy(_pick(shared, network if turn else None)), "label int, inputs binary").collect()
        rows.sort(key=lambda r: (r[0], bytes(r[1])))
        x = np.frombuffer(b"".join(r[1] for r in rows), np.float32).reshape(-1, WINDOW, INPUTS)
        y = np.array([float(r[0]) for r in rows])
        if not turn:
            real = x[(x != 0).any(axis=2)]
            network.scale = np.maximum(real.std(axis=0), 1e-3).astype(np.float64)
        seen.append((x, y))
        # Windows that are hard for label 0 stay in the lesson; of label 1 only the present choice does.
        x, y = np.concatenate([x, *[a[b == 0] for a, b in seen[:-1]]]), np.concatenate([y, *[b[b == 0] for _, b in seen[:-1]]])
        network.fit(x, y, epochs=(5, 3, 3)[turn], seed=turn)
    return tables, network, True


def _score(shared):
    def run(batches):
        (word_odds, gram_odds), network = shared.value
        own = Inputs(word_odds, gram_odds, network.project)
        for batch in batches:
            for lo, texts in _chunks(batch.column(1).to_pylist()):
                ids, n = own.ids(texts)
                text = windows(n)[1]
                logits = window_logits(network, own.rows, ids, n)
                best = np.maximum.reduceat(logits, np.searchsorted(text, np.arange(len(texts))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), pa.array(_sigmoid(best.astype(np.float64))), pa.array(np.bincount(text, minlength=len(texts)), pa.int64())], ["doc_id", "score", "n_windows"])

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, folds: int = FOLDS, fold: int = FOLD, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (of the highest window), predicted, n_windows.

    A null text counts as empty; a text without words has one empty window. Labels of the fold crc32(doc_id as text) mod ``folds`` = ``fold`` are never learned from. Where one label or none is known, every score is its smoothed share. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    tables, network, _ = fit_toxicity(base, labels, sample=sample, folds=folds, fold=fold)
    scored = base.mapInArrow(tidy(_score(share(spark, (tables, network)))), "doc_id long, score double, n_windows long")
    return scored.select("doc_id", (bucket_of("doc_id", folds) == fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_windows")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op5_toxicity": op5_toxicity}
ORACLES: dict = {}
