"""Quality and toxicity: held-out accuracy on made-up texts, gradients against differences, defined results on odd rows."""

import random
import zlib

import numpy as np
import pytest

from trackloom.llm import quality, toxicity

BAD = ["zlurp", "grelk", "vonch"]


def rows(n, seed, spoil):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["on", "ti", "re", "ma", "el", "so"]) for _ in range(r.randint(1, 4)))
    out = []
    for i in range(n):
        words = [word() for _ in range(r.randint(3, 120))]
        label = int(r.random() < 0.3)
        out.append((i, " ".join(spoil(words, r) if label else words), label))
    return out


def junk(words, r):
    return [w.upper() + "!!" for w in words] if r.random() < 0.5 else [w for w in words for _ in range(4)]


def insult(words, r):
    words = list(words)
    for _ in range(r.randint(1, 3)):
        words.insert(r.randrange(len(words)), r.choice(BAD) + r.choice(["", "on", "re", "ti", "ma"]))
    return words


def frames(spark, data, name):
    odd = [(None, "no id here", "c", "c"), (9001, None, "c", "c"), (9002, "", "c", "c"), (9003, "so " * 40000, "c", "c"), (data[0][0], data[0][1], "c", "c")]
    docs = spark.createDataFrame([(i, t, "c", "c") for i, t, _ in data] + odd, "doc_id long, text string, score string, label string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data] + [(None, 1), (9001, None)], f"doc_id long, {name} int")
    return docs, labels, len(data) + len(odd)


def held_out_auc(got, data, folds, fold):
    truth = {i: y for i, _, y in data}
    pairs = [(g.score, truth[g.doc_id]) for g in got if g.held_out and g.doc_id in truth]
    for g in got:
        assert g.held_out == (zlib.crc32(str(g.doc_id if g.doc_id is not None else "").encode()) % folds == fold)
        assert 0 <= g.score <= 1 and g.predicted == int(g.score >= 0.3)
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg])


def test_quality(spark):
    data = [(i, t, 1 - y) for i, t, y in rows(500, 1, junk)]
    docs, labels, n = frames(spark, data, "quality")
    got = quality.quality_scores(docs.repartition(3), labels).collect()
    assert len(got) == n and held_out_auc(got, data, 5, 0) > 0.97
    assert quality.quality_scores(docs.limit(0), labels).count() == 0
    assert {g.score for g in quality.quality_scores(docs.limit(3), labels.limit(0)).collect()} == {0.5}


def test_toxicity(spark):
    data = rows(900, 2, insult)
    docs, labels, n = frames(spark, data, "toxic")
    got = toxicity.toxicity_scores(docs.repartition(3), labels).collect()
    assert len(got) == n and held_out_auc(got, data, 4, 2) > 0.95
    by = {g.doc_id: g.n_windows for g in got}
    assert by[9003] == -(-(40000 - toxicity.WINDOW) // toxicity.STRIDE) + 1 and by[9002] == 1
    assert toxicity.toxicity_scores(docs.limit(0), labels).count() == 0
    assert len({g.score for g in toxicity.toxicity_scores(docs.limit(5), labels.limit(0)).collect()}) == 1


def plain_logit(net, x):
    """One window's logit, word by word, in plain numpy; x (words, INPUTS)."""
    h, sig = toxicity.HIDDEN, lambda a: 1 / (1 + np.exp(-a))
    states = np.zeros((len(x), 2 * h))
    for d in (0, 1):
        state = np.zeros(h)
        for t in range(len(x))[:: 1 if d == 0 else -1]:
            gate, own = x[t] / net.scale @ net.p["w"][d] + net.p["b"][d], state @ net.p["u"][d]
            z, r = sig(gate[:h] + own[:h]), sig(gate[h : 2 * h] + own[h : 2 * h])
            state = z * state + (1 - z) * np.tanh(gate[2 * h :] + r * own[2 * h :])
            states[t, d * h : (d + 1) * h] = state
    weight = np.exp(states @ net.p["v"]) if len(x) else np.zeros(0)
    return (weight @ states / weight.sum() if len(x) else np.zeros(2 * h)) @ net.p["o"] + net.p["c"][0]


def test_window_scores_against_plain_recursion(monkeypatch):
    r, rng = random.Random(5), np.random.default_rng(5)
    monkeypatch.setattr(toxicity, "WINDOWS_AT_ONCE", 7)
    net = toxicity.Network()
    own = toxicity.Inputs(rng.normal(size=toxicity.WORD_BUCKETS).astype(np.float32), rng.normal(size=toxicity.GRAM_BUCKETS).astype(np.float32))
    texts = ["", "one", " ".join(["so"] * 33), *(" ".join(r.choice(["Über", "a!", "x-y", "re", "ma", "!!"]) for _ in range(k)) for k in (31, 32, 35, 36, 37, 70, 2)), ""]
    ids, n = own.ids(texts)
    begin, text = toxicity.windows(n)
    got = toxicity.window_logits(net, net.project(own.rows[: own.used]), ids, n)
    want = []
    for t, words in enumerate(x.lower().split() for x in texts):
        starts, k = [0], 0
        while k + toxicity.WINDOW < len(words):
            starts.append(k := k + toxicity.STRIDE)
        assert begin[text == t].tolist() == starts
        for k in starts:
            want.append(plain_logit(net, own.features(words[k : k + toxicity.WINDOW]).astype(float) if words else np.zeros((0, toxicity.INPUTS))))
    assert np.allclose(got, want, atol=1e-5)


@pytest.mark.parametrize("name", ["w", "u", "v", "o", "b", "c"])
def test_gradients(name):
    rng = np.random.default_rng(0)
    net = toxicity.Network()
    x, y = rng.normal(size=(7, 5, toxicity.INPUTS)), np.array([1.0, 0, 1, 0, 1])
    mask = np.ones((7, 5, 1), bool)
    mask[4:, 1] = False
    x[~mask[:, :, 0]] = 0

    def loss():
        gates = np.concatenate([x @ net.p["w"][d] + net.p["b"][d] for d in (0, 1)], axis=2)
        return np.logaddexp(0, np.where(y > 0, -1, 1) * net.logits(gates, mask)).mean()

    g, p = net.gradients(x, mask, y)[name], net.p[name]
    for at in {tuple(rng.integers(0, s) for s in p.shape) for _ in range(6)}:
        old, e = p[at], 1e-5
        p[at] = old + e
        up = loss()
        p[at] = old - e
        down = loss()
        p[at] = old
        assert abs((up - down) / (2 * e) - g[at]) < 1e-6


def test_vectors_and_pooling_against_plain_loops(spark):
    texts = ["", "The cat, the cat SAT!", "so so so Über-x re 12 12", None, "alone", "x " * 300 + "end.", "The cat, the cat SAT!"]
    docs = spark.createDataFrame([(t or "",) for t in texts], "text string").repartition(3)
    units, (dims, signs) = quality.Units(), quality.index_vectors()
    own = lambda w: (units[w] & (quality.WORDS - 1), quality.WORDS + (units[w] >> 14))
    want = np.zeros((quality.UNITS, quality.DIMS))
    for t in texts:
        words = (t or "").split()
        for i, w in enumerate(words):
            for unit, other in (own(w), own(w)[::-1]):
                beside = [u for j in (i - 1, i + 1) if 0 <= j < len(words) for u in own(words[j])]
                for near in [other, *beside]:
                    for d, sign in zip(dims[near], signs[near], strict=True):
                        want[unit, d] += sign
    want = want / np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    got = quality.unit_vectors(docs)
    assert np.allclose(got, want, atol=1e-6) and np.abs(want).sum() > 0
    pooled = quality._pooled([t or "" for t in texts], units, got)
    for t, row in zip(texts, pooled, strict=True):
        words = (t or "").split()
        plain = np.zeros(quality.FEATURES)
        if words:
            plain[: quality.DIMS] = np.mean([got[own(w)[0]] for w in words], axis=0)
            plain[quality.DIMS : 2 * quality.DIMS] = np.mean([got[own(w)[1]] for w in words], axis=0)
            plain[-3] = sum(own(a) == own(b) for a, b in zip(words, words[1:], strict=False)) / len(words)
            plain[-2] = np.log1p(len(words)) / 10
        plain[-1] = not words
        assert np.allclose(row, plain, atol=1e-5), t


def test_temperature_restores_probabilities():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, quality.FEATURES))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality.Network().fit(x[:2000], y[:2000], epochs=60)
    before = np.abs(net.logits(x[2000:])).mean()
    net.calibrate(x[2000:], y[2000:])
    p = net.probability(x[2000:])
    assert net.temperature > 1 and before > 0
    assert abs(p[p > 0.8].mean() - y[2000:][p > 0.8].mean()) < 0.07
