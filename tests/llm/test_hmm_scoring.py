"""Hidden Markov scores against plain recursions and counts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from trackloom.llm import hmm_scoring as H


def small(states=3, symbols=5, seed=0):
    r = np.random.default_rng(seed)
    norm = lambda a, axis: a / a.sum(axis=axis, keepdims=True)
    return H.Model(norm(r.random(states), 0), norm(r.random((states, states)), 1), norm(r.random((symbols, states)), 0))


def paths(model, seq):
    """Probability, and expected counts, by all state paths."""
    import itertools

    n, s = len(seq), len(model.start)
    total, start, move, emit = 0.0, np.zeros(s), np.zeros((s, s)), np.zeros(model.emit.shape)
    for path in itertools.product(range(s), repeat=n):
        p = float(model.start[path[0]]) * math.prod(float(model.emit[o, q]) for o, q in zip(seq, path, strict=True)) * math.prod(float(model.move[a, b]) for a, b in zip(path, path[1:], strict=False))
        total += p
        start[path[0]] += p
        for a, b in zip(path, path[1:], strict=False):
            move[a, b] += p
        for o, q in zip(seq, path, strict=True):
            emit[o, q] += p
    return total, start / total, move / total, emit / total


def test_recursions_against_all_paths():
    model, r = small(), random.Random(1)
    seqs = [[r.randrange(5) for _ in range(n)] for n in (1, 4, 6, 2, 6)]
    flat, lengths = np.array(sum(seqs, []), np.int32), np.array([len(s) for s in seqs])
    want = [paths(model, s) for s in seqs]
    assert np.allclose(H.forward(model, flat, lengths), [math.log10(w[0]) for w in want], atol=1e-5)
    likelihood, *counts = H.expected_counts(model, flat, lengths)
    assert abs(likelihood - sum(math.log10(w[0]) for w in want)) < 1e-4
    for got, i in zip(counts, (1, 2, 3), strict=True):
        assert np.allclose(got, sum(w[i] for w in want), atol=1e-4)


def test_learning_raises_likelihood():
    model, r = small(3, 6, 3), np.random.default_rng(5)
    flat, lengths = r.integers(0, 3, 600).astype(np.int32), np.full(30, 20)
    flat[300:] += 3
    before = H.forward(model, flat, lengths).sum()
    for _ in range(4):
        _, s, m, e = H.expected_counts(model, flat, lengths)
        model = H.Model(s / s.sum(), m / m.sum(axis=1, keepdims=True), e / e.sum(axis=0))
        after = H.forward(model, flat, lengths).sum()
        assert after >= before - 1e-3
        before = after


def test_scores(spark):
    r = random.Random(4)
    kinds = [["the", "of", "and", "thing", "Other,"], ["été", "où", "ça", "nous", "rien"]]
    texts = [" ".join(r.choice(k) + r.choice(["", "", "s", str(r.randrange(99))]) for _ in range(r.randint(1, 150))) for k in kinds * 120] + ["", None, "A\x0bB c\x1cd  e", "x " * 30000]
    rows = [(i, t, 1.0) for i, t in enumerate(texts)] + [(None, "the end", 1.0), (3, texts[3], 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = H.hmm_scores(df.repartition(4), head=20).collect()
    assert len(got) == len(rows)
    fold = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7
    import re

    cut = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall("[^\\x20\\x09-\\x0D]+", t or "")] + [None]
    c = Counter(w for i, t, _ in rows if fold(i) != 2 for w in cut(t))
    n, v = sum(c.values()), len(c)
    want = {}
    for i, t, _ in rows:
        ws = cut(t)
        want[(i, len(ws))] = (fold(i) == 2, sum(w in c for w in ws), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
    gain = 0.0
    for g in got:
        held, known, base = want[(g.doc_id, g.n_tokens)]
        assert (g.held_out, g.n_known, g.train_tokens) == (held, known, n) and abs(g.base_score - base) < 1e-6 * abs(base) + 1e-9
        assert g.score < 0
        gain += (g.score - g.base_score) * held * (g.n_tokens < 1000)
    assert gain > 0
    assert H.hmm_scores(df.limit(0)).count() == 0


def test_within_symbols_probabilities_sum_to_one():
    v = H.Vocabulary([(b"", 5), (b"a", 9)], {3: (4, 2)}, 18, 4)
    m = H.Model.first(v, 3)
    assert np.allclose(m.emit.sum(axis=0), 1, atol=1e-5) and np.allclose(m.move.sum(axis=1), 1, atol=1e-5)
    assert sum((c + 1) / 10 ** v.tail_log[3] for c in (3, 1)) + 1 / 10 ** v.tail_log[3] == pytest.approx(1)


@pytest.mark.parametrize("most", [50, 300, 10**6])
def test_groups_hold_every_row_once(monkeypatch, most):
    import pyarrow as pa

    monkeypatch.setattr(H, "BATCH_TOKENS", most)
    monkeypatch.setattr(H, "LENGTHS", (4, 16))
    r = np.random.default_rng(2)
    seqs = [np.arange(n, dtype=np.int32) + i for i, n in enumerate(r.choice([1, 3, 4, 9, 16, 70], 60))]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(lo, lo + 15)), pa.array([s.tobytes() for s in seqs[lo : lo + 15]], pa.binary())], ["id", "s"]) for lo in range(0, 60, 15)]
    seen = []
    for parts, flat, lengths in H._groups(iter(batches), 1):
        ids = [i for p in parts for i in p.column(0).to_pylist()]
        assert lengths.tolist() == [len(seqs[i]) for i in ids] and flat.tolist() == np.concatenate([seqs[i] for i in ids]).tolist()
        assert lengths[:-1].sum() < most
        seen += ids
    assert sorted(seen) == list(range(60)) and list(H._groups(iter([]), 1)) == []
