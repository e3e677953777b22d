"""Near-duplicate classes against a brute-force version, and the signatures' expectation."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from trackloom.llm import near_dedup as N
from trackloom.llm.near_dedup import Words, multisets, near_dedup, signatures


def shingles(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values()) if a and b else float(a == b)


def test_signatures_are_unbiased():
    r = random.Random(2)
    make = lambda: " ".join(f"w{r.randrange(6)}" for _ in range(60))
    agree, want = [], []
    for _ in range(150):
        common, a, b = make(), make(), make()
        x, y = f"{common} {common} {a}", f"{common} {b} {a} {a}"
        s = signatures(*multisets([x, y], Words()))
        agree.append((s[0] == s[1]).mean())
        want.append(similarity(shingles(x), shingles(y)))
    assert abs(np.mean(agree) - np.mean(want)) < 0.015
    heavy = ["a " * 3000, "a " * 1500]
    s = signatures(*multisets(heavy, Words()), m=4000)
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.04


@pytest.mark.parametrize("limits", [{}, {"BLOCK_SIGNATURES": 5, "BLOCK_NODES": 3}])
def test_classes(spark, limits, monkeypatch):
    for k, v in limits.items():
        monkeypatch.setattr(N, k, v)
    r = random.Random(9)
    word = lambda: f"w{r.randrange(4000)}"
    texts = []
    for _ in range(12):
        seed = [word() for _ in range(r.choice([4, 30, 150, 400]))]
        for _ in range(r.randint(1, 12)):
            copy = list(seed)
            for _ in range(r.randint(0, max(1, len(seed) // 50))):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += ["", None, "  \n", "One two", "one  TWO", "spam " * 4000, "spam " * 3900, "spam " * 2000, "x" * 200000]
    texts += ["hot copy of one text with quite a few words in it"] * 60
    rows = [(i, t, "k", 1) for i, t in enumerate(texts)]
    rows += [(None, "one two", "k", 1), (None, "only a null id has this text here", "k", 1), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, node int")
    sets = [shingles(x[1]) for x in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= 0.8:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    want = Counter()
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        for i in ids:
            want[(i, min(known) if known else None, len(ids))] += 1
    got = near_dedup(df.repartition(5)).collect()
    assert Counter((g.doc_id, g.class_id, g.class_size) for g in got) == want
    assert sum(g.kept for g in got) == len(groups) and all(g.doc_id == g.class_id for g in got if g.kept)
    assert near_dedup(df.limit(0)).count() == 0


def test_similarity_matrix():
    r = random.Random(3)
    texts = [" ".join(r.choice("ab") for _ in range(r.randint(0, 40))) for _ in range(12)]
    v, c, cuts = multisets(texts, Words())
    got = N._similarities(v, c, cuts, np.arange(12), np.arange(12))
    for i in range(12):
        for j in range(12):
            if i != j and texts[i] and texts[j]:  # a text is never compared with itself
                assert abs(got[i, j] - similarity(shingles(texts[i]), shingles(texts[j]))) < 1e-6


def test_long_chains_are_one_component(spark):
    r = random.Random(5)
    links, want = [], {}
    for n in (1, 2, 400, 900):
        nodes = [r.randbytes(16) for _ in range(n + 1)]
        links += [(a, b) if r.random() < 0.5 else (b, a) for a, b in zip(nodes, nodes[1:], strict=False)]
        want |= dict.fromkeys(nodes, min(nodes))
    rising = sorted(r.randbytes(16) for _ in range(500))
    links += list(zip(rising, rising[1:], strict=False)) + links[:5]
    want |= dict.fromkeys(rising, rising[0])
    df = spark.createDataFrame(links, "a binary, b binary")
    got = N.components(df).collect()
    assert {bytes(g.node): bytes(g.component) for g in got} == want and len(got) == len(want)
    assert N.components(df.limit(0)).count() == 0
    with pytest.raises(RuntimeError):
        N.components(df, rounds=2)


def test_chain_of_revisions_is_one_class(spark):
    r = random.Random(3)
    words = [f"w{r.randrange(10**6)}" for _ in range(60 + 4 * 400)]
    texts = [" ".join(words[4 * i : 4 * i + 60]) for i in range(400)]
    assert all(similarity(shingles(a), shingles(b)) >= 0.8 for a, b in zip(texts, texts[1:], strict=False))
    assert similarity(shingles(texts[0]), shingles(texts[2])) < 0.8
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = near_dedup(df).collect()
    assert {(g.class_id, g.class_size) for g in got} == {(0, 400)} and sum(g.kept for g in got) == 1


def test_one_document_of_each_group_stays(spark):
    text = "one text that a few rows repeat with the same id"
    rows = [(3, text, {"k": "v"})] * 4 + [(5, text, None), (7, "a text of its own", None), (7, "another text of that same id", None)]
    rows += [(None, "only null ids have this text", {"n": str(i)}) for i in range(6)] + [(None, None, None), (None, "", None), (None, text, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, more map<string,string>").repartition(3)
    got = N.drop_near_copies(df).collect()
    assert Counter((g.doc_id, g.text or "") for g in got) == Counter([(3, text), (7, "a text of its own"), (7, "another text of that same id"), (None, "only null ids have this text"), (None, "")])
    assert all(tuple(g) in rows for g in got)
    unique = N.drop_near_copies(df.where("doc_id = 7"))
    assert unique.columns == df.columns and unique.count() == 2
