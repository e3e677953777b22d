"""q-gram lemma filtering against plain edit distance over every region."""

import random

import numpy as np

from trackloom.llm.decontaminate import Probes, banded_distance, decontaminate, drop_contaminated, find_regions, normalize


def least_edits(pattern: bytes, text: bytes) -> int:
    """Edits between the pattern and its best part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(r, text, n):
    text = list(text)
    for _ in range(n):
        i = r.randrange(len(text) or 1)
        x = r.choice("sid") if text else "i"
        text[i : i + (x != "i")] = [] if x == "d" else [r.choice("abcdefgh ")]
    return "".join(text)


def matches(pattern: bytes, text: bytes) -> bool:
    """A plain version: one edit in 16 bytes; under 12 bytes the same bytes between borders."""
    if len(pattern) >= 12:
        return least_edits(pattern, text) <= len(pattern) // 16
    word = lambda c: c >= 128 or chr(c).isalnum() or c == 95
    padded = b" " + text + b" "
    return any(padded[i : i + len(pattern)] == pattern and not word(padded[i - 1]) and not word(padded[i + len(pattern)]) for i in range(1, len(padded) - len(pattern)))


def test_no_match_is_lost():
    r = random.Random(5)
    words = ["on", "tion", "the", "de", "é", "ble", "her", "st", "-"]
    make = lambda n: "".join(r.choice(words) + r.choice(["", " "]) for _ in range(n))
    items = [(i, make(60).strip()[:n].strip()) for i, n in enumerate([*range(1, 65), 70, 100, 140])]
    items += [(100, items[60][1]), (None, items[20][1])]
    probes = Probes(items)
    assert len(set(probes.text)) == len(probes.text)
    texts = []
    for _ in range(150):
        _, t = r.choice(items)
        texts.append(normalize(make(9) + r.choice([" ", "", ", "]) + edited(r, t, r.choice([0, 0, 1, 1, 2, 3, 4, 6])) + r.choice([" ", "", "."]) + make(6)))
    found = {(d, w) for d, w, _ in find_regions(texts, probes)}
    want = {(d, w) for d, t in enumerate(texts) for w, p in enumerate(probes.text) if matches(p, t)}
    assert found == want and len({len(probes.text[w]) for _, w in want}) > 20


def test_banded_distance():
    a = np.frombuffer(b"abcdefgh", np.uint8)[None]
    cost, best = banded_distance(a, np.frombuffer(b"xxabcdfgh" + b"." * 8, np.uint8)[None], 5)
    assert cost[0] == 1


def test_decontaminate(spark):
    item = "The quick brown fox jumps over the lazy dog while nine bright stars quietly follow the river down to the sea."
    bench = spark.createDataFrame([(1, item), (2, None), (3, "short"), (4, "another passage that is present here only once, and in a single piece of it.")], "item_id long, text string")
    near = item.replace("brown", "browm").upper().replace(" ", "\n ")
    rows = [(1, f"lead in text. {near} and more"), (2, None), (3, ""), (4, "clean " * 5000), (None, item), (5, item[:50]), (6, "x" * 300000 + item), (8, "short"), (7, "y " + "another passage that is present here only once, and in a single piece of it." + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'clash' as contaminated", "1 as tag", "'z' as item_id")
    for options in ({}, {"block_bytes": 100}):
        got = {(x.doc_id, x.contaminated): list(x.item_ids) for x in decontaminate(docs.repartition(3), bench, **options).collect()}
        assert got == {(1, True): [1], (2, False): [], (3, False): [], (4, False): [], (None, True): [1], (5, False): [], (6, True): [1], (8, True): [3], (7, True): [1, 4]}
    assert decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate(docs.limit(0), bench).count() == 0


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(1, "clean words only", "a"), (2, "holds the one benchmark passage here", "b")], "doc_id long, text string, c1 string").selectExpr("*", "'x' as contaminated", "'y' as c0")
    bench = spark.createDataFrame([(1, "the one benchmark passage")], "item_id long, text string")
    got = drop_contaminated(docs, bench)
    assert got.columns == docs.columns and [tuple(r) for r in got.collect()] == [(1, "clean words only", "a", "x", "y")]
