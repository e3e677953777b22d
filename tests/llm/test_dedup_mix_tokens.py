"""Exact deduplication, mixing and token blocks, each against a brute-force version."""

import functools
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trackloom.llm import exact_dedup as exact
from trackloom.llm.exact_dedup import exact_dedup, golomb_decode, golomb_encode
from trackloom.llm.mixing import mix_sources
from trackloom.llm.token_blocks import _encoder, decode_block, decode_shard, encode_shard, read_token_blocks, write_token_blocks

DOCS = "doc_id long, text string, source string, kept string, size string"


def sample(spark, n=300, seed=1):
    r = random.Random(seed)
    texts = ["", None, "a b c", "a b  c", " lead", "x" * 20000, "é ñ ü\tz\n\nend "] + [" ".join(r.choice(["on", "de", "Un<|endoftext|>", "été", "1234", "..", "\n", ""]) for _ in range(r.randint(0, 80))) for _ in range(60)]
    rows = [(i, r.choice(texts) if r.random() < 0.7 else "hot copy", r.choice(["s1", "s2", "s3", "ß", None]) if r.random() < 0.6 else "hot", "k", "z") for i in range(n)]
    rows += [rows[3], (None, "a b c", "s1", "k", "z"), (None, "only null id", None, "k", "z")]
    return spark.createDataFrame(rows, DOCS), rows


@given(st.lists(st.integers(0, 2**48 - 1), unique=True, max_size=200))
@settings(max_examples=60, deadline=None)
def test_golomb_round_trip(values):
    x = np.sort(np.array(values, np.uint64))
    k, data = golomb_encode(x, 0)
    assert golomb_decode(data, len(x), k, 0).tolist() == x.tolist()


@pytest.mark.parametrize("options", [{}, {"block_rows": 20, "owners": 3}, {"fp_bits": 6, "owners": 2}])
def test_exact_dedup(spark, options):
    df, rows = sample(spark)
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    got = exact_dedup(df.repartition(5), **options).collect()
    assert len(got) == len(rows)
    kept = defaultdict(int)
    import hashlib

    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for g in got:
        ids = by_sha[g.text_sha256]
        known = [i for i in ids if i is not None]
        assert g.group_size == len(ids) and g.keep_id == (max(known) if known else None)
        kept[g.text_sha256] += g.kept
        assert not g.kept or g.doc_id == g.keep_id
    assert set(kept.values()) == {1}
    assert exact_dedup(df.limit(0)).count() == 0


def test_exact_dedup_messages_stay_linear():
    per_document = []
    for total in (10**9, 10**10, 10**11, 10**12):
        blocks = total / exact.BLOCK_ROWS
        per_document.append(blocks * exact.owners_for(total, exact.BLOCK_ROWS, 200) / total)
    assert max(per_document) <= 1 / exact.MESSAGE and exact.owners_for(0, 1, 4) == 4


def test_exact_dedup_hot_groups(spark, monkeypatch):
    """Groups over the bound take the broadcast, others the join; both in one result."""
    monkeypatch.setattr(exact, "HOT_ROWS", 5)
    rows = [(i, "hot" if i % 3 else f"text {i % 40}") for i in range(240)]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    got = {g.doc_id: (g.keep_id, g.group_size, g.kept) for g in exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {i: (max(groups[t]), len(groups[t]), i == max(groups[t])) for i, t in rows}


def test_mixing(spark):
    df, rows = sample(spark)
    size = lambda t: len((t or "").encode().split())
    per = defaultdict(int)
    for r in rows:
        per[r[2]] += size(r[1])
    order = sorted((s for s in per if s is not None)) + [None] * (None in per)
    weight = {s: Fraction(1 + i % 3) for i, s in enumerate(order)}
    total, capped = sum(per.values()), {}
    while True:
        rest = {s: w for s, w in weight.items() if s not in capped}
        share = {s: (total - sum(capped.values())) * w / sum(rest.values()) for s, w in rest.items()}
        over = [s for s in rest if share[s] > 3 * per[s]]
        if not over:
            break
        capped |= {s: Fraction(3 * per[s]) for s in over}
    target = {**share, **capped}
    got = mix_sources(df.repartition(7), block_rows=8).collect()
    assert len(got) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for g in got:
        assert g.source_size == per[g.source] and abs(g.target - float(target[g.source])) < 1e-6
        assert 0 <= g.taken <= 3 * g.size and g.taken == g.copies * g.size
        taken[g.source] += g.taken
        largest[g.source] = max(largest[g.source], g.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1e-6 for s in per)
    again = mix_sources(df.repartition(3), block_rows=8).collect()
    key = lambda g: (g.doc_id is None, g.doc_id, g.source or "", g.size, g.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mix_sources(df.limit(0)).count() == 0


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_block_round_trip(values):
    ids = np.array(values, np.uint32)
    image = encode_shard(ids)
    assert decode_shard(image).tolist() == values
    assert [int(x) for i in range(-(-len(values) // 256)) for x in decode_block(image, i)][: len(values)] == values


def test_token_blocks(spark):
    tokenizers = pytest.importorskip("tokenizers")
    P = pytest.importorskip("public_tokenizers")
    path = P.path("byte_bpe_50k.json")
    t = tokenizers.Tokenizer.from_file(path)
    df, rows = sample(spark)
    got = read_token_blocks(write_token_blocks(df.repartition(5), path, shard_ids=500)).collect()
    assert len(got) == len(rows)
    want = defaultdict(list)
    for doc_id, text, *_ in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want[doc_id].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    have = defaultdict(list)
    for g in got:
        have[g.doc_id].append((g.n_tokens, g.ids_crc32))
    assert {k: sorted(v) for k, v in want.items()} == {k: sorted(v) for k, v in have.items()}
    at, last = 0, -1
    for g in sorted(got, key=lambda g: g.start):
        assert g.start == at and (g.doc_id is None or g.doc_id >= last)
        at, last = at + g.n_tokens, last if g.doc_id is None else g.doc_id
    assert read_token_blocks(write_token_blocks(df.limit(0), path)).count() == 0


@functools.cache
def library_tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@given(st.lists(st.lists(st.sampled_from([*"aZé.,\n '19-\t  !|<>", "<|endoftext|>", " <|endoftext|>", "<|endoftext|"]), max_size=40).map("".join), max_size=12))
@settings(max_examples=300, deadline=None)
def test_encoder_gives_the_library_its_ids(texts):
    pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    want = [e.ids for e in library_tokenizer(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in _encoder(path).encode(texts)] == want
