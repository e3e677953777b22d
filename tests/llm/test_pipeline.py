"""The pipeline's stages, each against a plain version on its own input."""

from collections import Counter

import pytest

from trackloom.llm.decontaminate import decontaminate
from trackloom.llm.mixing import mix_sources
from trackloom.llm.near_dedup import near_dedup
from trackloom.llm.quality import quality_scores


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    import random

    r = random.Random(6)
    word = lambda: "".join(r.choice(["on", "ti", "re", "ma", "el", "so", "da"]) for _ in range(r.randint(1, 4)))
    passage = " ".join(word() for _ in range(40))
    docs, labels = [], []
    for i in range(160):
        words = [word() for _ in range(r.randint(40, 90))]
        bad = i % 4 == 0
        text = " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words)
        if i % 9 == 5:
            text = docs[-1][1]
        if i % 11 == 1:
            text = f"{text} {passage} end"
        docs.append((i, text, "en", r.choice(["a", "b", None]), len(text)))
        if i % 2:
            labels.append((i, int(not text.split()[0].endswith("!!")), 0))
        else:
            labels.append((i, int(not bad), 0))
    docs += [(1000, None, None, None, None), docs[7]]
    at = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_stages(spark, corpus, tmp_path):
    cp = pytest.importorskip("corpus_pipeline")
    read = lambda name: spark.read.parquet(f"{corpus}/{name}.parquet")
    docs, after = read("documents"), {}
    columns = docs.columns
    before = {}
    for name, stage in cp.STAGES:
        before[name] = docs
        stage(spark, docs, corpus).write.parquet(f"{tmp_path}/{name}")
        docs = after[name] = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() and (name == "tokens" or docs.columns == columns)
    ids = lambda df: Counter(r[0] for r in df.select("doc_id").collect())
    kept = {r.doc_id for r in quality_scores(before["quality"], read("labels")).collect() if r.predicted}
    assert ids(after["quality"]) == Counter({k: v for k, v in ids(before["quality"]).items() if k in kept})
    kept = {r.doc_id for r in near_dedup(before["near_copies"]).collect() if r.kept}
    assert set(ids(after["near_copies"])) == kept and len(kept) < len(ids(before["near_copies"]))
    clean = {r.doc_id for r in decontaminate(before["benchmark_passages"], read("benchmark")).collect() if not r.contaminated}
    assert set(ids(after["benchmark_passages"])) == clean and len(clean) < len(ids(before["benchmark_passages"]))
    want = Counter()
    for r in mix_sources(before["source_weights"]).collect():
        want[r.doc_id] += r.copies
    assert ids(after["source_weights"]) == +want
    assert ids(after["tokens"]) == ids(before["tokens"])
    assert {tuple(r) for r in cp.run(spark, corpus).collect()} == {tuple(r) for r in after["tokens"].collect()}


def test_clashing_columns_stay(spark, corpus):
    from trackloom.llm.mixing import take_mix
    from trackloom.llm.near_dedup import drop_near_copies
    from trackloom.llm.quality import quality_filter

    docs = spark.read.parquet(f"{corpus}/documents.parquet").selectExpr("*", "doc_id + 1 as _kept_id", "doc_id + 2 as _quality_score", "doc_id + 3 as copies", "doc_id + 4 as key", "doc_id + 5 as c1", "doc_id + 6 as n")
    own = lambda df: df.columns == docs.columns and all(r.doc_id is None or [r._kept_id, r._quality_score, r.copies, r.key, r.c1, r.n] == [r.doc_id + i for i in range(1, 7)] for r in df.collect())
    assert own(take_mix(docs)) and own(quality_filter(docs, spark.read.parquet(f"{corpus}/labels.parquet"))) and own(drop_near_copies(docs.limit(20)))
