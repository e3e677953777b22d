"""From raw documents to token blocks: quality, near copies, benchmark passages, source weights, tokens.

Each stage works on all that the one before it kept and returns the columns of documents; the last writes the token blocks and returns, from what it reads back, one row per document: doc_id, start, n_tokens, ids_crc32.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackloom.llm.common import materialize, table
from trackloom.llm.decontaminate import drop_contaminated
from trackloom.llm.mixing import take_mix
from trackloom.llm.near_dedup import drop_near_copies
from trackloom.llm.quality import quality_filter
from trackloom.llm.token_blocks import read_token_blocks, write_token_blocks


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on ``labels``, does not reject."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return drop_near_copies(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return take_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token blocks, read back."""
    import public_tokenizers

    return read_token_blocks(write_token_blocks(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("quality", quality), ("near_copies", near_copies), ("benchmark_passages", benchmark_passages), ("source_weights", source_weights), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what each returns is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
