"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source's target divided by its size is the number of copies each of its documents should have: a whole part for all, and a fraction. The fractions are rounded dependently. Two documents meet, mass moves from one to the other at random, without changing the expected copies of either or the words of both together, until one of the two is whole; the other, still fractional, meets the next. Each block of about ``block_rows`` documents is folded so to one residual; the residuals of a source are folded again, block by block, until one is left, which is rounded alone. So a source's words miss its target by less than one document, and a hot source is only more blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table, text_or_empty

WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3.0
BLOCK_ROWS = 64
SEED = 20240
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per source: source, source_size, n, target. Sources in code-point order, null last, weigh ``weights`` in turn; a target stops at ``cap`` times its source's size and the excess goes to the others by weight.

    The fixed point of that sharing is min(cap * size, level * weight); ordered by cap * size / weight, the level is the first that the next source's ratio reaches. Works on one row a source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count("*").alias("n"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("most", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("most") / F.col("weight"))
    whole = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    after = whole.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    per = per.withColumn("at", (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    per = per.withColumn("level", F.min(F.when(F.col("ratio") >= F.col("at"), F.struct("ratio", "at"))).over(everything)["at"])
    return per.select("source", "source_size", "n", F.least("most", F.coalesce("level", F.lit(0.0)) * F.col("weight")).alias("target"))


def _uniform(*key: Column) -> Column:
    """A number in [0, 1) that depends on ``key`` alone."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11)).cast("double") / F.lit(float(1 << 53))


def _fold(level: int, seed: int):
    """Fold of units (doc_id, tag, size, whole, p): the state is the residual and the units decided so far, each with the copies it gets on top of ``whole``."""

    def meet(state: Column, x: Column) -> Column:
        c = state["residual"]
        up = F.least((1 - c["p"]) * c["size"], x["p"] * x["size"])
        down = F.least(c["p"] * c["size"], (1 - x["p"]) * x["size"])
        rise = _uniform(F.lit(seed), F.lit(level), c["doc_id"], c["tag"], x["doc_id"], x["tag"]) * (up + down) < down
        # Which of the two becomes whole, and the fraction the other keeps.
        first = F.when(rise, (1 - c["p"]) * c["size"] <= x["p"] * x["size"]).otherwise(c["p"] * c["size"] <= (1 - x["p"]) * x["size"])
        decided = F.when(first, rise.cast("int")).otherwise(F.when(rise, F.lit(0)).otherwise(F.lit(1)))
        left = F.when(first, F.when(rise, x["p"] - up / x["size"]).otherwise(x["p"] + down / x["size"])).otherwise(F.when(rise, c["p"] + up / c["size"]).otherwise(c["p"] - down / c["size"]))
        left = F.greatest(F.lit(0.0), F.least(F.lit(1.0), left))
        done = F.when(first, c).otherwise(x)
        stay = F.when(first, x).otherwise(c)
        return F.struct(
            F.struct(stay["doc_id"].alias("doc_id"), stay["tag"].alias("tag"), stay["size"].alias("size"), stay["whole"].alias("whole"), left.alias("p")).alias("residual"),
            F.concat(state["done"], F.array(F.struct(done["doc_id"].alias("doc_id"), done["tag"].alias("tag"), done["size"].alias("size"), (done["whole"] + decided).alias("copies")))).alias("done"),
        )

    return meet


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, tag (a hash of the text), size, source, source_size, target, copies, taken (= size * copies).

    A null text has size 0; a null source is a source of its own, ordered last. A document of size 0 gets the whole part of its source's copies, which take no words. Rows that repeat are units of their own. An empty table gives an empty result. The same rows give the same copies, whatever their order or partitions.
    """
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text_or_empty(text_col)).alias("tag"), F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size")
    )
    sized = materialize(sized, "sizes")
    targets = source_targets(sized, weights, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    near = F.when(F.abs(ratio - F.round(ratio)) < 1e-12, F.round(ratio)).otherwise(ratio)
    targets = materialize(targets.withColumn("ratio", near).withColumn("whole", F.floor("ratio").cast("int")).withColumn("p", F.col("ratio") - F.col("whole")).drop("ratio"), "targets")
    most = targets.agg(F.max("n")).first()[0] or 0

    joined = sized.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select("doc_id", "tag", "size", "d.source", "n", "whole", "p")
    fractional = (F.col("p") > 0) & (F.col("size") > 0)
    plain = joined.where(~fractional).select("doc_id", "tag", "source", "size", F.col("whole").alias("copies"))
    units = joined.where(fractional).select("source", F.struct("doc_id", "tag", F.col("size").cast("double").alias("size"), "whole", "p").alias("unit"), F.ceil(F.col("n") / block_rows).alias("blocks"))

    done, level, width = [plain], 0, max(1, most)
    while True:
        width = math.ceil(width / block_rows)
        block = F.pmod(F.xxhash64(F.lit(seed + level), "unit.doc_id", "unit.tag"), F.col("blocks"))
        rows = units.groupBy("source", "blocks", block.alias("block")).agg(F.sort_array(F.collect_list("unit")).alias("units"))
        start = F.struct(F.element_at("units", 1).alias("residual"), F.array().cast("array<struct<doc_id:bigint,tag:bigint,size:double,copies:int>>").alias("done"))
        folded = materialize(rows.select("source", "blocks", F.aggregate(F.slice("units", F.lit(2), F.size("units")), start, _fold(level, seed)).alias("state")), f"round{level}")
        done.append(folded.select("source", F.explode("state.done").alias("u")).select("u.doc_id", "u.tag", "source", F.col("u.size").cast("long").alias("size"), F.col("u.copies").alias("copies")))
        units = folded.select("source", F.col("state.residual").alias("unit"), F.ceil(F.col("blocks") / block_rows).alias("blocks"))
        if width <= 1:
            break
        level += 1
    last = _uniform(F.lit(seed), F.lit("last"), "unit.doc_id", "unit.tag") < F.col("unit.p")
    done.append(units.select("unit.doc_id", "unit.tag", "source", F.col("unit.size").cast("long").alias("size"), (F.col("unit.whole") + last.cast("int")).alias("copies")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select("o.doc_id", "o.tag", "o.size", "o.source", "t.source_size", "t.target", "o.copies", (F.col("o.size") * F.col("o.copies")).alias("taken"))


def take_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as the mix takes it.

    Rows that repeat id, source and text share the copies of all of them, as evenly as whole copies allow.
    """
    key = lambda i, tag, source: F.xxhash64(i, tag, F.coalesce(source, F.lit("")), source.isNull())
    mix = mix_sources(docs, weights, cap, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    mix = mix.groupBy(key(F.col("doc_id"), F.col("tag"), F.col("source")).alias("key")).agg(F.sum("copies").cast("int").alias("copies"), F.count("*").alias("n"))
    # By position, as the caller's columns may have any names.
    names = docs.columns
    at = lambda name: F.col(f"c{names.index(name)}")
    keyed = docs.toDF(*(f"c{i}" for i in range(len(names))))
    keyed = keyed.withColumn("key", key(at(id_col).cast("long"), F.xxhash64(text_or_empty(f"c{names.index(text_col)}")), at(source_col).cast("string")))
    joined = keyed.join(mix, "key")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(1)))
    own = F.floor(F.col("copies") / F.col("n")) + (rank <= F.col("copies") % F.col("n")).cast("int")
    taken = joined.withColumn("own", own.cast("int")).where("own > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("own"))))
    return taken.select(*(f"c{i}" for i in range(len(names)))).toDF(*names)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op10_mix_sources": op10_mix_sources}
ORACLES: dict = {}
