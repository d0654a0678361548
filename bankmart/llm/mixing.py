"""Mixing sources to target weights, with DataFrame functions only.

Efraimidis-Spirakis sampling: each document draws an exponential key divided by
its quality weight; within a source the smallest keys come first. A source
whose target is e whole sizes and a rest takes every document e times (whole
epochs first), then documents by key while the running sum of sizes stays within the
rest, and last the one document whose size comes nearest to what is still missing.

The running sums need no group of a whole source: keys fall into cells of a
monotone grid, cells are summed first, and only the rows of one (source, cell)
are sorted together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import unused, WORD_PATTERN, stored

CELLS = 4096


def targets(sizes: DataFrame, shares: tuple[float, ...] = (3, 1, 2), total: float = 1.5,
            most: float = 2.0) -> DataFrame:
    """Target of every source in ``sizes`` (source, source_size).

    Sources by code point, null last, weigh ``shares``, repeating, and share
    ``total`` times the sum of sizes; a target stops at ``most`` times its
    source's size and the excess is shared again by weight. In order of
    size per weight the capped sources come first, so one pass of running
    sums finds the level at which the rest is met. The table has one row
    per source.
    """
    weight = F.element_at(F.array(*[F.lit(float(s)) for s in shares]),
                          ((F.col("no") - 1) % len(shares) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ratio = Window.orderBy("per_weight", "no")
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = F.col("level")
    return sizes.withColumn("no", F.row_number().over(by_name)).withColumn("weight", weight) \
        .withColumn("cap", F.col("source_size") * F.lit(float(most))) \
        .withColumn("per_weight", F.col("cap") / F.col("weight")) \
        .withColumn("level", (F.sum("source_size").over(every) * F.lit(float(total))
                              - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                    / F.sum("weight").over(rest)) \
        .withColumn("first", F.min(F.when(F.col("per_weight") > level,
                                          F.struct(F.col("per_weight"), F.col("no"), level)))
                    .over(every)) \
        .withColumn("target", F.when(F.col("per_weight") > F.col("first.level"),
                                     F.col("first.level") * F.col("weight"))
                    .otherwise(F.col("cap"))) \
        .select("source", "source_size", "target")


def mix_sources(documents: DataFrame, weights: DataFrame, shares: tuple[float, ...] = (3, 1, 2),
                total: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """How often each document enters the mix.

    ``documents`` (doc_id, text, source); ``weights`` (doc_id, weight > 0), a document
    without one weighs 1 (of several rows the largest counts). Returns one row per row of
    ``documents``: doc_id, source, digest (of the text), size (words; null text: 0),
    source_size, target, copies, taken (= copies * size). Documents without
    words take nothing and come as often as the epochs and their key say; a
    source without words has target 0 and no copies. Null source is a source of its own,
    ordered last. Equal rows are separate documents with one key; ties go by
    size and digest. A rerun gives the same rows. Other columns are ignored.
    """
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))),
                            1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    weights = weights.groupBy("doc_id").agg(F.max("weight").alias("weight"))
    rows = documents.select(
        "doc_id", "source", F.xxhash64("text").alias("digest"),
        F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"))
    rows = rows.join(weights, "doc_id", "left").select(
        "doc_id", "source", "digest", "size",
        (-F.log(u) / F.coalesce(F.col("weight"), F.lit(1.0))).alias("key"))
    rows = stored(rows.withColumn("cell", F.floor((1 - F.exp(-F.col("key"))) * CELLS))
                  .withColumn("named", F.col("source").isNotNull())
                  .withColumn("name", F.coalesce("source", F.lit(""))), "mix")

    cells = rows.groupBy("named", "name", "cell").agg(F.sum("size").alias("cell_size"),
                                                      F.first("source").alias("source"))
    goals = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")),
                    shares, total, most)
    goals = goals.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")) \
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")) \
        .withColumn("named", F.col("source").isNotNull()) \
        .withColumn("name", F.coalesce("source", F.lit(""))).drop("source")
    earlier = Window.partitionBy("named", "name").orderBy("cell") \
        .rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before_cell", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0))) \
        .drop("cell_size", "source").join(goals, ["named", "name"])
    inside = Window.partitionBy("named", "name", "cell").orderBy("key", "doc_id", "size", "digest")
    before = F.col("before_cell") + F.coalesce(F.sum("size").over(
        inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = stored(rows.join(cells, ["named", "name", "cell"]).withColumn("before", before)
                    .withColumn("nth", F.row_number().over(inside))
                    .withColumn("chosen", (F.col("rest") > 0) & (F.col("before") + F.col("size") <= F.col("rest")))
                    .drop("before", "before_cell"), "mix-placed")
    gaps = placed.groupBy("named", "name").agg((F.first("rest") - F.sum(
        F.when(F.col("chosen"), F.col("size")).otherwise(0))).alias("gap"))
    away = F.abs(F.col("size") - F.col("gap"))
    last = placed.where(~F.col("chosen") & (F.col("rest") > 0) & (F.col("size") > 0)) \
        .join(gaps, ["named", "name"]).where(away < F.col("gap")).groupBy("named", "name").agg(
        F.min(F.struct(away.alias("away"), "key", "cell", "nth")).alias("best")) \
        .select("named", "name", "best.cell", "best.nth", F.lit(True).alias("last"))
    chosen = F.col("chosen") | F.coalesce(F.col("last"), F.lit(False))
    return placed.join(last, ["named", "name", "cell", "nth"], "left") \
        .withColumn("copies", F.col("epochs") + chosen.cast("long")) \
        .select("doc_id", "source", "digest", "size", "source_size", "target", "copies",
                (F.col("copies") * F.col("size")).alias("taken"))


def quality_weights(labels: DataFrame) -> DataFrame:
    """Weights of labelled documents: 2 for good quality, 1/2 for bad, 1 where null."""
    return labels.select("doc_id", F.expr(
        "case when quality = 1 then 2.0D when quality = 0 then 0.5D else 1.0D end").alias("weight"))


def mixed_documents(documents: DataFrame, decisions: DataFrame) -> DataFrame:
    """The documents themselves, each as many times as it was taken (same columns).

    Rows of one doc_id, source and text count as one, with the sum of their copies.
    """
    keys = ["doc_id", "source", "digest"]
    digest, copies, copy = unused(documents, "digest", "copies", "copy")
    counts = decisions.groupBy(*keys).agg(F.sum("copies").alias(copies))
    one = documents.withColumn(digest, F.xxhash64("text")).dropDuplicates(["doc_id", "source", digest]).alias("d")
    same = (F.col("d.doc_id").eqNullSafe(F.col("c.doc_id"))
            & F.col("d.source").eqNullSafe(F.col("c.source"))
            & (F.col(f"d.`{digest}`") == F.col("c.digest")))
    return one.join(counts.alias("c"), same).where(F.col(copies) > 0) \
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))) \
        .select(*[F.col(f"d.`{c}`") for c in documents.columns])
