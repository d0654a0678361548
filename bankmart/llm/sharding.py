"""Proportional stratified interleaving of documents into shards, with DataFrame functions only.

Within each source the rows are shuffled by a seeded hash and ranked; a row's
fractional rank is (rank + 1/2) / rows of the source. Sorted by that, every
stretch of rows holds the sources in their overall proportions, and cutting the
order into equal stretches gives shards of one mixture. Ranks are running counts over cells of
the hash (and of the fractional rank), so no source is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, unused

CELLS = 4096


def shard_documents(documents: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """Put every row of ``documents`` (doc_id, text, source) into a shard.

    Returns per row: doc_id, size (UTF-8 bytes of the text + 1; null: 1), text_crc32 (null:
    that of no bytes, 0), law ('rows': row counts of shards differ by one at most), shard (from 0),
    slot (gapless from 0 in the shard), grown_shard (null: only a law by key keeps places).
    Null source is a source of its own. Equal texts are no unit: the interleaving spreads rows
    whatever they hold. Rows of one doc_id go by text checksum and size; equal rows are interchangeable.
    An empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("source").isNotNull().alias("named"), F.coalesce("source", F.lit("")).alias("name"),
        F.xxhash64(F.lit(seed), F.col("doc_id")).alias("order"))
        .withColumn("cell", F.shiftright("order", 52)), "shard-rows")

    source = Window.partitionBy("named", "name")
    earlier = source.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("named", "name", "cell").agg(F.count("*").alias("n")) \
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))) \
        .withColumn("source_rows", F.sum("n").over(source)).drop("n")
    inside = Window.partitionBy("named", "name", "cell").orderBy("order", "doc_id", "text_crc32", "size")
    ranked = rows.join(cells, ["named", "name", "cell"]) \
        .withColumn("rank", F.col("before") + F.row_number().over(inside) - 1) \
        .withColumn("fraction", (F.col("rank") + 0.5) / F.col("source_rows")) \
        .withColumn("cell", F.floor(F.col("fraction") * CELLS)) \
        .select("doc_id", "size", "text_crc32", "named", "name", "rank", "fraction", "cell")
    ranked = stored(ranked, "shard-ranks")

    every = Window.partitionBy()
    counts = ranked.groupBy("cell").agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("rows", F.sum("n").over(every)).drop("n")
    place = Window.partitionBy("cell").orderBy("fraction", "named", "name", "rank")
    return ranked.join(counts, "cell") \
        .withColumn("place", F.col("before") + F.row_number().over(place) - 1) \
        .withColumn("shard", F.expr(f"int((place * {shards}) div rows)")) \
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                F.expr(f"place - (shard * rows + {shards - 1}) div {shards}").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"))


def write_shards(documents: DataFrame, placed: DataFrame, path: str) -> None:
    """Write the documents as Parquet, one folder per shard, files and rows in the order of slots.

    The columns shard and slot are added; a document's own columns of these names stay, the added ones get
    a trailing underscore.

    Rows are matched by doc_id, size and checksum; of equal rows each gets its own slot.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size, checksum, nth, shard, slot = unused(documents, "size", "text_crc32", "nth", "shard", "slot")
    own = documents.withColumn(size, (F.octet_length(text) + 1).cast("long")) \
        .withColumn(checksum, F.crc32(text.cast("binary")))
    left = own.withColumn(nth, F.row_number().over(
        Window.partitionBy("doc_id", size, checksum).orderBy("text"))).alias("d")
    right = placed.withColumn("nth", F.row_number().over(
        Window.partitionBy("doc_id", "size", "text_crc32").orderBy("shard", "slot"))).alias("p")
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id"))
    for mine, theirs in ((size, "size"), (checksum, "text_crc32"), (nth, "nth")):
        same &= F.col(f"d.`{mine}`") == F.col(f"p.{theirs}")
    left.join(right, same).select(*[F.col(f"d.`{c}`") for c in documents.columns],
                                  F.col("p.shard").alias(shard), F.col("p.slot").alias(slot)) \
        .repartitionByRange(shard, slot).sortWithinPartitions(shard, slot) \
        .write.partitionBy(shard).parquet(path)
