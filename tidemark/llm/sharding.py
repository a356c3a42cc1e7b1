"""Contiguous shards of near-equal bytes from global prefix sums.

Documents are range-partitioned on (crc32 of the text, id): copies of a text
stand next to each other, and the id splits even a text that a third of all
rows share.  Each partition's byte total gives its starting offset; a local
running sum gives every document's global start, and the shard is the target
interval that holds this start.  A shard so differs from the target by less
than one document at either end.

Cases: a null text has the bytes and checksum of an empty one; rows equal in all of
(checksum, id, size) are interchangeable and get their own places; an empty
table gives no shards; null ids come first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import keep, partitions


def byte_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``size``, ``text_crc32``, ``shard`` and gapless ``slot`` within the shard, per row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(id_col, (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    order = ["text_crc32", id_col, "size"]
    # Written once: the range bounds come from a sample, so both uses below must see the same partitions.
    placed = keep(rows.repartitionByRange(max(partitions(spark), 1), *order)
                  .withColumn("_part", F.spark_partition_id()), "range_parts")
    # One row per partition: their number is the shuffle setting, not the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("_b0"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n0"),
        F.sum("b").over(Window.partitionBy()).alias("_total"))
    local = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed
              .withColumn("_b", F.coalesce(F.sum("size").over(local), F.lit(0)))
              .withColumn("_n", F.count(F.lit(1)).over(local))
              .join(F.broadcast(offsets), "_part")
              .withColumn("_start", F.col("_b0") + F.col("_b"))
              .withColumn("shard", F.expr(f"cast(least((_start * {int(shards)}) div _total, {int(shards) - 1}) as int)"))
              .withColumn("_place", F.col("_n0") + F.col("_n")))
    starts = keep(starts.select(id_col, "size", "text_crc32", "shard", "_place"), "starts")
    first = starts.groupBy("shard").agg(F.min("_place").alias("_first"))  # one row per shard
    return starts.join(F.broadcast(first), "shard").select(
        id_col, "size", "text_crc32", "shard", (F.col("_place") - F.col("_first")).alias("slot"))
