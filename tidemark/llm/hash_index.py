"""Exact duplicates through an extendible-hash index on shared files.

DataFrame functions only.  A text's key is the 64-bit hash of the text without
white space.

1. One scan writes an entry per row (id, key, lengths, digest; no text) to the
   shared folder; the entries are summed per key.
2. The directory starts as one bucket and doubles, one key bit at a time; every
   doubling splits the buckets that are still overfull.  It works on a histogram
   of at most ``2 ** MAX_BITS`` slots, however many documents there are.  A
   bucket is a contiguous key range.
3. A second scan deals the texts to the owner tasks of their buckets.  Doubling
   cannot split a key that overfills a bucket by itself (many copies of one
   text), so its rows are dealt to overflow pages, each with its own owner.
4. An owner groups its rows by key and *text*: the bytes are compared, and
   texts of equal key but different bytes become links of one chain.  The links
   are written to the shared folder; pages of one key are merged by their texts.
5. A key with one link is one group of equal texts; rows get its result through a
   join on the key.  Rows of a key with more links are grouped by their text.

Only keyed sums cross the network twice; every text crosses it once.

Cases: a null text counts as empty, all empty (or blank) texts are one group; null
ids come last when ids are compared (``keep_id`` is null only in a group without
ids); of rows equal in length and id one stays; repeated rows are rows of their
own; an empty table gives no rows; columns beside id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import keep, partitions

# Fixed value: the characters that do not count when texts are compared.
WHITE = " \t\n\x0b\x0c\r"

MAX_BITS = 20  # the directory has at most 2 ** MAX_BITS slots
BUCKETS_PER_TASK = 4  # buckets per shuffle partition aimed at
ENTRY_BYTES = 256  # fixed load of a row beside its text

Key = Callable[[Column], Column]


def normalised(text: Column) -> Column:
    """The text without white space; null is empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def split_overfull(loads: dict[int, int], bits: int, capacity: int) -> list[int]:
    """Bucket of each directory slot after doubling the directory while a bucket holds more than ``capacity``.

    ``loads``: load per key prefix of ``bits`` bits.  The directory has ``2 ** depth`` slots; buckets are numbered in
    key order.
    """
    upto = [0, *accumulate(loads.get(s, 0) for s in range(1 << bits))]

    def load(prefix: int, depth: int) -> int:
        wide = bits - depth
        return upto[(prefix + 1) << wide] - upto[prefix << wide]

    depth, buckets = 1, [(0, 1), (1, 1)]  # (prefix, local depth)
    while depth < bits and any(load(p, d) > capacity for p, d in buckets if d == depth):
        depth += 1  # the directory doubles; buckets with room keep their local depth
        buckets = [b for p, d in buckets
                   for b in ([(2 * p, d + 1), (2 * p + 1, d + 1)] if d == depth - 1 and load(p, d) > capacity else [(p, d)])]
    return [number for number, (_, d) in enumerate(buckets) for _ in range(1 << (depth - d))]


@dataclass
class HashIndex:
    """``rows``: an entry per document row; ``keys``: size, kept row and load per key; ``links``: the owners' chains;
    ``collided``: keys of more than one text; ``slots``: the directory."""

    rows: DataFrame
    keys: DataFrame
    links: DataFrame
    collided: DataFrame
    slots: list[int]


def _best(id_col: str) -> Column:
    """Least for the row that stays: most code points, then smallest id, then any one row."""
    return F.min(F.struct((-F.col("_chars")).alias("short"), F.col(id_col).isNull().alias("unnamed"),
                          F.col(id_col).alias("id"), F.col("_row").alias("row")))


def _directory(spark: SparkSession, slots: list[int]) -> DataFrame:
    """(_slot, _bucket), one row per directory slot (at most 2 ** MAX_BITS)."""
    return spark.range(1).select(
        F.posexplode(F.from_json(F.lit(str(slots)), "array<int>")).alias("_slot", "_bucket"))


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Key = F.xxhash64,
          capacity: int | None = None) -> HashIndex:
    """The index of ``docs``; ``capacity`` is a bucket's greatest load in bytes (None: from the input's size)."""
    spark, tasks = docs.sparkSession, partitions(docs.sparkSession)
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    texts = source.select(id_col, normalised(F.col("_text")).alias("_norm"),
                          F.char_length(F.coalesce("_text", F.lit(""))).alias("_chars"))
    rows = keep(texts.select(
        id_col, F.monotonically_increasing_id().alias("_row"), key(F.col("_norm")).alias("_key"), "_chars",
        F.octet_length("_norm").alias("_bytes"), F.unhex(F.sha2(F.col("_norm").cast("binary"), 256)).alias("_sha")), "rows")
    keys = keep(rows.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_size"), F.sum(F.col("_bytes").cast("long") + ENTRY_BYTES).alias("_load"),
        _best(id_col).alias("_best")), "keys")

    total = keys.agg(F.sum("_load")).first()[0] or 0
    capacity = capacity or max(1, total // (BUCKETS_PER_TASK * tasks))
    bits = min(MAX_BITS, max(1, (total // capacity).bit_length()) + 3)
    # A key beyond a bucket's capacity has pages of its own and counts as one full bucket.
    histogram = (keys.groupBy(F.shiftrightunsigned("_key", 64 - bits).alias("slot"))
                 .agg(F.sum(F.least("_load", F.lit(capacity))).alias("load")))
    slots = split_overfull({r.slot: r.load for r in histogram.collect()}, bits, capacity)
    depth = len(slots).bit_length() - 1
    # At most total / capacity keys are that large, so both tables below are bounded.
    hot = keys.where(F.col("_load") > capacity).select(
        "_key", F.ceil(F.col("_load") / capacity).cast("int").alias("_pages"))

    dealt = (texts.select("_norm", key(F.col("_norm")).alias("_key"), F.monotonically_increasing_id().alias("_row"))
             .withColumn("_slot", F.shiftrightunsigned("_key", 64 - depth).cast("int"))
             .join(F.broadcast(_directory(spark, slots)), "_slot")
             .join(F.broadcast(hot), "_key", "left")
             .withColumn("_pages", F.coalesce("_pages", F.lit(1)))
             .select("_bucket", F.pmod(F.xxhash64("_row"), F.col("_pages")).cast("int").alias("_page"), "_pages",
                     "_key", "_norm")
             .repartition(tasks, "_bucket", "_page"))
    links = keep(dealt.groupBy("_bucket", "_page", "_pages", "_key", "_norm").agg(F.count(F.lit(1)).alias("_rows"))
                 .select("_bucket", "_page", "_key", "_rows", F.when(F.col("_pages") > 1, F.col("_norm")).alias("_text")),
                 "links")
    alone = links.where(F.col("_text").isNull()).select("_key")
    merged = links.where(F.col("_text").isNotNull()).select("_key", "_text").distinct().select("_key")
    collided = keep(alone.unionByName(merged).groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
                    .where("n > 1").select("_key"), "collided")
    return HashIndex(rows, keys, links, collided, slots)


def _result(rows: DataFrame, groups: DataFrame, by: list[str], id_col: str) -> DataFrame:
    return rows.join(groups, by).select(
        id_col, F.col("_best.id").alias("keep_id"), F.col("_size").alias("group_size"),
        (F.col("_row") == F.col("_best.row")).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Key = F.xxhash64,
                     capacity: int | None = None) -> DataFrame:
    """``id_col``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every row of ``docs``."""
    index = build(docs, id_col, text_col, key, capacity)
    if index.collided.isEmpty():
        return _result(index.rows, index.keys, ["_key"], id_col)
    single = index.rows.join(index.collided, "_key", "left_anti")
    norm = normalised(F.col(text_col))
    chained = keep(
        docs.select(F.col(id_col), norm.alias("_norm"), key(norm).alias("_key"), F.monotonically_increasing_id().alias("_row"),
                    F.char_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_chars"))
        .join(index.collided, "_key", "left_semi")
        .withColumn("_sha", F.unhex(F.sha2(F.col("_norm").cast("binary"), 256))), "chained")
    by_text = chained.groupBy("_key", "_norm").agg(F.count(F.lit(1)).alias("_size"), _best(id_col).alias("_best"))
    return (_result(single, index.keys, ["_key"], id_col)
            .unionByName(_result(chained, by_text, ["_key", "_norm"], id_col)))
