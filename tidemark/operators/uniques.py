"""Unique visitors per tumbling window.

* ``uv_exact``: ``count(DISTINCT user_id)`` per window.  Spark plans it as a
  partial aggregate on (window, user) then a count per window - no window's
  user set is ever buffered in one place.
* ``uv_bitmap``: distinct positions of the user hash in a 2^bits bitmap per
  window, built with ``bitmap_construct_agg`` per (window, 32K-bit chunk) and
  summed with ``bitmap_count``.  Equals the single-hash filter of the
  original, collisions included.
* ``uv_sketches`` / ``uv_from_sketches``: a mergeable HyperLogLog sketch per pane,
  united over any windows made of whole panes, without another look at the rows.
* ``uv_running``: the bitmap count after every event (per-element trigger),
  ordered by (ts, event_id) inside each window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import string_hash
from ..functions.timecols import epoch_micros, micros_to_ts
from ..plans.ordered import ts_bucket, running
from ..plans.sliding import duration_us


def _hour_window(size: str) -> Column:
    return F.window("ts", f"{duration_us(size)} microseconds")


def _maybe_filter(df: DataFrame, behavior: str | None) -> DataFrame:
    return df if behavior is None else df.where(F.col("behavior") == behavior)


def uv_exact(behavior: DataFrame, size: str = "1 hour", behavior_value: str | None = None) -> DataFrame:
    """A5: (window_end, uv) with all behaviours counted unless ``behavior_value`` is set."""
    rows = _maybe_filter(behavior, behavior_value)
    return rows.groupBy(_hour_window(size).alias("w")).agg(F.count_distinct("user_id").alias("uv")).select(
        F.col("w.end").alias("window_end"), "uv"
    )


def uv_bitmap(behavior: DataFrame, size: str = "1 hour", bits: int = 29, behavior_value: str | None = None) -> DataFrame:
    """(window_end, uv) = number of set bits of the hashed-user bitmap."""
    rows = _maybe_filter(behavior, behavior_value)
    h = string_hash(F.col("user_id").cast("string"), bits)
    chunks = rows.select(
        _hour_window(size).getField("end").alias("window_end"),
        F.bitmap_bucket_number(h).alias("chunk"),
        F.bitmap_bit_position(h).alias("pos"),
    )
    # Distinct bits first, by hash aggregate: the bitmap buffers then see each bit once.
    per_chunk = chunks.distinct().groupBy("window_end", "chunk").agg(F.bitmap_count(F.bitmap_construct_agg("pos")).alias("n"))
    return per_chunk.groupBy("window_end").agg(F.sum("n").alias("uv"))


def uv_sketches(behavior: DataFrame, pane: str = "1 hour", lg_k: int = 12, behavior_value: str | None = None) -> DataFrame:
    """A6 option: (pane_end, sketch): a HyperLogLog sketch of each pane's users, of 2^``lg_k`` registers at most.

    Built by partial aggregates, so a pane with many users is a few KB in the shuffle.  NULL users do not count.
    """
    rows = _maybe_filter(behavior, behavior_value)
    return rows.groupBy(_hour_window(pane).alias("w")).agg(F.hll_sketch_agg("user_id", lg_k).alias("sketch")).select(
        F.col("w.end").alias("pane_end"), "sketch")


def uv_from_sketches(sketches: DataFrame, size: str, pane: str = "1 hour", slide: str | None = None) -> DataFrame:
    """(window_end, uv) of windows that consist of whole panes, from the panes' sketches alone.

    The estimate's relative standard error is about 1.04 / sqrt(2^lg_k): 1.6 % at ``lg_k`` 12.
    """
    size_us, pane_us = duration_us(size), duration_us(pane)
    slide_us = duration_us(slide) if slide is not None else size_us
    if size_us % pane_us or slide_us % pane_us:
        raise ValueError("size and slide must be whole panes")
    inside = F.col("pane_end").cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0.000001))
    w = F.window(inside, f"{size_us} microseconds", f"{slide_us} microseconds")
    return sketches.groupBy(w.alias("w")).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("uv")).select(
        F.col("w.end").alias("window_end"), "uv")


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(20,0)")


def _pack(ts: Column, event_id: Column) -> Column:
    """(time, id) as one number in the same order: a hash aggregate keeps its minimum in place."""
    t = (epoch_micros(ts) + F.lit(1 << 62)).cast("decimal(19,0)")
    return (t * _whole(1 << 64)).cast("decimal(38,0)") + (event_id.cast("decimal(20,0)") + _whole(1 << 63))


def _time(packed: Column) -> Column:
    return micros_to_ts(F.call_function("div", packed, _whole(1 << 64)) - F.lit(1 << 62))


def _id(packed: Column) -> Column:
    return (packed % _whole(1 << 64) - _whole(1 << 63)).cast("bigint")


def uv_running(behavior: DataFrame, size: str = "1 hour", bits: int = 29, behavior_value: str | None = None,
               bucket_us: int = 60_000_000) -> DataFrame:
    """(window_end, event_id, uv) - distinct hash bits seen so far in the window, per event.

    First sightings come from a hash aggregate (min (ts, event_id) per bit),
    not from a per-user sort, then a running sum over the window in
    (ts, event_id) order, split into ``bucket_us`` time buckets.
    """
    rows = _maybe_filter(behavior, behavior_value).select(
        _hour_window(size).getField("end").alias("window_end"),
        string_hash(F.col("user_id").cast("string"), bits).alias("bit"),
        "ts",
        "event_id",
    )
    firsts = rows.groupBy("window_end", "bit").agg(F.min(_pack(F.col("ts"), F.col("event_id"))).alias("f")).select(
        "window_end", _time(F.col("f")).cast(dict(rows.dtypes)["ts"]).alias("ts"), _id(F.col("f")).alias("event_id"),
        F.lit(0).alias("kind"), F.lit(1).alias("inc"),
    )
    marks = rows.select("window_end", "ts", "event_id", F.lit(1).alias("kind"), F.lit(0).alias("inc"))
    both = firsts.unionByName(marks)
    scanned = running(both, ["window_end"], ["ts", "event_id", "kind"], ts_bucket("ts", bucket_us),
                      {"uv": F.col("inc")})
    return scanned.where(F.col("kind") == 1).select("window_end", "event_id", F.col("uv").cast("bigint").alias("uv"))
