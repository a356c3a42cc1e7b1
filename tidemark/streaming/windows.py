"""Watermarked window aggregates (W1-W6, W9, A1-A9, T1-T2 streaming forms).

All of these are Spark's own streaming aggregation: partial aggregates in
every task, state per (window, key) in the state store, eviction when the
watermark passes the window end.  In ``append`` mode each window is emitted
once, complete, which is the end-of-window emission of the original.

Top-N per window runs in ``foreachBatch`` over the append-mode counts: a
closed window arrives whole in exactly one micro-batch, so the batch
``top_k`` over that micro-batch is the final ranking.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import string_hash
from ..plans.sliding import duration_us
from ..plans.topk import top_k


def _window(ts: str, size: str, slide: str | None = None) -> Column:
    size_t = f"{duration_us(size)} microseconds"
    if slide is None:
        return F.window(ts, size_t)
    return F.window(ts, size_t, f"{duration_us(slide)} microseconds")


def window_counts(events: DataFrame, ts: str, keys: Sequence[str], size: str, slide: str | None = None,
                  count_col: str = "cnt") -> DataFrame:
    """(keys, window_start, window_end, cnt) per window; ``events`` carries a watermark on ``ts``."""
    return (events.groupBy(_window(ts, size, slide).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias(count_col))
            .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), count_col))


def pane_window_counts(events: DataFrame, ts: str, keys: Sequence[str], size: str, slide: str,
                       count_col: str = "cnt") -> DataFrame:
    """``window_counts`` in two chained aggregates: rows are counted per pane of one slide, only panes meet windows.

    A row is one state row at most; a pane's count enters size / slide windows, which panes of one key share, so a
    key with rows in most panes keeps about one window per pane.  Append mode.  For sparse keys and long ratios
    ``board.WindowBoard`` keeps panes alone.
    """
    panes = events.groupBy(_window(ts, slide).alias("p"), *keys).agg(F.count(F.lit(1)).alias("_c"))
    return (panes.groupBy(_window("p", size, slide).alias("w"), *keys).agg(F.sum("_c").alias(count_col))
            .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), count_col))


def pv_counts(behavior: DataFrame, size: str = "1 hour", behavior_value: str = "pv") -> DataFrame:
    """(window_end, pv) per tumbling window."""
    views = behavior.where(F.col("behavior") == behavior_value)
    return (views.groupBy(_window("ts", size).alias("w")).agg(F.count(F.lit(1)).alias("pv"))
            .select(F.col("w.end").alias("window_end"), "pv"))


def uv_counts(behavior: DataFrame, size: str = "1 hour", bits: int | None = None) -> DataFrame:
    """(window_end, uv): distinct users (or distinct hash bits) per tumbling window.

    Streaming rejects ``count(DISTINCT)``; two chained aggregations do the
    same work with bounded state: (window, user) first, then a count per
    window, both emitted once the watermark passes the window end.
    """
    who = F.col("user_id") if bits is None else string_hash(F.col("user_id").cast("string"), bits)
    first = (behavior.groupBy(_window("ts", size).alias("w"), who.alias("who"))
             .agg(F.count(F.lit(1)).alias("_n")))
    return (first.groupBy(F.col("w")).agg(F.count(F.lit(1)).alias("uv"))
            .select(F.col("w.end").alias("window_end"), "uv"))


def uv_bitmap_updates(behavior: DataFrame, size: str = "1 hour", bits: int = 29) -> DataFrame:
    """A7 in ``update`` mode: (window_end, chunk, n) for every bitmap chunk a micro-batch touched.

    State per (window, 32K-bit chunk) is one 4 KiB bitmap, so a window with
    many users is spread over many small state rows instead of one buffered
    set.  Write with ``sinks.batch_log`` and read the running totals with
    ``uv_running_totals``.
    """
    h = string_hash(F.col("user_id").cast("string"), bits)
    return (behavior.groupBy(_window("ts", size).getField("end").alias("window_end"),
                             F.bitmap_bucket_number(h).alias("chunk"))
            .agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(h))).alias("n")))


def uv_running_totals(log: DataFrame) -> DataFrame:
    """(window_end, uv) from a ``batch_log`` of ``uv_bitmap_updates``: latest value per chunk, summed."""
    latest = (log.groupBy("window_end", "chunk")
              .agg(F.max_by("n", "batch_id").alias("n")))
    return latest.groupBy("window_end").agg(F.sum("n").alias("uv"))


def top_n_writer(key: str, n: int, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: rank the closed windows of the micro-batch and hand them to ``write``."""

    def rank(batch: DataFrame, batch_id: int) -> None:
        ranked = top_k(batch, ["window_end"], [F.col("cnt").desc(), F.col(key)], n)
        write(ranked.select("window_end", "rank", key, "cnt"), batch_id)

    return rank


def latest_top_n(log: DataFrame, key: str, n: int) -> DataFrame:
    """T2 with corrections: rank from a ``batch_log`` of update-mode ``window_counts``.

    Each micro-batch logged the current count of every (window, key) it
    changed, late rows included; the latest logged count per (window, key)
    replaces earlier ones (the refire of the original), then every window is
    ranked.  Readable at any time: open windows give early rankings.
    """
    latest = log.groupBy("window_end", key).agg(F.max_by("cnt", "batch_id").alias("cnt"))
    return top_k(latest, ["window_end"], [F.col("cnt").desc(), F.col(key)], n).select(
        "window_end", "rank", key, "cnt")
