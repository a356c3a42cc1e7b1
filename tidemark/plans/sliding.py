"""Sliding / tumbling window counts.

Rows are first counted per (key, pane of one slide); only pane counts are spread
over windows.  Two plans, same rows ``(keys..., window_start, window_end, cnt)``
and same types:

* ``expand``: every pane count is copied into its size/slide windows and summed;
  for tumbling windows and small ratios.
* ``step``: every pane count becomes two deltas on the window-start axis (+c where
  its first window starts, -c after its last), prefix-summed per key; each run of
  equal value is expanded into its window starts.  Work follows the output, not
  panes x ratio (720 for 1 h / 5 s).  The prefix sum runs per (key, day) with
  offsets from a day-level scan (``plans.ordered``), and runs are cut at day
  edges, so neither a hot key nor a long steady run is one task or one array.

NULL keys are kept as a group.  Windows are epoch-aligned half-open
``[start, end)`` as in Spark's ``window()`` and have the type of the time column.
A size that is no multiple of the slide falls back to ``window()``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_micros, floor_div, micros_to_ts
from .ordered import DAY_US, join_back, long_bucket

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000,
}


def duration_us(text: str | int) -> int:
    """'5 seconds' / '1 hour' / '10 minutes' -> microseconds (ints pass through)."""
    if isinstance(text, int):
        return text
    n, unit = text.strip().split()
    unit = unit.lower().rstrip("s")
    return int(float(n) * _UNITS_US[unit])


def _us_text(us: int) -> str:
    return f"{us} microseconds"


def window_counts(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    size: str | int,
    slide: str | int | None = None,
    strategy: str = "auto",
    count_col: str = "cnt",
    max_expand: int = 16,
) -> DataFrame:
    """Row count per (keys, window) for every window holding at least one row."""
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    keys = list(keys)
    if size_us % slide_us:
        if strategy == "step":
            raise ValueError("step method needs size to be a multiple of slide")
        return _by_window(df, ts, keys, size_us, slide_us, count_col)
    instant = dict(df.dtypes)[ts] == "timestamp"
    micros = F.unix_micros(F.col(ts)) if instant else epoch_micros(F.col(ts))
    panes = df.groupBy(*keys, pane_of(micros, slide_us).alias("_pane")).agg(
        F.count(F.lit(1)).alias("_c")).where(F.col("_pane").isNotNull())
    counted = counts_from_panes(panes, keys, size_us, slide_us, strategy, count_col, max_expand)
    to_ts = F.timestamp_micros if instant else micros_to_ts
    return counted.select(*keys, to_ts(F.col("_ws")).alias("window_start"),
                          to_ts(F.col("_ws") + F.lit(size_us)).alias("window_end"), count_col)


def pane_of(micros: Column, slide_us: int) -> Column:
    """Start of the pane of one slide that holds an instant, in microseconds."""
    return floor_div(micros, slide_us) * F.lit(slide_us)


def counts_from_panes(panes: DataFrame, keys: Sequence[str], size_us: int, slide_us: int, strategy: str = "auto",
                      count_col: str = "cnt", max_expand: int = 16) -> DataFrame:
    """(keys, ``_ws``, count) of every window from pane counts (keys, ``_pane``, ``_c``), one row per key and pane."""
    if strategy == "step" or (strategy == "auto" and size_us // slide_us > max_expand):
        return _step(panes, list(keys), size_us, slide_us, count_col)
    return _expand(panes, list(keys), size_us, slide_us, count_col)


def _by_window(df: DataFrame, ts: str, keys: list[str], size_us: int, slide_us: int, count_col: str) -> DataFrame:
    w = F.window(F.col(ts), _us_text(size_us), _us_text(slide_us))
    return (
        df.groupBy(w.alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias(count_col))
        .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), count_col)
    )


def _expand(panes: DataFrame, keys: list[str], size_us: int, slide_us: int, count_col: str) -> DataFrame:
    starts = F.sequence(F.col("_pane") - F.lit(size_us - slide_us), F.col("_pane"), F.lit(slide_us))
    return panes.select(*keys, F.explode(starts).alias("_ws"), "_c").groupBy(*keys, "_ws").agg(
        F.sum("_c").alias(count_col))


def _step(panes: DataFrame, keys: list[str], size_us: int, slide_us: int, count_col: str) -> DataFrame:
    # +c at the first window start covering the pane, -c one slide after the last.
    deltas = panes.select(
        *keys,
        F.inline(
            F.array(
                F.struct((F.col("_pane") - F.lit(size_us - slide_us)).alias("s"), F.col("_c").alias("d")),
                F.struct((F.col("_pane") + F.lit(slide_us)).alias("s"), (-F.col("_c")).alias("d")),
            )
        ),
    )
    steps = deltas.groupBy(*keys, "s").agg(F.sum("d").alias("d")).where(F.col("d") != 0)
    runs = _runs(steps, keys).where(F.col("v") > 0)
    # Cut a run at day edges: each piece is at most a day's worth of window starts.
    day = F.explode(F.sequence(long_bucket(F.col("s"), DAY_US), long_bucket(F.col("e") - F.lit(1), DAY_US)))
    cut = runs.withColumn("_day", day)
    from_edge = F.greatest(F.col("s"), F.col("s") + F.lit(slide_us) * floor_div(
        F.col("_day") * F.lit(DAY_US) - F.col("s") + F.lit(slide_us - 1), slide_us))
    last = F.least(F.col("e") - F.lit(slide_us), (F.col("_day") + F.lit(1)) * F.lit(DAY_US) - F.lit(1))
    pieces = cut.withColumn("_from", from_edge).where(F.col("_from") <= last)
    return pieces.select(*keys, F.explode(F.sequence(F.col("_from"), last, F.lit(slide_us))).alias("_ws"),
                         F.col("v").alias(count_col))


def _runs(steps: DataFrame, keys: list[str], bucket_us: int = DAY_US) -> DataFrame:
    """(keys, s, d) change points -> (keys, s, e, v): value v holds on [s, e)."""
    b = steps.withColumn("_bk", long_bucket(F.col("s"), bucket_us))
    per_bucket = b.groupBy(*keys, "_bk").agg(F.sum("d").alias("t"), F.min("s").alias("first_s"))
    wb = Window.partitionBy(*keys).orderBy("_bk")
    offs = per_bucket.select(
        *keys,
        "_bk",
        F.coalesce(F.sum("t").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"),
        F.lead("first_s").over(wb).alias("next_first"),
    )
    wi = Window.partitionBy(*keys, "_bk").orderBy("s")
    return join_back(b, offs, [*keys, "_bk"]).select(
        *keys,
        "s",
        F.coalesce(F.lead("s").over(wi), F.col("next_first")).alias("e"),
        (F.col("off") + F.sum("d").over(wi.rowsBetween(Window.unboundedPreceding, 0))).alias("v"),
    )
