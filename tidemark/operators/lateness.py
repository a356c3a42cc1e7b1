"""Late rows of a sliding-window count.

The batch form replays the stream in arrival order: the watermark seen by a
row is the largest event time among rows that arrived before it, minus the
out-of-orderness bound.  A row is late - it would go to the late-data output
instead of any window - when even its last window has expired:

    floor(ts, slide) + size - 1 ms + allowed_lateness <= watermark

The running maximum is a bucketed scan over arrival time, so it is computed
in parallel across arrival-time buckets rather than in one global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import epoch_micros, floor_div, micros_to_ts
from ..plans.ordered import join_back, long_bucket, running, ts_bucket
from ..plans.sliding import duration_us


SECOND_US = 1_000_000
ROWS_PER_BUCKET = 1 << 16


def late_rows(log: DataFrame, arrival: str | None = "arrival_ts", ts: str = "event_time", size: str = "10 minutes",
              slide: str = "5 seconds", bound: str = "1 second", lateness: str = "60 seconds",
              method: str | None = "GET", bucket_us: int = SECOND_US) -> DataFrame:
    """Rows of ``log`` that miss all their windows -> input columns + ``watermark``.

    ``arrival=None``: the rows arrived in the order of ``event_id`` (a raw log in file order).  The running maximum
    is scanned over (arrival, id, time) alone; the log's other columns are joined back to the late rows.
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    b_us, late_us = duration_us(bound), duration_us(lateness)
    order = [arrival, "event_id"] if arrival else ["event_id"]
    bucket = ts_bucket(arrival, bucket_us) if arrival else long_bucket(F.col("event_id"), ROWS_PER_BUCKET)
    narrow = log.select(*order, epoch_micros(F.col(ts)).alias("_t"),
                        (F.col("method") if method is not None else F.lit(None)).alias("_method"))
    seen = running(narrow, [], order, bucket, {"_max": F.col("_t")}, kind="max", include_current=False)
    wm = F.col("_max") - F.lit(b_us)
    last_end = floor_div(F.col("_t"), slide_us) * slide_us + F.lit(size_us)
    late = last_end - F.lit(1000) + F.lit(late_us) <= wm
    if method is not None:
        seen = seen.where(F.col("_method") == method)
    marks = seen.where(late).select(*order, micros_to_ts(wm).alias("watermark"))
    return join_back(log, marks, order).select(*log.columns, "watermark")
