"""Late-row side output for a stream (W7 streaming form).

Spark drops rows behind the watermark without a trace; this writer keeps
them.  Spark's rule is applied per micro-batch: every row of batch ``n``
sees the watermark left by batches ``< n`` (max event time so far minus the
out-of-orderness bound).  A row is late when even its last sliding window
has expired: ``floor(ts, slide) + size - 1 ms + lateness <= watermark``.

The running max event time is a note in a versioned table (``streaming.table``): a
micro-batch reads the newest version before it and commits its own, and only the
last few versions are kept, however long the stream runs.  Each micro-batch is
computed once and kept while its late rows are written and its max is taken.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import epoch_micros, floor_div, micros_to_ts
from ..plans.sliding import duration_us
from .table import Version, VersionedTable


def late_rows_writer(out_path: str, log_path: str, ts: str = "event_time", size: str = "10 minutes",
                     slide: str = "5 seconds", bound: str = "1 second", lateness: str = "60 seconds",
                     method: str | None = "GET") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each micro-batch's late rows (+ ``watermark``) to ``out_path``."""
    size_us, slide_us = duration_us(size), duration_us(slide)
    bound_us, late_us = duration_us(bound), duration_us(lateness)
    seen = VersionedTable(log_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            put(batch, batch_id)
        finally:
            batch.unpersist()

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        t = epoch_micros(F.col(ts))
        before = seen.version(spark, before=batch_id)
        prev = before.meta["max_us"] if before else None
        if prev is not None:
            wm = prev - bound_us
            rows = batch if method is None else batch.where(F.col("method") == method)
            last_end = floor_div(t, slide_us) * slide_us + F.lit(size_us)
            late = rows.where(last_end - F.lit(1000) + F.lit(late_us) <= F.lit(wm))
            (late.withColumn("watermark", micros_to_ts(F.lit(wm)))
             .write.mode("overwrite").parquet(os.path.join(out_path, f"batch_id={batch_id}")))
        cur = batch.agg(F.max(t).alias("m")).first().m
        running = max(v for v in (prev, cur) if v is not None) if (prev is not None or cur is not None) else None
        if running is not None:
            seen.commit(spark, Version(batch_id, meta={"max_us": int(running)}))

    return write
