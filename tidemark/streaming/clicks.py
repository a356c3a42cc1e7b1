"""Click-fraud blacklist of a stream without a worker per hot (user, ad).

:class:`ClickBoard` is a ``foreachBatch`` writer with two levels of state in versioned
tables: the clicks that the watermark has not passed yet, and one count per (user, ad[,
business day]), which stops at ``max_click``.  A micro-batch takes the clicks that the
watermark has passed now and numbers them behind the count so far.  Only the first
``max_click`` clicks of a key matter, so each task forwards at most that many of a key
(the partial group limit of ``plans.topk``), and the new count is a partial sum: a
key with a third of all clicks is no task's whole work.

Output rows (``out_path/batch_id=n``): the click's columns and key, ``click_no`` and ``kind``
(``allowed`` below ``max_click``, ``warning`` at it); later clicks are left out.  They equal the
batch operator's on rows that come at most ``delay`` out of order; a row behind the
watermark of earlier batches is dropped, as by Spark's own operators.  Counts of a
business day go when the watermark has passed its end.  A replayed batch starts from
the version before it.  NULL users and ads are keys; clicks without time are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import business_day, epoch_micros
from ..plans.ordered import DAY_US
from ..plans.sliding import duration_us
from ..plans.topk import top_k
from .table import Version, VersionedTable, advance, newest


class ClickBoard:
    """``foreachBatch`` writer numbering the clicks of each (user, ad[, day]) up to ``max_click``."""

    def __init__(self, path: str, out_path: str, max_click: int = 100, daily_reset: bool = True, utc_offset_hours: int = 8,
                 delay: str | int = 0, compact_every: int = 8):
        self.path, self.out_path, self.max_click = path.rstrip("/"), out_path, max_click
        self.daily, self.offset_hours, self.delay = daily_reset, utc_offset_hours, duration_us(delay)
        self.keys = ["user_id", "ad_id"] + (["day"] if daily_reset else [])
        self.compact_every = compact_every
        self.counts, self.waiting = VersionedTable(f"{self.path}/counts"), VersionedTable(f"{self.path}/waiting")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            self._advance(batch, batch_id)
        finally:
            batch.unpersist()

    def _same_key(self, prior: DataFrame) -> Column:
        cond = F.lit(True)
        for k in self.keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"_p_{k}"))
        return cond

    def _advance(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clicks = batch.where(F.col("ts").isNotNull()).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        if self.daily:
            clicks = clicks.withColumn("day", business_day(F.col("ts"), self.offset_hours))
        before = self.counts.version(spark, before=batch_id)
        held = self.waiting.version(spark, before=batch_id)
        t = epoch_micros(F.col("ts"))
        seen = clicks.agg(F.max(t)).first()[0]
        now = max((x for x in (seen, before.meta["max_us"] if before else None) if x is not None), default=None)
        if now is None:
            return  # nothing has come yet
        wm = now - self.delay
        if before:
            clicks = clicks.where(t >= F.lit(before.meta["max_us"] - self.delay))
        rest = self.waiting.read(spark, held) if held else None
        rows = clicks if rest is None else clicks.unionByName(rest)
        ready = rows.where(t < F.lit(wm))
        prior = self.counts.read(spark, before) if before else None
        first = top_k(ready, self.keys, [F.col("ts"), F.col("event_id")], self.max_click, "_n")
        added = ready.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("clicks"))
        if prior is None:
            numbered = first.withColumn("click_no", F.col("_n"))
        else:
            known = newest(prior, self.keys).select(*[F.col(k).alias(f"_p_{k}") for k in self.keys], F.col("clicks").alias("_p"))
            drop = [f"_p_{k}" for k in self.keys] + ["_p"]
            so_far = F.coalesce("_p", F.lit(0))
            numbered = first.join(known, self._same_key(known), "left").withColumn("click_no", F.col("_n") + so_far).drop(*drop)
            added = added.join(known, self._same_key(known), "left").withColumn("clicks", F.col("clicks") + so_far).drop(*drop)
        kind = F.when(F.col("click_no") < self.max_click, "allowed").otherwise("warning")
        (numbered.where(F.col("click_no") <= self.max_click).withColumn("kind", kind).drop("_n")
         .write.mode("overwrite").parquet(f"{self.out_path}/batch_id={batch_id}"))
        capped = added.select(*self.keys, F.least("clicks", F.lit(self.max_click)).cast("bigint").alias("clicks"),
                              F.lit(batch_id).cast("bigint").alias("batch_id"))
        waits = self.waiting.write_part(rows.where(t >= F.lit(wm)), batch_id)
        version = advance(self.counts, batch_id, before, capped, {"max_us": now},
                          lambda all_counts: self._live(newest(all_counts, self.keys), wm), self.compact_every)
        self.waiting.commit(spark, Version(batch_id, (waits,)))
        self.counts.commit(spark, version)

    def _live(self, counts: DataFrame, wm: int) -> DataFrame:
        """Counts of business days that the watermark has not left."""
        if not self.daily:
            return counts
        end = (F.unix_date("day") + 1).cast("bigint") * DAY_US - self.offset_hours * 3_600_000_000
        return counts.where(end > wm)
