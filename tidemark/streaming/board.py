"""Sliding windows of a stream from panes: early results, late corrections, closing.

``window(ts, size, slide)`` on a stream copies every row into size / slide windows (720
for 1 h / 5 s) and keeps as many state rows for it.  :class:`WindowBoard` is a
``foreachBatch`` writer that keeps one row per (key, pane of one slide) in a
versioned table and makes windows only when they are due:

1. The watermark that a micro-batch sees is the greatest event time of earlier
   batches less ``bound``.  A row whose last window has closed is late and goes to
   ``late_path``; all others are counted in their panes.
2. The watermark moves on to this batch's greatest event time.  A window whose end
   it has reached fires (``on_time``).
3. A window that has fired and gets rows again fires again (``corrected``; ``on_time`` if it was
   empty before) as long as it is open, that is until the watermark is ``lateness`` past its end.  With
   ``early=True`` windows that are still filling are emitted too (``early``).
4. Every emission of a window has the next ``version``.  The last one goes to
   ``closed`` when the window closes, once; panes that only closed windows hold go
   when the pane table is compacted.

So what a micro-batch reads is bounded by size + lateness of event time, however
long the stream runs.  A ranking is the first ``top_n`` rows of a window (ties by
key).  A replayed batch starts from the version before it and writes the same
rows again.  Rows without event time belong to no window and are left out; NULL
keys are keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import epoch_micros, micros_to_ts
from ..plans.sliding import counts_from_panes, duration_us, pane_of
from ..plans.topk import top_k
from .table import Version, VersionedTable, advance

MS_US = 1_000  # a window [start, end) holds instants up to end - 1 ms
MAX_EXPAND = 240  # windows that fall due at once and are still summed pane by pane


def _ends(panes: DataFrame, size_us: int, slide_us: int, lo: int, hi: int) -> DataFrame:
    """Panes with ``_end``, once for each window end in (lo, hi] that holds them."""
    first = F.greatest(F.col("_pane") + F.lit(slide_us), F.lit(lo + slide_us))
    last = F.least(F.col("_pane") + F.lit(size_us), F.lit(hi))
    return panes.where(first <= last).withColumn("_end", F.explode(F.sequence(first, last, F.lit(slide_us))))


class WindowBoard:
    """``foreachBatch`` writer of sliding counts per ``keys``; ``path`` holds ``panes``, ``current`` and ``closed``."""

    def __init__(self, path: str, ts: str, keys: Sequence[str], size: str | int, slide: str | int, bound: str | int = 0,
                 lateness: str | int = 0, where: Column | None = None, top_n: int | None = None, early: bool = False,
                 late_path: str | None = None, log_path: str | None = None, compact_every: int = 8):
        self.size, self.slide, self.bound, self.lateness = (duration_us(x) for x in (size, slide, bound, lateness))
        if self.size % self.slide:
            raise ValueError("size must be a multiple of slide")
        self.path, self.ts, self.keys, self.where, self.top_n, self.early = path.rstrip("/"), ts, list(keys), where, top_n, early
        self.late_path, self.log_path, self.compact_every = late_path, log_path, compact_every
        self.panes, self.current = VersionedTable(f"{self.path}/panes"), VersionedTable(f"{self.path}/current")

    # ------------------------------------------------------------ one micro-batch
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            self._advance(batch, batch_id)
        finally:
            batch.unpersist()

    def _passed(self, instant_us: int, wait_us: int = 0) -> int:
        """Greatest window end that the watermark of an event time has left ``wait_us`` behind."""
        return (instant_us - self.bound - wait_us + MS_US) // self.slide * self.slide

    def _advance(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self.panes.version(spark, before=batch_id)
        meta = dict(before.meta) if before else {}
        t = epoch_micros(F.col(self.ts))
        rows = batch.where(F.col(self.ts).isNotNull() & (F.lit(True) if self.where is None else self.where))
        pane = pane_of(t, self.slide)
        if meta:
            # Late: even the last window that holds the row had closed before this batch.
            late = pane + F.lit(self.size) <= F.lit(meta["closed"])
            if self.late_path is not None:
                wm = micros_to_ts(F.lit(meta["max_us"] - self.bound))
                (rows.where(late).withColumn("watermark", wm)
                 .write.mode("overwrite").parquet(f"{self.late_path}/batch_id={batch_id}"))
            rows = rows.where(~late)
        added = rows.groupBy(*self.keys, pane.alias("_pane")).agg(F.count(F.lit(1)).alias("_c")).persist()
        try:
            seen = batch.agg(F.max(t).alias("t")).first().t
            least = added.agg(F.min("_pane")).first()[0]
            if seen is None and not meta:
                return  # nothing has come yet
            now = max(x for x in (seen, meta.get("max_us")) if x is not None)
            # Windows up to ``fired`` have been emitted, windows up to ``closed`` are final.
            floor = least if least is not None else now // self.slide * self.slide
            fired_before = meta.get("fired", min(floor, self._passed(now)))
            closed_before = meta.get("closed", min(fired_before, self._passed(now, self.lateness)))
            meta = {"max_us": now, "fired": max(fired_before, self._passed(now)),
                    "closed": max(closed_before, self._passed(now, self.lateness))}
            version = advance(self.panes, batch_id, before, added, meta,
                              lambda all_panes: self._needed(self._summed(all_panes), closed_before), self.compact_every)
            panes = self._needed(self._summed(self.panes.read(spark, version)), closed_before)
            self._emit(spark, batch_id, panes, added, fired_before, closed_before, meta)
            self.panes.commit(spark, version)
        finally:
            added.unpersist()

    def _summed(self, panes: DataFrame) -> DataFrame:
        return panes.groupBy(*self.keys, "_pane").agg(F.sum("_c").alias("_c"))

    def _needed(self, panes: DataFrame, closed: int) -> DataFrame:
        """Panes of a window that is still open."""
        return panes.where(F.col("_pane") + F.lit(self.size) > F.lit(closed))

    def _counts(self, panes: DataFrame, lo: int, hi: int) -> DataFrame:
        """(keys, _end, cnt) of the windows that end in (lo, hi]."""
        if min(hi - lo, self.size) // self.slide <= MAX_EXPAND:
            return _ends(panes, self.size, self.slide, lo, hi).groupBy(*self.keys, "_end").agg(F.sum("_c").alias("cnt"))
        counts = counts_from_panes(panes, self.keys, self.size, self.slide)
        return counts.withColumn("_end", F.col("_ws") + F.lit(self.size)).where(
            F.col("_end").between(lo + 1, hi)).drop("_ws")

    def _emit(self, spark: SparkSession, batch_id: int, panes: DataFrame, added: DataFrame, fired: int, closed: int,
              meta: dict) -> None:
        due = self._counts(panes, fired, meta["fired"]).withColumn("state", F.lit("on_time"))
        # Windows that this batch's rows changed: those that had fired, and (early) those still to come.
        touched = _ends(added, self.size, self.slide, closed, fired).select("_end").distinct()
        again = (_ends(panes, self.size, self.slide, closed, fired).join(touched, "_end", "left_semi")
                 .groupBy(*self.keys, "_end").agg(F.sum("_c").alias("cnt")).withColumn("state", F.lit("corrected")))
        out = due.unionByName(again)
        if self.early:
            ahead = meta["max_us"] // self.slide * self.slide + self.size
            filling = _ends(added, self.size, self.slide, meta["fired"], ahead).select("_end").distinct()
            out = out.unionByName(
                _ends(panes, self.size, self.slide, meta["fired"], ahead).join(filling, "_end", "left_semi")
                .groupBy(*self.keys, "_end").agg(F.sum("_c").alias("cnt")).withColumn("state", F.lit("early")))
        if self.top_n is not None:
            out = top_k(out, ["_end"], [F.col("cnt").desc(), *(F.col(k) for k in self.keys)], self.top_n)
        before = self.current.version(spark, before=batch_id)
        old = self.current.read(spark, before) if before else None
        if old is None:
            out = out.withColumn("_v", F.lit(0).cast("bigint"))
        else:
            out = out.join(old.groupBy("_end").agg(F.max("version").alias("_v")), "_end", "left")
        # A late row that is the first of its window corrects nothing.
        first = F.coalesce("_v", F.lit(0).cast("bigint")) == 0
        out = (out.withColumn("state", F.when(first & (F.col("state") == "corrected"), "on_time").otherwise(F.col("state")))
               .withColumn("version", F.coalesce("_v", F.lit(0).cast("bigint")) + 1).drop("_v")).persist()
        try:
            shown = out if old is None else out.unionByName(old.join(out.select("_end").distinct(), "_end", "left_anti"))
            if self.log_path is not None:
                self._shown(out).write.mode("overwrite").parquet(f"{self.log_path}/batch_id={batch_id}")
            final = F.col("_end") <= F.lit(meta["closed"])
            self._shown(shown.where(final)).drop("state").write.mode("overwrite").parquet(f"{self.path}/closed/batch_id={batch_id}")
            part = self.current.write_part(shown.where(~final), batch_id)
            self.current.commit(spark, Version(batch_id, (part,), meta))
        finally:
            out.unpersist()

    def _shown(self, rows: DataFrame) -> DataFrame:
        rank = ["rank"] if self.top_n is not None else []
        return rows.select(*self.keys, micros_to_ts(F.col("_end") - F.lit(self.size)).alias("window_start"),
                           micros_to_ts(F.col("_end")).alias("window_end"), *rank, "cnt", "version", "state")

    # ------------------------------------------------------------ results
    def open_windows(self, spark: SparkSession) -> DataFrame | None:
        """The newest emission of every window that has been emitted and is not closed yet."""
        rows = self.current.read(spark)
        return None if rows is None else self._shown(rows)

    def closed_windows(self, spark: SparkSession) -> DataFrame:
        """The last emission of every closed window (``version``: how often it had been emitted)."""
        return spark.read.parquet(f"{self.path}/closed").drop("batch_id")
