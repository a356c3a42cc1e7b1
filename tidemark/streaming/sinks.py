"""Streaming sinks (K1-K3).

Checkpoints always live under the shared folder the cluster names in
``spark.checkpoint.dir`` (``session.checkpoint_dir``), one sub-folder per
query name, so a restarted driver or a lost executor resumes from the last
committed micro-batch.  ``foreachBatch`` writers are idempotent: every
micro-batch overwrites only what it owns (its ``batch_id`` partition, or the
windows it updated), so a replayed batch rewrites the same files.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_dir
from ..sources.files import dead_letters, good_rows
from .table import Version, VersionedTable


def _checkpoint(df: DataFrame, name: str) -> str:
    return os.path.join(checkpoint_dir(df.sparkSession), "streams", name)


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def to_files(df: DataFrame, path: str, name: str, output_mode: str = "append", trigger: str | None = None,
             fmt: str = "parquet") -> StreamingQuery:
    """K1: append the stream's rows to a file table at ``path``."""
    w = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", _checkpoint(df, name))
    return _trigger(w.outputMode(output_mode).queryName(name), trigger).start()


def split_by(kind_col: str, paths: dict[str, str], drop_kind: bool = True,
             other: str | None = None) -> Callable[[DataFrame, int], None]:
    """K2: a ``foreachBatch`` writer sending rows of each ``kind`` to its own table.

    Rows of a kind without a path (NULL included) go to ``other``, with their kind; without ``other`` they are an
    error.  The micro-batch is computed once and kept while its parts are written.

    Each kind is written under ``batch_id=<n>`` with partition overwrite, so a
    replayed micro-batch replaces its own output instead of duplicating it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            rest = batch.where(~F.coalesce(F.col(kind_col).isin(*paths), F.lit(False)))
            if other is not None:
                rest.write.mode("overwrite").parquet(os.path.join(other, f"batch_id={batch_id}"))
            elif not rest.isEmpty():
                raise ValueError(f"rows of a {kind_col} without a path: {rest.select(kind_col).first()[0]!r}")
            for kind, path in paths.items():
                part = batch.where(F.col(kind_col) == kind)
                if drop_kind:
                    part = part.drop(kind_col)
                part.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))
        finally:
            batch.unpersist()

    return write


def dead_letter_writer(good_path: str, dead_path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of a checked read (``sources.files``): good rows and malformed lines, each to its table.

    The micro-batch is parsed once; both parts are overwritten by ``batch_id`` on replay.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for part, path in ((good_rows(batch), good_path), (dead_letters(batch), dead_path)):
                part.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))
        finally:
            batch.unpersist()

    return write


def at_arrival(writer: Callable[[DataFrame, int], None], log_path: str, col: str = "arrival",
               clock: Callable[[], float] = time.time) -> Callable[[DataFrame, int], None]:
    """Processing time (A8): ``writer`` gets every micro-batch with ``col``, the time at which the batch came.

    The time is noted in a versioned table before the batch is written, so a replayed batch gets the time of its first
    run.  ``clock`` gives seconds; a clock that goes back stands still.
    """
    times = VersionedTable(log_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, noted = times.version(spark, before=batch_id), times.version(spark, before=batch_id + 1)
        if noted is None or noted.batch != batch_id:
            now = int(clock() * 1_000_000)
            noted = Version(batch_id, meta={"us": max(now, before.meta["us"]) if before else now})
            times.commit(spark, noted)
        writer(batch.withColumn(col, F.timestamp_micros(F.lit(noted.meta["us"]))), batch_id)

    return write


def batch_log(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer appending each micro-batch under ``batch_id=<n>`` (overwritten on replay)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))

    return write


def upsert_windows(path: str, window_col: str = "window_end",
                   keys: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """K3: ``foreachBatch`` writer for update-mode results with one row per window (and ``keys``).

    Each micro-batch carries the full new value of every (window, keys) it
    touched; dynamic partition overwrite replaces exactly those.  Every further
    grouping column must be named in ``keys`` (of few values: each is a
    partition level); two rows of one partition are an error.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.groupBy(window_col, *keys).count().where("count > 1").isEmpty():
                raise ValueError(f"several rows for one {(window_col, *keys)}: name the other grouping columns in keys")
            (batch.withColumn("_w", F.date_format(window_col, "yyyyMMddHHmmssSSSSSS"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_w", *keys).parquet(path))
        finally:
            batch.unpersist()

    return write


def foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], name: str, output_mode: str = "append",
                  trigger: str | None = None) -> StreamingQuery:
    w = (df.writeStream.foreachBatch(fn).outputMode(output_mode).queryName(name)
         .option("checkpointLocation", _checkpoint(df, name)))
    return _trigger(w, trigger).start()


def run_to_end(queries: Sequence[StreamingQuery], timeout_s: float = 600) -> None:
    """Wait for ``availableNow`` queries; re-raise the first failure, raise if one is not done in time."""
    for q in queries:
        if not q.awaitTermination(timeout_s):
            raise TimeoutError(f"stream {q.name} still runs after {timeout_s} s")
        if q.exception() is not None:
            raise q.exception()
