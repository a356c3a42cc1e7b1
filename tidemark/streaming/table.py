"""Versioned tables on shared files, for state and results of ``foreachBatch`` writers.

A version is a *manifest*: the list of parts (parquet folders) that make up the
table after a micro-batch, and a small ``meta`` dictionary.  A part is never
rewritten.  A commit is the last step of a batch: one small file that appears
whole, so a reader sees the table before or after a batch and never between.

- **Replay.**  Batch ``n`` starts from the newest version of a batch *before* ``n``.
  If the driver died after the commit, the replayed batch commits ``n`` once more,
  with the same rows in new parts.
- **Bounded reads.**  Every ``compact_every`` batches the parts are merged into one
  snapshot, without the rows that are no longer needed.
- **Bounded files.**  Parts and manifests that none of the last ``keep`` versions uses
  are removed after a commit; a reader has so many batches to finish.

All files go through Spark's readers and writers and Hadoop's file system, so
any store that Spark can write to will do.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Version:
    """The table after ``batch``: its parts (folder names) and what the writer noted."""

    batch: int
    parts: tuple[str, ...] = ()
    meta: dict = field(default_factory=dict)


class VersionedTable:
    """A table at ``path`` that changes as a whole, batch by batch."""

    def __init__(self, path: str, keep: int = 4):
        if keep < 2:
            raise ValueError("keep at least two versions: a replayed batch starts from the one before")
        self.path, self.keep = path.rstrip("/"), keep

    def _fs(self, spark: SparkSession, path: str):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, spark: SparkSession, kind: str) -> list[str]:
        folder, fs = self._fs(spark, f"{self.path}/{kind}")
        return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def _manifests(self, spark: SparkSession) -> list[str]:
        """Names of committed manifests, oldest first (``batch-time``)."""
        out = []
        for name in self._names(spark, "versions"):
            done, fs = self._fs(spark, f"{self.path}/versions/{name}/_SUCCESS")
            if fs.exists(done):
                out.append(name)
        return out

    def _load(self, spark: SparkSession, name: str) -> Version:
        doc = json.loads(spark.read.text(f"{self.path}/versions/{name}").first()[0])
        return Version(doc["batch"], tuple(doc["parts"]), doc["meta"])

    def version(self, spark: SparkSession, before: int | None = None) -> Version | None:
        """The newest version (of a batch before ``before``); None: there is none."""
        names = [n for n in self._manifests(spark) if before is None or int(n.split("-")[0]) < before]
        return self._load(spark, names[-1]) if names else None

    def read(self, spark: SparkSession, version: Version | None = None, schema=None) -> DataFrame | None:
        """All rows of the version's parts (default: the newest); None: it has no part."""
        version = version or self.version(spark)
        if version is None or not version.parts:
            return None
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(*(f"{self.path}/parts/{p}" for p in version.parts))

    def write_part(self, df: DataFrame, batch_id: int) -> str:
        """Write ``df`` as a new part; it belongs to the table once a commit names it."""
        name = f"{batch_id:012d}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/parts/{name}")
        return name

    def commit(self, spark: SparkSession, version: Version) -> None:
        """Make ``version`` the newest one, then remove what only older versions than the last ``keep`` use."""
        doc = json.dumps({"batch": version.batch, "parts": list(version.parts), "meta": version.meta})
        name = f"{version.batch:012d}-{time.time_ns():020d}"
        spark.range(0, 1, 1, 1).select(F.lit(doc).alias("doc")).write.text(f"{self.path}/versions/{name}")
        self._prune(spark, version.batch)

    def _prune(self, spark: SparkSession, batch: int) -> None:
        names = self._manifests(spark)
        batches = sorted({int(n.split("-")[0]) for n in names})[-self.keep:]
        kept = [n for n in names if int(n.split("-")[0]) in batches]
        old = [n for n in self._names(spark, "versions") if n not in kept and int(n.split("-")[0]) < batches[0]]
        if old:
            used = {p for n in kept for p in self._load(spark, n).parts}
            spare = [f"parts/{p}" for p in self._names(spark, "parts") if p not in used and int(p.split("-")[0]) < batch]
            for name in [*(f"versions/{n}" for n in old), *spare]:
                folder, fs = self._fs(spark, f"{self.path}/{name}")
                fs.delete(folder, True)


def advance(table: VersionedTable, batch_id: int, before: Version | None, added: DataFrame | None, meta: dict,
            merge: Callable[[DataFrame], DataFrame], compact_every: int) -> Version:
    """Write ``added`` as a part and, every ``compact_every`` parts, all parts merged into one (the commit is the caller's)."""
    parts = list(before.parts) if before else []
    if added is not None:
        parts.append(table.write_part(added, batch_id))
    version = Version(batch_id, tuple(parts), meta)
    if len(parts) > compact_every:
        spark = added.sparkSession
        version = Version(batch_id, (table.write_part(merge(table.read(spark, version)), batch_id),), meta)
    return version


def newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of every key the row of the last batch (``batch_id``)."""
    rest = [c for c in rows.columns if c not in keys]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("_row"))
            .select(*keys, "_row.*").select(*rows.columns))


class UpsertTable:
    """K3: the newest row per key of an update-mode stream, as a versioned table.

    ``foreachBatch`` writer: every micro-batch carries the full new value of each key it changed.  With
    ``retention``, keys whose ``time_col`` lies that far behind the newest one leave the live table when it is
    compacted; their last rows are appended to ``<path>/closed``, once.  ``retention`` must be longer than the
    stream's watermark delay, so that no update comes after that.  A key may be of any type and of any precision
    (windows that end within one second stay apart); NULL is a key as any other.
    """

    def __init__(self, path: str, keys: Sequence[str], time_col: str | None = None, retention_us: int | None = None,
                 compact_every: int = 8, keep: int = 4):
        if retention_us is not None and time_col not in keys:
            raise ValueError("rows leave by a time that is part of their key")
        self.table = VersionedTable(path, keep)
        self.keys, self.time_col, self.retention_us = list(keys), time_col, retention_us
        self.compact_every = compact_every

    def _closed_path(self) -> str:
        return f"{self.table.path}/closed"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            if not batch.groupBy(*self.keys).count().where("count > 1").isEmpty():
                raise ValueError(f"several rows for one {tuple(self.keys)}: name the other grouping columns in keys")
            before = self.table.version(spark, before=batch_id)
            meta = dict(before.meta) if before else {}
            if self.time_col is not None:
                seen = batch.agg(F.max(F.unix_micros(F.col(self.time_col).cast("timestamp")))).first()[0]
                meta["max_us"] = max((x for x in (seen, meta.get("max_us")) if x is not None), default=None)
            version = advance(self.table, batch_id, before, batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")),
                              meta, lambda rows: self._compact(newest(rows, self.keys), meta, batch_id), self.compact_every)
            self.table.commit(spark, version)
        finally:
            batch.unpersist()

    def _compact(self, rows: DataFrame, meta: dict, batch_id: int) -> DataFrame:
        if self.retention_us is None or meta.get("max_us") is None:
            return rows
        gone = F.coalesce(F.unix_micros(F.col(self.time_col).cast("timestamp")) < meta["max_us"] - self.retention_us, F.lit(False))
        rows.where(gone).drop("batch_id").write.mode("overwrite").parquet(f"{self._closed_path()}/closed_in={batch_id}")
        return rows.where(~gone)

    def live(self, spark: SparkSession) -> DataFrame | None:
        """The newest row per key still in the table, with the ``batch_id`` that wrote it; None: nothing written yet."""
        rows = self.table.read(spark)
        return None if rows is None else newest(rows, self.keys)

    def closed(self, spark: SparkSession) -> DataFrame | None:
        """The last rows of the keys that have left; None: none has."""
        folder, fs = self.table._fs(spark, self._closed_path())
        return spark.read.parquet(self._closed_path()).drop("closed_in") if fs.exists(folder) else None
