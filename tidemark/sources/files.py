"""Readers for the raw shop logs (S1-S7) and their dead letters.

All readers are declarative scans: an explicit schema (no inference pass),
``PERMISSIVE`` parsing (a malformed line is kept in ``_corrupt_record``), and
time conversion as JVM expressions, so column pruning and filter pushdown reach
the file scan.  The ``checked_*`` forms of the text readers keep a malformed line the
same way, with the ``reason``; ``good_rows`` and ``dead_letters`` take a checked read
apart, in a batch or a stream (``streaming.sinks.dead_letter_writer`` writes both
parts in one pass).

Every reader adds ``event_id``, the last sort key and row key of the operators.
A batch scan numbers its rows in file order (unique; stable for the same files
and split settings).  A stream cannot number rows, so there it is a hash of the
file and the line: equal lines of one file share it.  The streaming variants read
an arriving directory (Kafka is the production drop-in: same parser over
``value``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .schemas import CORRUPT
from ..functions.timecols import from_epoch_millis, from_epoch_seconds


def _csv(spark: SparkSession, path: str, ddl: str, stream: bool = False) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    rows = (reader.schema(f"{ddl}, {CORRUPT} STRING").option("header", "false").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return _with_event_id(rows, stream)


def _with_event_id(rows: DataFrame, stream: bool) -> DataFrame:
    number = F.xxhash64("_metadata.file_path", *rows.columns) if stream else F.monotonically_increasing_id()
    return rows.withColumn("event_id", number)


def _with_ts(df: DataFrame, col: str = "ts_sec") -> DataFrame:
    return df.withColumn("ts", from_epoch_seconds(F.col(col)))


def read_user_behavior(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """User behaviour CSV -> typed rows with event time ``ts``."""
    return _with_ts(_csv(spark, path, schemas.USER_BEHAVIOR, stream))


def read_ad_clicks(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Ad click CSV."""
    return _with_ts(_csv(spark, path, schemas.AD_CLICK, stream))


def read_logins(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """S3: login CSV."""
    return _with_ts(_csv(spark, path, schemas.LOGIN, stream))


def read_order_events(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Order event CSV.  An empty ``tx_id`` field reads as NULL."""
    return _with_ts(_csv(spark, path, schemas.ORDER_EVENT, stream))


def read_receipts(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Receipt CSV."""
    return _with_ts(_csv(spark, path, schemas.RECEIPT, stream))


def read_market_behavior(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Market feed rows (epoch milliseconds)."""
    df = _csv(spark, path, schemas.MARKET_BEHAVIOR, stream)
    return df.withColumn("ts", from_epoch_millis(F.col("ts_ms")))


def parse_access_log(lines: DataFrame, value: str = "value", extra: tuple[str, ...] = ()) -> DataFrame:
    """Space-separated access log lines -> (ip, user_id, event_time, method, url) and ``extra`` columns.

    Tokens 0=ip, 1=user id, 3=time ``dd/MM/yyyy:HH:mm:ss``, 5=method, 6=url.
    Malformed lines give NULLs (``try_to_timestamp``) instead of failing the job.
    """
    tok = F.split(F.col(value), " ")
    return lines.select(
        F.get(tok, 0).alias("ip"),
        F.get(tok, 1).alias("user_id"),
        F.try_to_timestamp(F.get(tok, 3), F.lit(schemas.ACCESS_LOG_TIME_FORMAT)).cast("timestamp_ntz").alias("event_time"),
        F.get(tok, 5).alias("method"),
        F.get(tok, 6).alias("url"),
        *extra,
    )


def read_access_log(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Text access log."""
    reader = spark.readStream if stream else spark.read
    return parse_access_log(_with_event_id(reader.text(path), stream), extra=("event_id",))


def parse_order_line(value: Column) -> list[Column]:
    """One ``order_id,event_type,tx_id,ts_sec`` line (socket/Kafka payload)."""
    tok = F.split(value, ",")
    ts_sec = F.get(tok, 3).try_cast("bigint")
    return [
        F.get(tok, 0).try_cast("bigint").alias("order_id"),
        F.get(tok, 1).alias("event_type"),
        F.nullif(F.get(tok, 2), F.lit("")).alias("tx_id"),
        ts_sec.alias("ts_sec"),
        from_epoch_seconds(ts_sec).alias("ts"),
    ]


def read_order_lines(spark: SparkSession, path: str, stream: bool = True) -> DataFrame:
    """Order events arriving as text lines in a directory."""
    reader = spark.readStream if stream else spark.read
    return _with_event_id(reader.text(path), stream).select(*parse_order_line(F.col("value")), "event_id")


REASON = "reason"


def _first_fault(*faults: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(fault, F.lit(text)) for fault, text in faults])


def _with_fault(rows: DataFrame, value: str, reason: Column) -> DataFrame:
    return rows.withColumn(REASON, reason).withColumn(CORRUPT, F.when(F.col(REASON).isNotNull(), F.col(value)))


def _empty(value: str) -> Column:
    return F.col(value).isNull() | (F.trim(F.col(value)) == "")


def checked_access_log(lines: DataFrame, value: str = "value", extra: tuple[str, ...] = ()) -> DataFrame:
    """``parse_access_log`` with ``_corrupt_record`` (the raw line) and ``reason`` of malformed lines, NULL for good ones."""
    rows = parse_access_log(lines, value, extra=(*extra, value))
    fields = F.size(F.split(F.col(value), " "))
    return _with_fault(rows, value, _first_fault(
        (_empty(value), "empty line"), (fields < 7, "fewer than 7 fields"),
        (F.col("event_time").isNull(), "no time of the form dd/MM/yyyy:HH:mm:ss"))).drop(value)


def checked_order_lines(lines: DataFrame, value: str = "value", extra: tuple[str, ...] = ()) -> DataFrame:
    """``parse_order_line`` of every line, with ``_corrupt_record`` and ``reason`` as in ``checked_access_log``."""
    rows = lines.select(*parse_order_line(F.col(value)), *extra, value)
    fields = F.size(F.split(F.col(value), ","))
    return _with_fault(rows, value, _first_fault(
        (_empty(value), "empty line"), (fields < 4, "fewer than 4 fields"),
        (F.col("order_id").isNull(), "the order id is no number"), (F.col("ts_sec").isNull(), "the time is no number"))).drop(value)


def read_checked_access_log(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """S6 with dead letters."""
    reader = spark.readStream if stream else spark.read
    return checked_access_log(_with_event_id(reader.text(path), stream), extra=("event_id",))


def read_checked_order_lines(spark: SparkSession, path: str, stream: bool = True) -> DataFrame:
    """S7 with dead letters."""
    reader = spark.readStream if stream else spark.read
    return checked_order_lines(_with_event_id(reader.text(path), stream), extra=("event_id",))


def _faulty(rows: DataFrame) -> Column:
    return F.col(REASON if REASON in rows.columns else CORRUPT).isNotNull()


def good_rows(checked: DataFrame) -> DataFrame:
    """The well-formed rows of a checked read (or of a CSV read), without the fault columns.

    Spark's CSV reader looks at the columns a query uses: a fault in another column does not remove a row.
    """
    return checked.where(~_faulty(checked)).drop(REASON, CORRUPT)


def dead_letters(checked: DataFrame) -> DataFrame:
    """(line, reason, parsed, event_id) of the malformed lines of a checked read (or of a CSV read), each once.

    ``parsed``: the fields that could be read, as JSON.
    """
    reason = F.col(REASON) if REASON in checked.columns else F.lit("does not fit the schema")
    fields = [c for c in checked.columns if c not in (REASON, CORRUPT, "event_id")]
    return checked.where(_faulty(checked)).select(F.col(CORRUPT).alias("line"), reason.alias(REASON),
                                                  F.to_json(F.struct(*fields)).alias("parsed"), "event_id")
