"""Pay / receipt matching on the transaction id.

* ``interval_join``: every (pay, receipt) pair with the same tx_id and
  receipt.ts in [pay.ts + lower, pay.ts + upper] (both bounds inclusive).
  The equi-key is (tx_id, time bucket): pays sit in the bucket of their time,
  receipts are copied into the (at most two) buckets their range touches, so a
  hot tx_id never meets all of its partners at once.
* ``reconcile``: one-to-one matching.  The i-th pay of a tx_id (by time) pairs
  with its i-th receipt when they are at most ``tolerance`` apart; every other
  row stays unmatched on its own side.  Receipts with a NULL or empty tx id are
  unmatched; each has a key of its own, so they are spread over all tasks.  Status:
  matched / pay_without_receipt / receipt_without_pay.

Tx ids are near unique, so rows are numbered per tx id in one exchange.  Ids of very
many rows are looked for first, with a frequent-items sketch (one scan of the ids,
a few KB per task), and are numbered by the bucketed scan of ``plans.ordered``, which
spreads an id over its minutes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_micros, floor_div
from ..plans.ordered import HOT_ROWS, MINUTE_US, hot_keys, is_one_of, running, ts_bucket
from ..plans.sliding import duration_us


def _named():
    return F.coalesce(F.col("tx_id") != "", F.lit(False))


def _with_tx(rows: DataFrame) -> DataFrame:
    return rows.where(_named())


def interval_join(pays: DataFrame, receipts: DataFrame, lower: str = "-3 seconds", upper: str = "5 seconds",
                  bucket_us: int | None = None) -> DataFrame:
    """(tx_id, order_id, pay_ts, receipt_ts, pay_channel) for every pair in range."""
    lo, hi = _signed_us(lower), _signed_us(upper)
    width = bucket_us or max(hi - lo, 1)
    p = _with_tx(pays).select("tx_id", "order_id", F.col("ts").alias("pay_ts"))
    p = p.withColumn("pt", epoch_micros(F.col("pay_ts"))).withColumn("_b", floor_div(F.col("pt"), width))
    r = receipts.select("tx_id", "pay_channel", F.col("ts").alias("receipt_ts"))
    r = r.withColumn("rt", epoch_micros(F.col("receipt_ts")))
    # pay.ts in [r.ts - hi, r.ts - lo]: buckets of both ends (equal or adjacent as width >= hi - lo)
    r = r.withColumn("_b", F.explode(F.array_distinct(F.array(
        floor_div(F.col("rt") - hi, width), floor_div(F.col("rt") - lo, width)))))
    j = p.join(r, ["tx_id", "_b"]).where((F.col("rt") >= F.col("pt") + lo) & (F.col("rt") <= F.col("pt") + hi))
    return j.select("tx_id", "order_id", "pay_ts", "receipt_ts", "pay_channel")


def _signed_us(text: str) -> int:
    text = text.strip()
    if text.startswith("-"):
        return -duration_us(text[1:])
    return duration_us(text.lstrip("+"))


def hot_tx_ids(rows: DataFrame, least: int = HOT_ROWS) -> list[str]:
    """The tx ids of ``least`` rows or more (``plans.ordered.hot_keys``)."""
    return hot_keys(_with_tx(rows), "tx_id", least)


def _sides(pays: DataFrame, receipts: DataFrame) -> DataFrame:
    """Pays and receipts as one tagged table, so that both meet in a single exchange on the tx id.

    ``_own``: NULL, or the event id of a receipt without a tx id, which so meets no other row.
    """
    p = _with_tx(pays).select("tx_id", F.lit(True).alias("is_pay"), "ts", "event_id", "order_id",
                              F.lit(None).cast("string").alias("pay_channel"))
    r = receipts.select("tx_id", F.lit(False).alias("is_pay"), "ts", "event_id",
                        F.lit(None).cast(dict(p.dtypes)["order_id"]).alias("order_id"), "pay_channel")
    return p.unionByName(r).withColumn("_own", F.when(~_named(), F.col("event_id")))


def _numbered(rows: DataFrame, bucket_us: int | None) -> DataFrame:
    """``nth``: the row's number among its side's rows of the tx id."""
    keys, order = ["tx_id", "_own", "is_pay"], ["ts", "event_id"]
    if bucket_us is None:
        # The pair of the n-th rows then aggregates on (tx_id, nth), which this exchange already serves.
        by_tx = rows.repartition("tx_id", "_own")
        return by_tx.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return running(rows, keys, order, ts_bucket("ts", bucket_us), {"nth": F.lit(1).cast("bigint")})


def _pairs(numbered: DataFrame) -> DataFrame:
    side = lambda c, pay: F.max(F.when(F.col("is_pay") == pay, F.col(c)))
    return numbered.groupBy("tx_id", "_own", "nth").agg(
        side("ts", True).alias("pay_ts"), side("order_id", True).alias("order_id"),
        side("ts", False).alias("receipt_ts"), side("pay_channel", False).alias("pay_channel"),
        F.max("is_pay").alias("has_pay"), (~F.min("is_pay")).alias("has_receipt")).drop("_own", "nth")


def _paired(pays: DataFrame, receipts: DataFrame, tolerance: str, bucket_us: int | None, hot_rows: int) -> DataFrame:
    """One row per (tx id, n): the n-th pay and the n-th receipt, ``near`` if both exist within the tolerance."""
    rows = _sides(pays, receipts)
    hot = hot_tx_ids(rows, hot_rows) if bucket_us is None else []
    if hot:
        is_hot = is_one_of("tx_id", hot)
        pairs = _pairs(_numbered(rows.where(~is_hot), None)).unionByName(_pairs(_numbered(rows.where(is_hot), MINUTE_US)))
    else:
        pairs = _pairs(_numbered(rows, bucket_us))
    gap = F.abs(epoch_micros(F.col("receipt_ts")) - epoch_micros(F.col("pay_ts")))
    return pairs.withColumn("near", F.coalesce((gap <= duration_us(tolerance)) & _named(), F.lit(False)))


def unmatched_pays(pays: DataFrame, receipts: DataFrame, tolerance: str = "5 seconds",
                   bucket_us: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(tx_id, order_id, pay_ts) of the pays without their receipt."""
    return _paired(pays, receipts, tolerance, bucket_us, hot_rows).where("has_pay AND NOT near").select(
        "tx_id", "order_id", "pay_ts")


def unmatched_receipts(pays: DataFrame, receipts: DataFrame, tolerance: str = "5 seconds",
                       bucket_us: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(tx_id, receipt_ts, pay_channel) of the receipts without their pay."""
    return _paired(pays, receipts, tolerance, bucket_us, hot_rows).where("has_receipt AND NOT near").select(
        "tx_id", "receipt_ts", "pay_channel")


def reconcile(pays: DataFrame, receipts: DataFrame, tolerance: str = "5 seconds",
              bucket_us: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(tx_id, order_id, pay_ts, receipt_ts, pay_channel, status) - every pay and receipt exactly once.

    ``bucket_us`` numbers the rows of all ids by the bucketed scan; by default only ids of ``hot_rows`` rows or more
    are (a small job looks for them when the plan is built).
    """
    pairs = _paired(pays, receipts, tolerance, bucket_us, hot_rows)
    none = lambda c: F.lit(None).cast(dict(pairs.dtypes)[c])
    row = lambda status, pay, receipt: F.struct(
        *[(F.col(c) if pay else none(c)).alias(c) for c in ("order_id", "pay_ts")],
        *[(F.col(c) if receipt else none(c)).alias(c) for c in ("receipt_ts", "pay_channel")],
        F.lit(status).alias("status"))
    rows = F.when(F.col("near"), F.array(row("matched", True, True))).otherwise(F.filter(F.array(
        F.when(F.col("has_pay"), row("pay_without_receipt", True, False)),
        F.when(F.col("has_receipt"), row("receipt_without_pay", False, True))), lambda x: x.isNotNull()))
    return pairs.select("tx_id", F.explode(rows).alias("r")).select("tx_id", "r.*")
