"""Stream-stream joins on the transaction id (J1-J4 streaming forms).

Both are Spark's symmetric hash join: each side is hash-partitioned on
``tx_id`` and buffered in the state store; the time-range condition plus a
watermark on each side lets Spark drop buffered rows once no partner can
arrive (state bounded by the range, not by history).

``reconcile`` is a full outer join: an unmatched row is emitted once the
other side's watermark passes its range, with the same ``status`` column as
the batch form.  Inputs carry TIMESTAMP ``ts`` with a watermark (see
``streaming.sources.event_time``), or pass a delay per side.  The stream form pairs every in-range (pay, receipt) of a
tx_id; the one-to-one rule for duplicate ids (Q18) is ``replay.reconcile``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import interval_literal
from ..plans.sliding import duration_us


def _sides(pays: DataFrame, receipts: DataFrame, pay_delay: str | None, receipt_delay: str | None):
    """Rename each side's ``ts``; a delay declares that side's watermark (None: the input has one)."""
    p = (pays.where(F.col("tx_id").isNotNull() & (F.col("tx_id") != ""))
         .select(F.col("tx_id").alias("p_tx"), "order_id", F.col("ts").alias("pay_ts")))
    r = receipts.select(F.col("tx_id").alias("r_tx"), "pay_channel", F.col("ts").alias("receipt_ts"))
    if pay_delay is not None:
        p = p.withWatermark("pay_ts", pay_delay)
    if receipt_delay is not None:
        r = r.withWatermark("receipt_ts", receipt_delay)
    return p, r


def _signed_us(text: str) -> int:
    text = text.strip()
    sign = -1 if text.startswith("-") else 1
    return sign * duration_us(text.lstrip("+-"))


def interval_join(pays: DataFrame, receipts: DataFrame, lower: str = "-3 seconds", upper: str = "5 seconds",
                  pay_delay: str | None = None, receipt_delay: str | None = None) -> DataFrame:
    """(tx_id, order_id, pay_ts, receipt_ts, pay_channel) for receipt.ts in [pay.ts+lower, pay.ts+upper]."""
    p, r = _sides(pays, receipts, pay_delay, receipt_delay)
    lo, hi = _signed_us(lower), _signed_us(upper)
    cond = ((F.col("p_tx") == F.col("r_tx"))
            & (F.col("receipt_ts") >= F.col("pay_ts") + interval_literal(lo))
            & (F.col("receipt_ts") <= F.col("pay_ts") + interval_literal(hi)))
    return p.join(r, cond, "inner").select(F.col("p_tx").alias("tx_id"), "order_id", "pay_ts", "receipt_ts",
                                           "pay_channel")


def reconcile(pays: DataFrame, receipts: DataFrame, tolerance: str = "5 seconds",
              pay_delay: str | None = None, receipt_delay: str | None = None) -> DataFrame:
    """(tx_id, order_id, pay_ts, receipt_ts, pay_channel, status); unmatched rows after the watermark."""
    p, r = _sides(pays, receipts, pay_delay, receipt_delay)
    tol = duration_us(tolerance)
    cond = ((F.col("p_tx") == F.col("r_tx"))
            & (F.col("receipt_ts") >= F.col("pay_ts") + interval_literal(-tol))
            & (F.col("receipt_ts") <= F.col("pay_ts") + interval_literal(tol)))
    status = (F.when(F.col("p_tx").isNull(), F.lit("receipt_without_pay"))
              .when(F.col("r_tx").isNull(), F.lit("pay_without_receipt"))
              .otherwise(F.lit("matched")))
    return p.join(r, cond, "full_outer").select(
        F.coalesce("p_tx", "r_tx").alias("tx_id"), "order_id", "pay_ts", "receipt_ts", "pay_channel",
        status.alias("status"))
