"""Order payment lifecycle of a stream, in the JVM.

``payment_alerts`` answers as soon as it can: a stream-stream outer join of creates and
pays with the timeout as its range.  A pair comes out when its second row does, a
create without a pay once the watermark passes its timeout; an inner join over the
range behind it reports late pays.  State is bounded by timeout + retention.

``payment_status`` gives each order's final rows, as the batch operator does, unknown
events included: the events of an order form a session that closes ``horizon`` after
the last of them, and the statuses are computed from the closed session.  State is an
order's events until then (an order has a handful).  Rows of a NULL order id are one
order, as in the batch form; a stream where many ids are NULL should drop them first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import epoch_micros, interval_literal
from ..plans.sliding import duration_us
from ..sources.schemas import CREATE, OTHER_EVENT, PAY, PAY_TIMEOUT, PAY_WITHOUT_CREATE, PAYED, PAYED_TIMEOUT


def _side(orders: DataFrame, kind: str, prefix: str) -> DataFrame:
    return orders.where(F.col("event_type") == kind).select(
        F.col("order_id").alias(f"{prefix}_order"), F.col("ts").alias(f"{prefix}_ts"))


def payment_alerts(orders: DataFrame, timeout: str = "15 minutes", retention: str = "1 hour") -> DataFrame:
    """(order_id, create_ts, pay_ts, status) as soon as known; ``orders`` carries a watermark on ``ts``.

    ``payed`` for every pay in time, ``pay timeout`` for a create without one, and ``payed timeout`` for pays up to
    ``retention`` after the timeout (besides the ``pay timeout`` that the create has had by then).
    """
    creates, pays = _side(orders, CREATE, "c"), _side(orders, PAY, "p")
    t_us, r_us = duration_us(timeout), duration_us(retention)

    def within(lo: int, hi: int) -> Column:
        return ((F.col("c_order") == F.col("p_order")) & (F.col("p_ts") >= F.col("c_ts") + interval_literal(lo))
                & (F.col("p_ts") < F.col("c_ts") + interval_literal(hi)))

    def shown(joined: DataFrame, status: Column) -> DataFrame:
        return joined.select(F.col("c_order").alias("order_id"), F.col("c_ts").alias("create_ts"),
                             F.col("p_ts").alias("pay_ts"), status.alias("status"))

    in_time = creates.join(pays, within(0, t_us), "left_outer")
    late = creates.join(pays, within(t_us, t_us + r_us), "inner")
    return shown(in_time, F.when(F.col("p_ts").isNull(), PAY_TIMEOUT).otherwise(PAYED)).unionByName(
        shown(late, F.lit(PAYED_TIMEOUT)))


def payment_status(orders: DataFrame, timeout: str = "15 minutes", horizon: str = "1 hour") -> DataFrame:
    """(order_id, create_ts, pay_ts, status), final, one row per create and one per order without a create.

    ``orders`` carries a watermark on ``ts``; ``horizon`` (at least the timeout) is how long an order may be silent
    and still be the same order: events that come later start anew.
    """
    t_us, gap_us = duration_us(timeout), duration_us(horizon)
    if gap_us < t_us:
        raise ValueError("an order must be kept for its timeout at least")
    kind = F.col("event_type")
    event = F.struct("ts", F.coalesce(kind == CREATE, F.lit(False)).alias("is_create"), F.coalesce(kind == PAY, F.lit(False)).alias("is_pay"))
    sessions = orders.groupBy(F.session_window("ts", f"{gap_us} microseconds").alias("s"), "order_id").agg(
        F.collect_list(event).alias("events"))
    times = lambda flag: F.transform(F.filter("events", lambda e: e[flag]), lambda e: e["ts"])
    known = sessions.select("order_id", times("is_create").alias("creates"), times("is_pay").alias("pays"))

    def row(create: Column, pay: Column, status: Column) -> Column:
        return F.struct(create.alias("create_ts"), pay.alias("pay_ts"), status.alias("status"))

    def of_create(c: Column) -> Column:
        pay = F.array_min(F.filter("pays", lambda p: p >= c))
        in_time = epoch_micros(pay) - epoch_micros(c) < t_us
        return row(c, pay, F.when(pay.isNull(), PAY_TIMEOUT).when(in_time, PAYED).otherwise(PAYED_TIMEOUT))

    first = F.array_min("pays")
    bare = F.array(row(F.lit(None).cast("timestamp"), first,
                       F.when(first.isNull(), OTHER_EVENT).otherwise(PAY_WITHOUT_CREATE)))
    rows = F.when(F.size("creates") > 0, F.transform("creates", of_create)).otherwise(bare)
    return known.select("order_id", F.explode(rows).alias("r")).select("order_id", "r.*")
