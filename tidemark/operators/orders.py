"""Order payment lifecycle.

Every ``create`` is matched with the first ``pay`` of its order at or after it.

=====================  ==========================================
status                 condition
=====================  ==========================================
``payed``              pay - create < timeout
``payed timeout``      a pay exists but arrives at/after the timeout
``pay timeout``        created, no pay at or after it
``pay_without_create`` order paid, never created (one row, its first pay)
``other_event``        order with neither (one row)
=====================  ==========================================

One exchange on the order id and one sort by time: the next pay is a window
minimum over the rest of the order.  An order has a handful of events; ids that
collect very many (NULL among them) are looked for first, with a frequent-items
sketch, and take the next pay from the bucketed scan of ``plans.ordered`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_micros, micros_to_ts
from ..plans.ordered import HOT_ROWS, MINUTE_US, hot_keys, is_one_of, running, ts_bucket
from ..plans.sliding import duration_us
from ..sources.schemas import (CREATE, OTHER_EVENT, PAY, PAY_TIMEOUT, PAY_WITHOUT_CREATE, PAYED, PAYED_TIMEOUT)


def _with_next_pay(ev: DataFrame, bucket_us: int | None) -> DataFrame:
    if bucket_us is None:
        onward = Window.partitionBy("order_id").orderBy("ts").rangeBetween(Window.currentRow, Window.unboundedFollowing)
        return ev.withColumn("next_pay", F.min("paid_at").over(onward))
    # Latest first; of equal times the pays come first, so that they count as "at" the create's time.
    return running(ev, ["order_id"], [F.col("ts").desc(), F.col("paid_at").desc_nulls_last()],
                   -ts_bucket("ts", bucket_us), {"next_pay": F.col("paid_at")}, kind="min")


def payment_status(orders: DataFrame, timeout: str = "15 minutes", bucket_us: int | None = None,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """(order_id, create_ts, pay_ts, status): one row per create, and one per order without a create.

    ``bucket_us`` takes all ids through the bucketed scan; by default only ids of ``hot_rows`` rows or more are (a small
    job looks for them when the plan is built).
    """
    hot = hot_keys(orders, "order_id", hot_rows) if bucket_us is None else []
    if not hot:
        return _status(orders, duration_us(timeout), bucket_us)
    is_hot = is_one_of("order_id", hot)
    return _status(orders.where(~is_hot), duration_us(timeout), None).unionByName(
        _status(orders.where(is_hot), duration_us(timeout), MINUTE_US))


def _status(orders: DataFrame, t_us: int, bucket_us: int | None) -> DataFrame:
    kind = F.col("event_type")
    ev = orders.select("order_id", "ts", F.coalesce(kind == CREATE, F.lit(False)).alias("is_create"),
                       F.when(kind == PAY, F.col("ts")).alias("paid_at"))
    elapsed = epoch_micros(F.col("next_pay")) - epoch_micros(F.col("ts"))
    status = F.when(F.col("next_pay").isNull(), PAY_TIMEOUT).when(elapsed < t_us, PAYED).otherwise(PAYED_TIMEOUT)
    if bucket_us is None:
        order = Window.partitionBy("order_id")
        known = (_with_next_pay(ev, None).withColumn("created", F.max("is_create").over(order))
                 .withColumn("first_pay", F.min("paid_at").over(order))
                 .withColumn("n", F.row_number().over(order.orderBy("ts"))))
        rows = known.where(F.col("is_create") | (~F.col("created") & (F.col("n") == 1)))
        bare = F.when(F.col("first_pay").isNull(), OTHER_EVENT).otherwise(PAY_WITHOUT_CREATE)
        return rows.select("order_id", F.when(F.col("is_create"), F.col("ts")).alias("create_ts"),
                           F.when(F.col("is_create"), F.col("next_pay")).otherwise(F.col("first_pay")).alias("pay_ts"),
                           F.when(F.col("is_create"), status).otherwise(bare).alias("status"))
    created = _with_next_pay(ev, bucket_us).where("is_create").select(
        "order_id", F.col("ts").alias("create_ts"), F.col("next_pay").alias("pay_ts"), status.alias("status"))
    bare = (ev.groupBy("order_id").agg(F.max("is_create").alias("created"), F.min("paid_at").alias("pay_ts"))
            .where("NOT created"))
    return created.unionByName(bare.select(
        "order_id", F.lit(None).cast(dict(ev.dtypes)["ts"]).alias("create_ts"), "pay_ts",
        F.when(F.col("pay_ts").isNull(), OTHER_EVENT).otherwise(PAY_WITHOUT_CREATE).alias("status")))


def timeouts(orders: DataFrame, timeout: str = "15 minutes", bucket_us: int | None = None) -> DataFrame:
    """C6 timeout output: creates with no pay within ``timeout`` -> (order_id, create_ts, timeout_ts)."""
    st = payment_status(orders, timeout, bucket_us)
    t_us = duration_us(timeout)
    return st.where(F.col("status").isin(PAY_TIMEOUT, PAYED_TIMEOUT)).select(
        "order_id", "create_ts", micros_to_ts(epoch_micros(F.col("create_ts")) + F.lit(t_us)).alias("timeout_ts"))
