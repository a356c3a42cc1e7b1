"""Adapters: the given ``events`` table reshaped into each shop-log schema.

The mapping is fixed (FIXTURES.md §3) so that Spark and the SQL oracle see the
same rows.  Every adapter is a projection + filter over one parquet scan, so
Catalyst prunes ``events`` to the columns used and pushes the filters into the
scan.  ``event_id`` is kept as the unique last sort key for ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import floor_div
from .schemas import MARKET_CHANNELS


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "events")


def prop_k(props: str = "props") -> Column:
    """The ``k`` property of ``props`` ('{"k": n}') as BIGINT."""
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def user_behavior(ev: DataFrame) -> DataFrame:
    """UserBehavior: item = k, category = k % 10, 'view' is the page view 'pv'."""
    k = prop_k()
    return ev.select(
        "event_id",
        "user_id",
        k.alias("item_id"),
        (k % 10).cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
        "ts",
    )


def access_log(ev: DataFrame, extra: list[str] = ()) -> DataFrame:
    """ApacheLog: url = /item/<k>; GET for view/click, POST otherwise."""
    uid = F.col("user_id")
    return ev.select(
        *extra,
        "event_id",
        F.concat_ws(".", F.lit("10"), F.lit("0"), F.shiftright(uid.bitwiseAND(0xFF00), 8).cast("string"),
                    uid.bitwiseAND(0xFF).cast("string")).alias("ip"),
        uid.cast("string").alias("user_id"),
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type").isin("view", "click"), F.lit("GET")).otherwise(F.lit("POST")).alias("method"),
        F.concat(F.lit("/item/"), prop_k().cast("string")).alias("url"),
    )


def market_behavior(ev: DataFrame) -> DataFrame:
    """MarketUserBehavior: channel by user_id % 4, behaviour mapped from event_type (signup has none: NULL)."""
    channels = F.array(*[F.lit(c) for c in MARKET_CHANNELS])
    et = F.col("event_type")
    behavior = (
        F.when(et == "click", "CLICK")
        .when(et == "view", "DOWNLOAD")
        .when(et == "error", "UNINSTALL")
        .when(et == "purchase", "INSTALL")
    )
    return ev.select(
        "event_id",
        "user_id",
        behavior.alias("behavior"),
        F.get(channels, F.pmod(F.col("user_id"), F.lit(4)).cast("int")).alias("channel"),
        "ts",
    )


def ad_clicks(ev: DataFrame) -> DataFrame:
    """AdClickEvent: clicks only; ad = k % 5, province = p<user % 7>, city = c<user % 11>."""
    return ev.where(F.col("event_type") == "click").select(
        "event_id",
        "user_id",
        (prop_k() % 5).alias("ad_id"),
        F.concat(F.lit("p"), (F.col("user_id") % 7).cast("string")).alias("province"),
        F.concat(F.lit("c"), (F.col("user_id") % 11).cast("string")).alias("city"),
        "ts",
    )


def logins(ev: DataFrame) -> DataFrame:
    """LoginEvent: 'error' is a failed login, everything else a success."""
    return ev.select(
        "event_id",
        "user_id",
        F.concat(F.lit("10.1.0."), (F.col("user_id") % 256).cast("string")).alias("ip"),
        F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("event_type"),
        "ts",
    )


def order_events(ev: DataFrame) -> DataFrame:
    """OrderEvent lifecycle: order = event_id div 2; even ids create, odd ids pay."""
    eid = F.col("event_id")
    is_create = (eid % 2 == 0) & (F.col("event_type") != "error")
    is_pay = (eid % 2 == 1) & (F.col("event_type") != "view")
    order_id = floor_div(eid, 2)
    return ev.where(is_create | is_pay).select(
        "event_id",
        order_id.alias("order_id"),
        F.when(eid % 2 == 0, F.lit("create")).otherwise(F.lit("pay")).alias("event_type"),
        F.when(eid % 2 == 1, F.concat(F.lit("t"), order_id.cast("string"))).alias("tx_id"),
        "ts",
    )


def order_events_mixed(ev: DataFrame) -> DataFrame:
    """OrderEvent with repeated creates, unknown types and NULL types: five consecutive events are one order."""
    et = F.col("event_type")
    kind = F.when(et.isin("click", "view"), "create").when(et == "purchase", "pay").when(et == "error", "modify")
    return ev.select("event_id", floor_div(F.col("event_id"), 5).alias("order_id"), kind.alias("event_type"), "ts")


def _pair(eid: Column) -> Column:
    return floor_div(eid, 2)


def pay_events(ev: DataFrame) -> DataFrame:
    """Pay side of reconciliation: (event_id + pair) even, not 'error'."""
    eid = F.col("event_id")
    return ev.where(((eid + _pair(eid)) % 2 == 0) & (F.col("event_type") != "error")).select(
        "event_id",
        _pair(eid).alias("order_id"),
        F.lit("pay").alias("event_type"),
        F.concat(F.lit("t"), _pair(eid).cast("string")).alias("tx_id"),
        "ts",
    )


def receipts(ev: DataFrame) -> DataFrame:
    """Receipt side: (event_id + pair) odd, not 'signup'; channel by k % 2."""
    eid = F.col("event_id")
    return ev.where(((eid + _pair(eid)) % 2 == 1) & (F.col("event_type") != "signup")).select(
        "event_id",
        F.concat(F.lit("t"), _pair(eid).cast("string")).alias("tx_id"),
        F.when(prop_k() % 2 == 0, F.lit("wechat")).otherwise(F.lit("alipay")).alias("pay_channel"),
        "ts",
    )


def late_arrivals(ev: DataFrame) -> DataFrame:
    """Access-log rows with an arrival time: ``ts + (k % 25) minutes`` (ties by event_id).

    The table is in time order; the shift makes some rows arrive after younger
    rows, which is what the late-row operator classifies.
    """
    shifted = ev.withColumn("arrival_ts", F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), prop_k() % 25))
    return access_log(shifted, extra=["arrival_ts"])
