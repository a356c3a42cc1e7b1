"""Click-fraud blacklist.

Per (user, ad[, business day]) the ``max_click``-th click raises one warning;
that click and every later one leave the main stream.  The N-th click is found
with a top-N per group (up to N = 1000, a partial ``WindowGroupLimit`` caps what each
map task ships to N rows per group; a larger N sorts a group's clicks in one task), and the main stream keeps a click iff it sorts
before its group's threshold click - a join against one row per flagged
group, which AQE broadcasts when it is small and splits when a group is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import business_day
from ..plans.ordered import MINUTE_US, running, ts_bucket
from ..plans.topk import top_k
from .counts import province_ad_counts


def _keyed(clicks: DataFrame, daily_reset: bool, utc_offset_hours: int) -> tuple[DataFrame, list[str]]:
    keys = ["user_id", "ad_id"]
    if daily_reset:
        clicks = clicks.withColumn("day", business_day(F.col("ts"), utc_offset_hours))
        keys.append("day")
    return clicks, keys


def _order():
    return [F.col("ts"), F.col("event_id")]


def click_numbers(clicks: DataFrame, daily_reset: bool = True, utc_offset_hours: int = 8,
                  bucket_us: int = MINUTE_US) -> DataFrame:
    """A10: every click with ``click_no``, its running number in its (user, ad[, day]).

    A bucketed scan, so a key that holds a third of all clicks is spread over its minutes.
    """
    keyed, keys = _keyed(clicks, daily_reset, utc_offset_hours)
    return running(keyed, keys, _order(), ts_bucket("ts", bucket_us), {"click_no": F.lit(1).cast("bigint")})


def blacklist_warnings(clicks: DataFrame, max_click: int = 100, daily_reset: bool = True,
                       utc_offset_hours: int = 8) -> DataFrame:
    """(user_id, ad_id[, day], ts, event_id, warning_msg): one row per group reaching ``max_click``."""
    keyed, keys = _keyed(clicks, daily_reset, utc_offset_hours)
    nth = top_k(keyed.select(*keys, "ts", "event_id"), keys, _order(), max_click).where(F.col("rank") == max_click)
    return nth.select(*keys, "ts", "event_id",
                      F.lit(f"clicked more than {max_click} times").alias("warning_msg"))


def allowed_clicks(clicks: DataFrame, max_click: int = 100, daily_reset: bool = True,
                   utc_offset_hours: int = 8) -> DataFrame:
    """the click stream without each group's ``max_click``-th and later clicks."""
    keyed, keys = _keyed(clicks, daily_reset, utc_offset_hours)
    warn = blacklist_warnings(clicks, max_click, daily_reset, utc_offset_hours).select(
        *keys, F.struct("ts", "event_id").alias("_cut"))
    named = warn.select("_cut", *[F.col(k).alias(f"_w_{k}") for k in keys])
    j = keyed.join(named, [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys], "left")
    keep = F.col("_cut").isNull() | (F.struct("ts", "event_id") < F.col("_cut"))
    return j.where(keep).select(*clicks.columns)


def province_counts_clean(clicks: DataFrame, max_click: int = 100, size: str = "1 hour",
                          slide: str = "5 seconds", daily_reset: bool = True, strategy: str = "auto") -> DataFrame:
    """A9 over the filtered stream (``exclude_blacklisted=True`` form of Q7)."""
    return province_ad_counts(allowed_clicks(clicks, max_click, daily_reset), size, slide, strategy)
