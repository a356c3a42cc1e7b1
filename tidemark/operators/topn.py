"""Hot items / hot URLs: top-N per window by count.

One final ranking per window in event time; ties broken by the key so the
result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.topk import top_k
from .counts import item_window_counts, url_window_counts


def hot_items(
    behavior: DataFrame, n: int = 5, size: str = "1 hour", slide: str = "5 minutes", strategy: str = "auto"
) -> DataFrame:
    """The ``n`` most viewed items of every sliding window -> (window_end, rank, item_id, cnt)."""
    counts = item_window_counts(behavior, size, slide, strategy=strategy)
    ranked = top_k(counts, ["window_end"], [F.col("cnt").desc(), F.col("item_id")], n)
    return ranked.select("window_end", "rank", "item_id", "cnt")


def hot_urls(
    log: DataFrame, n: int = 5, size: str = "10 minutes", slide: str = "5 seconds", strategy: str = "auto"
) -> DataFrame:
    """The ``n`` most requested URLs of every sliding window -> (window_end, rank, url, cnt)."""
    counts = url_window_counts(log, size, slide, strategy=strategy)
    ranked = top_k(counts, ["window_end"], [F.col("cnt").desc(), F.col("url")], n)
    return ranked.select("window_end", "rank", "url", "cnt")


def render_rankings(ranked: DataFrame, key: str) -> DataFrame:
    """One display line per window from a top-N result -> (window_end, text).

    Only the already-cut top-N rows of a window are gathered (at most N per
    group), ordered by rank; the structured rows remain the primary result.
    """
    from ..functions.timecols import render_window_end

    entry = F.format_string("%d. %s=%s (%d)", F.col("rank"), F.lit(key), F.col(key).cast("string"), F.col("cnt"))
    per_window = ranked.groupBy("window_end").agg(
        F.array_sort(F.collect_list(F.struct("rank", entry.alias("e")))).alias("rows"))
    text = F.concat(F.lit("window end "), render_window_end(F.col("window_end")), F.lit(": "),
                    F.array_join(F.transform("rows", lambda r: r["e"]), "; "))
    return per_window.select("window_end", text.alias("text"))
