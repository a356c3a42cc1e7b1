"""Top-k rows per group.

``row_number() over (partition by g order by ...) <= k`` is planned by Spark
(3.5+) with a *partial* ``WindowGroupLimit`` below the exchange: each map task
forwards at most k rows per group, so a group with millions of candidates (a
busy window) never reaches the final sort in full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Keep the first ``k`` rows of each group in ``order`` (ties must be broken by the caller)."""
    w = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))
