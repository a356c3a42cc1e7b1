"""Ordered scans that stay parallel when one key holds a large share of rows.

A plain ``Window.partitionBy(key).orderBy(ts)`` sorts every row of a key in
one task; a key with a third of all rows then becomes a single-task stage.
Here each key is split into time buckets: the per-bucket aggregate (partial +
final, skew-free; a hash aggregate for sums and for extremes of numbers, a sort
aggregate for extremes of structs) is scanned at bucket granularity (tiny),
joined back on (key, bucket), and the in-bucket scan runs over
(key, bucket) partitions.  NULL keys are a group of their own, as in ``groupBy``.
One (key, bucket) is never split further: choose the width for the hottest key.  A bucket's size is bounded by the data rate of a
single key over the bucket width, not by the key's total history: with
one-minute buckets, a key holding a third of 100 TB over 30 days still
gives about 1 GB per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_micros, floor_div

MINUTE_US = 60_000_000
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US


def long_bucket(micros: Column, width_us: int = HOUR_US) -> Column:
    """Bucket number of an epoch-micros long column."""
    return floor_div(micros, width_us)


def ts_bucket(ts_col: str, width_us: int = HOUR_US) -> Column:
    return long_bucket(epoch_micros(F.col(ts_col)), width_us)


def join_back(rows: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` that also pairs NULL keys; the facts' key columns are dropped."""
    named = facts.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in facts.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return rows.join(named, cond, "inner").drop(*[f"_r_{k}" for k in keys])


HOT_KEYS, TRACKED = 1000, 10_000  # keys that the sketch reports, keys that it follows
HOT_ROWS = 1 << 20  # rows from which a key is spread over buckets


def hot_keys(rows: DataFrame, key: str, least: int = HOT_ROWS) -> list:
    """The values of ``key`` (None: NULL) with ``least`` rows or more among the ``HOT_KEYS`` most frequent ones.

    One scan of the key with a frequent-items sketch, a few KB per task.  A value that is not among them holds at most
    a thousandth of the rows.  Counts are the sketch's.
    """
    top = rows.agg(F.expr(f"approx_top_k({key}, {HOT_KEYS}, {TRACKED})").alias("top")).first().top
    return [r["item"] for r in top or [] if r["count"] >= least]


def is_one_of(key: str, values: Sequence) -> Column:
    """Whether ``key`` is one of ``values``, NULL included; never NULL."""
    named = F.coalesce(F.col(key).isin([v for v in values if v is not None]), F.lit(False))
    return named | F.col(key).isNull() if None in values else named


def _by(keys: Sequence[str]):
    """Window spec over keys; with no keys the scan is global (bucket level only)."""
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def _agg(kind: str, c: Column) -> Column:
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](c)


def _combine(kind: str, a: Column, b: Column) -> Column:
    if kind == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    fn = F.greatest if kind == "max" else F.least
    return fn(a, b)  # greatest/least skip NULLs


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: Column,
    values: Mapping[str, Column],
    kind: str | Mapping[str, str] = "sum",
    include_current: bool = True,
) -> DataFrame:
    """Add running aggregates ``out = kind(value)`` over each key's rows in ``order``.

    ``bucket`` must be monotone in ``order`` (a time bucket of the first order
    column).  ``include_current=False`` aggregates strictly earlier rows.
    ``kind`` is one of sum/max/min, or a mapping from output name to kind.
    """
    keys = list(keys)
    kinds = {o: (kind[o] if isinstance(kind, Mapping) else kind) for o in values}
    b = df.withColumn("_bk", bucket)
    tot = b.groupBy(*keys, "_bk").agg(*[_agg(kinds[o], v).alias(f"_t_{o}") for o, v in values.items()])
    before = _by(keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*keys, "_bk",
                     *[_agg(kinds[o], F.col(f"_t_{o}")).over(before).alias(f"_o_{o}") for o in values])
    inner = Window.partitionBy(*keys, "_bk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if include_current else -1
    )
    j = join_back(b, off, [*keys, "_bk"])
    return j.select(
        *[c for c in b.columns if c != "_bk"],
        *[_combine(kinds[o], F.col(f"_o_{o}"), _agg(kinds[o], v).over(inner)).alias(o) for o, v in values.items()],
    )
