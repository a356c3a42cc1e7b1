"""Mixing sources to target weights by hierarchical budgeting.

The token budget flows down a tree (say domain, language, source): at each node
it is divided among the children by weight, no child getting more than it can
give (its tokens times the epochs allowed).  What a short child cannot take goes
to its siblings; only when all siblings are full does the parent itself count as
short towards its own siblings.  The division is exact integer arithmetic over
the sorted ratios capacity / weight, as windows over the (small) tree tables.

A leaf with ``a`` tokens to give out of ``t`` repeats whole epochs while they
fit and then takes a prefix of one more epoch, in the order of a seeded hash.
The prefix is found from sums per hash bucket, then inside one bucket only, so
no leaf is ever sorted whole.  A leaf's plan is two values (whole epochs, last
hash taken), so applying it moves no document.

Cases: null tree values count as ``unknown``, a null text has no tokens; a leaf
without tokens gives nothing; rows of one id stand and fall together (they
share the hash); an empty table gives an empty mix; floor division leaves at most
one token a node unspent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import keep

BROADCAST_LEAVES = 100_000  # a plan of at most so many leaves is broadcast
BUCKET_HEX = 3  # leading hash digits that number a bucket


@dataclass(frozen=True)
class Level:
    """One level of the tree: its column and the weights of its values."""

    column: str
    weights: Mapping[str, int] = field(default_factory=dict)
    other: int = 1

    def weight(self) -> Column:
        out = F.lit(self.other)
        for value, w in self.weights.items():
            out = F.when(F.col(self.column) == value, F.lit(w)).otherwise(out)
        return out.cast("decimal(38,0)")


def word_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _divide(children: DataFrame, parents: Sequence[str]) -> DataFrame:
    """Children (``weight``, ``cap``) with their parent's ``budget`` -> their own ``budget``."""
    by = Window.partitionBy(*parents)
    ratio = F.col("cap").cast("double") / F.col("weight").cast("double")
    before = by.orderBy(ratio, *[c for c in children.columns if c not in ("weight", "cap", "budget")]).rowsBetween(
        Window.unboundedPreceding, -1)
    big = lambda c: c.cast("decimal(38,0)")
    left = (children
            .withColumn("_b", big(F.col("budget")) - F.coalesce(big(F.sum("cap").over(before)), big(F.lit(0))))
            .withColumn("_w", big(F.sum("weight").over(by)) - F.coalesce(big(F.sum("weight").over(before)),
                                                                         big(F.lit(0)))))
    full = left.withColumn("_full", F.expr("cast(cap as decimal(19,0)) * cast(_w as decimal(18,0)) "
                                           "<= cast(_b as decimal(19,0)) * cast(weight as decimal(18,0))"))
    # The children after the last full one share what is left when the first of them is reached.
    shared = (full.withColumn("_b", F.max(F.when(~F.col("_full"), F.col("_b"))).over(by))
              .withColumn("_w", F.max(F.when(~F.col("_full"), F.col("_w"))).over(by)))
    share = F.expr("cast((cast(_b as decimal(19,0)) * cast(weight as decimal(18,0))) div cast(_w as decimal(18,0)) "
                   "as bigint)")
    return (shared.withColumn("budget", F.when(F.col("_full"), F.col("cap")).otherwise(F.least(F.col("cap"), share)))
            .drop("_b", "_w", "_full"))


def allocate(leaves: DataFrame, levels: Sequence[Level], budget_share: tuple[int, int], epochs: int) -> DataFrame:
    """Leaf table (tree columns, ``tokens``) with the leaf's ``budget``; the root has share a/b of all tokens."""
    names = [lv.column for lv in levels]
    leaves = leaves.withColumn("cap", F.col("tokens") * epochs)
    a, b = budget_share
    above = leaves.agg(F.least(F.expr(f"sum(tokens) * {int(a)} div {int(b)}"), F.sum("cap")).alias("budget"))
    for k, lv in enumerate(levels):
        nodes = leaves.groupBy(*names[: k + 1]).agg(F.sum("cap").alias("cap")).withColumn("weight", lv.weight())
        # The root is one row; below it children meet their parent's budget by the tree columns.
        nodes = nodes.join(above, names[:k]) if k else nodes.join(F.broadcast(above))
        above = _divide(nodes, names[:k]).select(*names[: k + 1], "budget")
    return leaves.join(above, names).select(*names, "tokens", "budget")


def order_key(seed: int, epoch: Column, id_col: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))


def plan(rows: DataFrame, levels: Sequence[Level], budget_share: tuple[int, int], epochs: int, seed: int,
         id_col: str = "doc_id") -> DataFrame:
    """Per leaf: ``full`` epochs taken whole and ``last``, the last hash taken of the epoch after them.

    ``rows`` holds the id, the tree columns and ``tokens`` of every document.
    """
    names = [lv.column for lv in levels]
    leaves = rows.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    goal = keep(allocate(leaves, levels, budget_share, epochs).where("tokens > 0").select(
        *names, F.expr("budget div tokens").alias("full"), F.expr("budget % tokens").alias("rest")), "leaf_budgets")
    keyed = (_with_leaf(rows, goal, names).withColumn("_key", order_key(seed, F.col("full"), id_col))
             .withColumn("_bucket", F.substring("_key", 1, BUCKET_HEX)))
    buckets = keyed.groupBy(*names, "full", "rest", "_bucket").agg(F.sum("tokens").alias("t"))
    run = Window.partitionBy(*names).orderBy("_bucket")
    edge = (buckets.withColumn("_upto", F.sum("t").over(run)).where("_upto > rest")
            .withColumn("_rank", F.row_number().over(run)).where("_rank = 1")
            .select(*names, F.col("_bucket").alias("_edge"), (F.col("_upto") - F.col("t")).alias("_before")))
    inside = _with_leaf(keyed, edge, names).where("_bucket = _edge").withColumn(
        "_upto", F.col("_before") + F.sum("tokens").over(Window.partitionBy(*names).orderBy("_key")))
    last = inside.where("_upto <= rest").groupBy(*names).agg(F.max("_key").alias("_last"))
    return goal.join(edge.select(*names, "_edge"), names).join(last, names, "left").select(
        *names, "full", F.coalesce("_last", "_edge").alias("last"))


def _with_leaf(rows: DataFrame, leaf_table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Join rows with a table of one row per leaf: broadcast while the leaves are few, else by key."""
    small = leaf_table.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    return rows.join(F.broadcast(leaf_table) if small else leaf_table, list(names))


def mix(rows: DataFrame, leaf_plan: DataFrame, levels: Sequence[Level], seed: int, id_col: str = "doc_id",
        out: str = "epoch") -> DataFrame:
    """The rows that the plan takes, once per epoch taken, with the epoch's number in ``out``."""
    names = [lv.column for lv in levels]
    got = _with_leaf(rows, leaf_plan, names)
    taken = F.when(order_key(seed, F.col("full"), id_col) <= F.col("last"), F.col("full")).otherwise(F.col("full") - 1)
    return (got.withColumn("_taken", taken.cast("int")).where("_taken >= 0")
            .withColumn(out, F.explode(F.sequence(F.lit(0), F.col("_taken")))).drop("full", "last", "_taken"))
