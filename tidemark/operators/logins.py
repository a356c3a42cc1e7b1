"""Repeated login failures.

All three detectors order each user's logins by (ts, event_id):

* ``fail_pairs``      - two consecutive fails, gap <= ``max_gap`` (C3).
* ``fail_runs``       - ``n`` consecutive fails spanning < ``within`` (C4/C5;
                        the pattern ``fail.times(n).consecutive().within(w)``).
* ``fail_episodes``   - greedy episodes: a fail opens one, fails up to
                        first + window join it, a success cancels it, at the
                        deadline it is reported if it holds >= ``min_fails`` (C2).

Consecutive rows are found without sorting a user's whole history in one
task: row numbers and fail counts come from the bucketed running scan
(``plans.ordered.running``), and the row ``n-1`` places earlier is an
equi-join on (user, row number) - a unique key, so no skew.  Episodes are
sequential (each opener depends on the previous episode), so they are
resolved by pointer doubling over next-opener links rather than by folding
a user's rows in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import epoch_micros, micros_to_ts
from ..plans.ordered import MINUTE_US, join_back, long_bucket, running, ts_bucket
from ..session import checkpoint_dir
from ..plans.sliding import duration_us

ORDER = ["ts", "event_id"]


def _is_fail() -> Column:
    """Anything but a fail, a NULL type included, breaks a sequence of fails."""
    return F.coalesce(F.col("event_type") == "fail", F.lit(False))


def _numbered(logins: DataFrame, bucket_us: int) -> DataFrame:
    is_fail = _is_fail().cast("bigint")
    base = logins.select("user_id", "event_id", "ts", is_fail.alias("f"))
    return running(base, ["user_id"], ORDER, ts_bucket("ts", bucket_us),
                   {"rn": F.lit(1).cast("bigint"), "cf": F.col("f")})


def fail_runs(logins: DataFrame, n: int = 2, within: str = "5 seconds", inclusive: bool = False,
              bucket_us: int = MINUTE_US) -> DataFrame:
    """(user_id, first_fail_ts, last_fail_ts, fails) for every window of ``n`` consecutive fails
    whose first and last are less than ``within`` apart (``<=`` when ``inclusive``)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    num = _numbered(logins, bucket_us).where(F.col("f") == 1)
    last = num.select("user_id", F.col("rn").alias("rn_last"), F.col("cf").alias("cf_last"),
                      F.col("ts").alias("last_fail_ts"))
    first = num.select("user_id", F.col("rn").alias("rn_first"), F.col("cf").alias("cf_first"),
                       F.col("ts").alias("first_fail_ts"))
    j = last.join(first, last.user_id.eqNullSafe(first.user_id) & (first.rn_first == last.rn_last - (n - 1)))
    gap = epoch_micros(F.col("last_fail_ts")) - epoch_micros(F.col("first_fail_ts"))
    w = duration_us(within)
    ok = (F.col("cf_last") - F.col("cf_first") == n - 1) & ((gap <= w) if inclusive else (gap < w))
    return j.where(ok).select(last.user_id, "first_fail_ts", "last_fail_ts", F.lit(n).cast("bigint").alias("fails"))


def fail_pairs(logins: DataFrame, max_gap: str = "2 seconds", bucket_us: int = MINUTE_US) -> DataFrame:
    """Consecutive fail pairs with gap <= ``max_gap`` -> (user_id, first_fail_ts, last_fail_ts)."""
    return fail_runs(logins, 2, max_gap, inclusive=True, bucket_us=bucket_us).drop("fails")


def _chain(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes reachable from ``roots`` along ``nxt`` pointers -> (user_id, node).

    Pointer doubling: ``J[k+1](x) = J[k](J[k](x))`` while any such pointer
    exists, then walk the powers back down from the roots (distance bits from
    high to low).  A table keeps only the nodes whose pointer is alive.  Each round is an equi-join on (user_id, node) - unique
    keys, so a user with a long chain is spread over all tasks - and each
    table is checkpointed to the shared checkpoint folder so the plan does
    not grow with the rounds.
    """
    checkpoint_dir(nodes.sparkSession)
    jumps = []
    alive = nodes.where(F.col("nxt").isNotNull()).select("user_id", "node", "nxt").checkpoint(eager=True)
    while not alive.isEmpty():
        jumps.append(alive)
        a, b = alive.alias("a"), alive.alias("b")
        hop = a.join(b, F.col("a.user_id").eqNullSafe(F.col("b.user_id")) & (F.col("a.nxt") == F.col("b.node")))
        alive = hop.select("a.user_id", "a.node", F.col("b.nxt").alias("nxt")).checkpoint(eager=True)
    reach = roots.select("user_id", "node")
    for jump in reversed(jumps):
        step = join_back(reach, jump, ["user_id", "node"]).select("user_id", F.col("nxt").alias("node"))
        reach = reach.unionByName(step).checkpoint(eager=True)
    return reach


def fail_episodes(logins: DataFrame, window: str = "2 seconds", min_fails: int = 2,
                  bucket_us: int = MINUTE_US) -> DataFrame:
    """Greedy failure episodes -> (user_id, first_fail_ts, last_fail_ts, fails).

    A fail ``o`` that opens an episode (deadline ``o + window``) determines
    everything after it: ``q`` = the first later row that is a success within
    the deadline (cancel: no report) or any row past the deadline.  The
    episode's members are the rows from ``o`` up to ``q`` (all fails), and the
    next opener is ``q`` if it is a fail, else the first fail after ``q``.
    These per-fail facts come from bucketed ordered scans (next success /
    next fail after each row; first row past each deadline, by scanning the
    deadlines merged into the rows) and unique-key joins - no key is sorted
    in one task.  Which fails actually open episodes is the chain of
    next-opener pointers from the fails that must open one - first of the
    user, right after a success, or after a gap longer than the window
    (``_chain``).
    """
    w = duration_us(window)
    base = logins.select("user_id", "event_id", epoch_micros(F.col("ts")).alias("t"),
                         _is_fail().alias("fail"))
    # rows (kind 0) merged with each fail's deadline mark (kind 1); a row at the deadline
    # instant sorts before the mark, so "before the mark" = t <= deadline
    rows = base.select("user_id", "t", "event_id", "fail", F.lit(0).alias("kind"))
    marks = base.where("fail").select("user_id", (F.col("t") + F.lit(w)).alias("t"), "event_id",
                                      F.lit(None).cast("boolean").alias("fail"), F.lit(1).alias("kind"))
    both = rows.unionByName(marks)
    bk = long_bucket(F.col("t"), bucket_us)
    is_row = F.col("kind") == 0
    # forward: rn = rows so far (for a mark: rows up to its deadline), lt = last row time so far
    fwd = running(both, ["user_id"], ["t", "kind", "event_id"], bk,
                  {"rn": is_row.cast("bigint"), "lt": F.when(is_row, F.col("t"))},
                  kind={"rn": "sum", "lt": "max"})
    checkpoint_dir(fwd.sparkSession)
    fwd = fwd.checkpoint(eager=True)  # the backward scan reads it twice
    me = F.struct("t", "event_id", "fail")
    # backward: next fail / next success / next row strictly after this row or mark
    scan = running(fwd, ["user_id"], [F.col("t").desc(), F.col("kind").desc(), F.col("event_id").desc()], -bk,
                   {"nf": F.when(is_row & F.col("fail"), me), "ns": F.when(is_row & ~F.col("fail"), me),
                    "nx": F.when(is_row, me)}, kind="min", include_current=False)
    scan = scan.checkpoint(eager=True)  # four consumers below; read it back instead of re-deriving it
    fails = scan.where(is_row & F.col("fail")).select("user_id", "event_id", "t", "rn", "ns")
    mark = scan.where(~is_row).select("user_id", "event_id", F.col("rn").alias("last_rn"), F.col("lt").alias("last"),
                                      F.col("nx").alias("ax"))
    fails = join_back(fails, mark, ["user_id", "event_id"])
    cancelled = F.col("ns").isNotNull() & (F.col("ns.t") <= F.col("t") + F.lit(w))
    q = F.when(cancelled, F.col("ns")).otherwise(F.col("ax"))
    fails = fails.select("user_id", "event_id", "t", "last", (F.col("last_rn") - F.col("rn") + 1).alias("n"),
                         cancelled.alias("cancelled"), q.alias("q"))
    nf = scan.where(is_row).select(F.col("user_id").alias("n_user"), F.col("event_id").alias("q_id"), "nf")
    linked = fails.join(nf, F.col("user_id").eqNullSafe(F.col("n_user")) & (F.col("q.event_id") == F.col("q_id")), "left")
    nxt = F.when(F.col("q.fail"), F.col("q.event_id")).otherwise(F.col("nf.event_id"))
    linked = linked.select("user_id", "event_id", nxt.alias("nxt"), "t", "cancelled", "last", "n")
    # sync roots: a fail right after a success, after a gap > window, or first of its user
    # opens an episode whatever came before, so chains restart there
    pred = scan.where(is_row & F.col("nx").isNotNull()).select(
        F.col("user_id").alias("p_user"), F.col("nx.event_id").alias("p_next"), F.col("t").alias("p_t"),
        F.col("fail").alias("p_fail"))
    linked = linked.join(pred, F.col("user_id").eqNullSafe(F.col("p_user")) & (F.col("event_id") == F.col("p_next")), "left")
    root = F.col("p_t").isNull() | ~F.col("p_fail") | (F.col("t") - F.col("p_t") > F.lit(w))
    checkpoint_dir(linked.sparkSession)
    nodes = linked.select("user_id", F.col("event_id").alias("node"), "nxt", "t", "cancelled", "last", "n",
                          root.alias("root")).checkpoint(eager=True)
    roots = nodes.where("root").select("user_id", "node")
    # pointers into a root end the chain there (the root starts its own)
    rk = roots.select(F.col("user_id").alias("r_user"), F.col("node").alias("r_node"))
    cut = nodes.join(rk, F.col("user_id").eqNullSafe(F.col("r_user")) & (F.col("nxt") == F.col("r_node")), "left")
    links = cut.select("user_id", "node", F.when(F.col("r_node").isNull(), F.col("nxt")).alias("nxt"))
    openers = _chain(links, roots)
    eps = join_back(nodes, openers, ["user_id", "node"]).where(~F.col("cancelled") & (F.col("n") >= min_fails))
    return eps.select(
        "user_id",
        micros_to_ts(F.col("t")).alias("first_fail_ts"),
        micros_to_ts(F.col("last")).alias("last_fail_ts"),
        F.col("n").alias("fails"),
    )
