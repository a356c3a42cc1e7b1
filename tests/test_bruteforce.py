"""Login detectors against a plain Python fold on random small fixtures
(dense bursts, equal timestamps, long episode chains), and order-status
properties on the sf0.01 tables."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.timecols import from_epoch_seconds
from tidemark.operators import logins, orders
from tidemark.sources import adapters as ad

T0 = 1_700_000_000


def _episodes(rows, w, min_fails):
    out = []
    by_user = {}
    for eid, uid, t, fail in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by_user.setdefault(uid, []).append((t, fail))
    for uid, evs in by_user.items():
        is_open, deadline, n, first, last = False, 0, 0, 0, 0
        for t, fail in evs:
            if is_open and t > deadline:
                if n >= min_fails:
                    out.append((uid, first, last, n))
                is_open = False
            if is_open:
                if fail:
                    n, last = n + 1, t
                else:
                    is_open = False
            elif fail:
                is_open, deadline, n, first, last = True, t + w, 1, t, t
        if is_open and n >= min_fails:
            out.append((uid, first, last, n))
    return sorted(out)


def _runs(rows, n, within, inclusive):
    out = []
    by_user = {}
    for eid, uid, t, fail in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by_user.setdefault(uid, []).append((t, fail))
    for uid, evs in by_user.items():
        for i in range(n - 1, len(evs)):
            win = evs[i - n + 1:i + 1]
            gap = win[-1][0] - win[0][0]
            if all(f for _, f in win) and (gap <= within if inclusive else gap < within):
                out.append((uid, win[0][0], win[-1][0]))
    return sorted(out)


def _random_logins(seed, users=4, n=120):
    rnd = random.Random(seed)
    rows, eid = [], 0
    for u in range(users):
        t = rnd.randrange(100)
        for _ in range(n // users):
            t += rnd.choice([0, 0, 1, 1, 2, 3, 5, 8, 30])   # ties, bursts and gaps
            fail = rnd.random() < (0.9 if u == 0 else 0.6)  # user 0: long fail runs
            rows.append((eid, u, t, fail))
            eid += 1
    rnd.shuffle(rows)
    return rows


def _frame(spark, rows):
    df = spark.createDataFrame([(e, u, T0 + t, "fail" if f else "success") for e, u, t, f in rows],
                               "event_id bigint, user_id bigint, ts_sec bigint, event_type string")
    return df.withColumn("ts", from_epoch_seconds(F.col("ts_sec")))


def _secs(c):
    return (F.unix_timestamp(F.col(c).cast("timestamp")) - T0).alias(c)


@pytest.mark.parametrize("seed,w,min_fails", [(1, 5, 2), (2, 2, 2), (3, 10, 3), (4, 0, 1)])
def test_episodes_match_fold(spark, seed, w, min_fails):
    rows = _random_logins(seed)
    got = logins.fail_episodes(_frame(spark, rows), f"{w} seconds", min_fails)
    got = sorted(tuple(r) for r in got.select("user_id", _secs("first_fail_ts"), _secs("last_fail_ts"),
                                              "fails").collect())
    assert got == _episodes(rows, w, min_fails)


@pytest.mark.parametrize("seed,n,within,inclusive", [(5, 2, 2, True), (6, 2, 5, False), (7, 3, 6, False)])
def test_runs_match_fold(spark, seed, n, within, inclusive):
    rows = _random_logins(seed)
    df = _frame(spark, rows)
    if n == 2 and inclusive:
        res = logins.fail_pairs(df, f"{within} seconds")
    else:
        res = logins.fail_runs(df, n, f"{within} seconds", inclusive=inclusive)
    got = sorted(tuple(r) for r in res.select("user_id", _secs("first_fail_ts"), _secs("last_fail_ts")).collect())
    assert got == _runs(rows, n, within, inclusive)


def test_every_order_has_one_status(spark):
    st = orders.payment_status(ad.order_events(ad.events(spark, "/root/testdata/sf0.01")), "5 minutes")
    assert st.count() == st.select("order_id").distinct().count() == 4786
    kinds = {r.status for r in st.select("status").distinct().collect()}
    assert kinds <= {"payed", "payed timeout", "pay timeout", "pay_without_create"}
