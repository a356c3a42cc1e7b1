"""Golden tests on small inline rows, with the shop's default parameters
(100 clicks, 2 s / 5 s login patterns, 15 min payment timeout, -3 s/+5 s
interval join, 5 s reconciliation)."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import string_hash
from tidemark.functions.timecols import from_epoch_seconds
from tidemark.operators import blacklist, counts, lateness, logins, orders, payments, topn, uniques
from tidemark.plans.sliding import window_counts

T0 = 1_558_430_800  # an epoch second; multiples of 3600 are not needed


def frame(spark, ddl, rows):
    df = spark.createDataFrame(rows, ddl)
    return df.withColumn("ts", from_epoch_seconds(F.col("ts_sec")))


def secs(col):
    return F.unix_timestamp(F.col(col).cast("timestamp")).alias(col)


# ---------------------------------------------------------------- functions
def test_string_hash_golden(spark):
    row = spark.range(1).select(string_hash(F.lit("543462")).alias("h")).first()
    assert row.h == 493197308


def test_string_hash_matches_python(spark):
    def ref(s, bits=29):
        h = 0
        for ch in s:
            h = (h * 31 + ord(ch)) & 0xFFFFFFFF
        return h & ((1 << bits) - 1)

    vals = [str(random.Random(i).randrange(10**9)) for i in range(50)]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = {r.s: r.h for r in df.select("s", string_hash(F.col("s")).alias("h")).collect()}
    assert got == {v: ref(v) for v in vals}


# ---------------------------------------------------------------- windows
def _random_events(spark, n=400, keys=3, span=7200, seed=7):
    rnd = random.Random(seed)
    rows = [(i, f"k{rnd.randrange(keys)}", T0 + rnd.randrange(span)) for i in range(n)]
    return frame(spark, "event_id bigint, key string, ts_sec bigint", rows)


@pytest.mark.parametrize("size,slide", [("1 minute", "5 seconds"), ("10 minutes", "1 minute"), ("1 hour", "5 minutes")])
def test_step_method_equals_window(spark, size, slide):
    df = _random_events(spark)
    a = window_counts(df, "ts", ["key"], size, slide, strategy="expand")
    b = window_counts(df, "ts", ["key"], size, slide, strategy="step")
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_tumbling_window_is_half_open(spark):
    # 3600-aligned hour: a row at the end instant belongs to the next window
    h = 1_558_429_200  # divisible by 3600
    assert h % 3600 == 0
    df = frame(spark, "event_id bigint, user_id bigint, behavior string, ts_sec bigint",
               [(1, 1, "pv", h), (2, 2, "pv", h + 3599), (3, 3, "pv", h + 3600), (4, 4, "buy", h + 5)])
    pv = {r.window_end: r.pv for r in counts.pv_counts(df).select(secs("window_end"), "pv").collect()}
    assert pv == {h + 3600: 2, h + 7200: 1}
    salted = {r.window_end: r.pv for r in counts.pv_counts_salted(df).select(secs("window_end"), "pv").collect()}
    assert salted == pv


def test_hot_items_rank_and_ties(spark):
    h = 1_558_429_200
    rows, eid = [], 0
    # item counts inside the hour: 10->4, 11->3, 12->3, 13->2, 14->1, 15->1
    for item, c in [(10, 4), (11, 3), (12, 3), (13, 2), (14, 1), (15, 1)]:
        for _ in range(c):
            rows.append((eid, 1, item, 0, "pv", h + 10 + eid))
            eid += 1
    rows.append((eid, 1, 99, 0, "buy", h + 20))  # not a page view
    df = frame(spark, "event_id bigint, user_id bigint, item_id bigint, category_id int, behavior string, "
                      "ts_sec bigint", rows)
    out = topn.hot_items(df, n=5, size="1 hour", slide="5 minutes")
    last = out.where(secs("window_end") == h + 3600).orderBy("rank").collect()
    assert [(r["rank"], r.item_id, r.cnt) for r in last] == [(1, 10, 4), (2, 11, 3), (3, 12, 3), (4, 13, 2), (5, 14, 1)]
    # every window keeps at most 5 rows, ranks 1..k
    per = out.groupBy("window_end").agg(F.count("*").alias("n"), F.max("rank").alias("m")).collect()
    assert all(r.n <= 5 and r.n == r.m for r in per)


def test_channel_counts_keep_null_behavior(spark):
    df = frame(spark, "event_id bigint, user_id bigint, behavior string, channel string, ts_sec bigint",
               [(1, 1, "CLICK", "wechat", T0), (2, 1, "UNINSTALL", "wechat", T0), (3, 1, None, "weibo", T0)])
    out = counts.channel_behavior_counts(df, "1 hour", "5 minutes")
    got = {(r.channel, r.behavior) for r in out.collect()}
    assert got == {("wechat", "CLICK"), ("weibo", None)}


# ---------------------------------------------------------------- unique visitors
def test_uv_exact_bitmap_running(spark):
    h = 1_558_429_200
    rows = [(1, 5, "pv", h + 1), (2, 6, "buy", h + 2), (3, 5, "pv", h + 3), (4, 7, "pv", h + 4), (5, 5, "pv", h + 3601)]
    df = frame(spark, "event_id bigint, user_id bigint, behavior string, ts_sec bigint", rows)
    ex = {r.window_end: r.uv for r in uniques.uv_exact(df).select(secs("window_end"), "uv").collect()}
    bm = {r.window_end: r.uv for r in uniques.uv_bitmap(df).select(secs("window_end"), "uv").collect()}
    assert ex == {h + 3600: 3, h + 7200: 1} and bm == ex
    run = sorted((r.event_id, r.uv) for r in uniques.uv_running(df).collect())
    assert run == [(1, 1), (2, 2), (3, 2), (4, 3), (5, 1)]


def test_uv_bitmap_counts_collisions_once(spark):
    # with 1 bit of hash every user lands on bit 0 or 1: the bitmap count is <= 2
    df = frame(spark, "event_id bigint, user_id bigint, behavior string, ts_sec bigint",
               [(i, 1000 + i, "pv", T0) for i in range(20)])
    bm = uniques.uv_bitmap(df, bits=1).first().uv
    assert 1 <= bm <= 2 and uniques.uv_exact(df).first().uv == 20


# ---------------------------------------------------------------- blacklist
AD = "event_id bigint, user_id bigint, ad_id bigint, province string, city string, ts_sec bigint"


def _clicks(spark, n, start=T0, user=937166, ad=1715, step=1):
    return [(i, user, ad, "beijing", "beijing", start + i * step) for i in range(n)]


def test_blacklist_warns_once_at_hundredth_click(spark):
    rows = _clicks(spark, 121) + [(500, 1, 2, "shanghai", "shanghai", T0)]
    df = frame(spark, AD, rows)
    warn = blacklist.blacklist_warnings(df, max_click=100).collect()
    assert [(w.user_id, w.ad_id, w.event_id) for w in warn] == [(937166, 1715, 99)]
    assert warn[0].warning_msg == "clicked more than 100 times"
    allowed = blacklist.allowed_clicks(df, max_click=100)
    assert allowed.count() == 99 + 1
    assert allowed.agg(F.max("event_id")).first()[0] == 500


def test_blacklist_daily_reset_in_utc_plus_8(spark):
    # 16:00 UTC is midnight at UTC+8: 2 clicks before, 2 after
    midnight = 1_558_454_400  # 2019-05-21 16:00 UTC
    rows = [(i, 1, 1, "p", "c", midnight - 10 + i * 5) for i in range(4)]  # -10, -5, 0, +5
    df = frame(spark, AD, rows)
    assert blacklist.blacklist_warnings(df, max_click=3, daily_reset=True).count() == 0
    assert blacklist.blacklist_warnings(df, max_click=3, daily_reset=False).count() == 1
    assert blacklist.blacklist_warnings(df, max_click=2, daily_reset=True).count() == 2


def test_province_counts_ignore_blacklist_by_default(spark):
    df = frame(spark, AD, _clicks(spark, 5))
    raw = counts.province_ad_counts(df, "1 hour", "5 minutes").agg(F.max("cnt")).first()[0]
    clean = blacklist.province_counts_clean(df, max_click=3, size="1 hour", slide="5 minutes").agg(
        F.max("cnt")).first()[0]
    assert (raw, clean) == (5, 2)


# ---------------------------------------------------------------- logins
LOGIN = "event_id bigint, user_id bigint, ip string, event_type string, ts_sec bigint"


def _logins(spark, rows):
    return frame(spark, LOGIN, [(i, u, "1.1.1.1", t, T0 + s) for i, (u, t, s) in enumerate(rows)])


def test_login_fail_pairs_default_2s(spark):
    df = _logins(spark, [(1035, "fail", 42), (1035, "fail", 43), (1035, "fail", 44), (1035, "success", 45),
                         (1035, "fail", 46), (7, "fail", 0), (7, "fail", 3), (8, "fail", 0), (8, "fail", 2)])
    got = sorted((r.user_id, r.first_fail_ts, r.last_fail_ts) for r in
                 logins.fail_pairs(df).select("user_id", secs("first_fail_ts"), secs("last_fail_ts")).collect())
    assert got == [(8, T0, T0 + 2), (1035, T0 + 42, T0 + 43), (1035, T0 + 43, T0 + 44)]


def test_login_fail_runs_within_is_strict(spark):
    df = _logins(spark, [(1, "fail", 0), (1, "fail", 5), (2, "fail", 0), (2, "fail", 4), (2, "success", 4),
                         (3, "fail", 0), (3, "success", 1), (3, "fail", 2)])
    got = sorted((r.user_id, r.fails) for r in logins.fail_runs(df, n=2, within="5 seconds").collect())
    assert got == [(2, 2)]
    assert logins.fail_runs(df, n=2, within="5 seconds", inclusive=True).count() == 2


def test_login_fail_runs_of_three(spark):
    df = _logins(spark, [(1, "fail", 0), (1, "fail", 1), (1, "fail", 2), (1, "fail", 3), (2, "fail", 0),
                         (2, "success", 1), (2, "fail", 2), (2, "fail", 3)])
    got = sorted((r.user_id, r.first_fail_ts) for r in
                 logins.fail_runs(df, n=3, within="5 seconds").select("user_id", secs("first_fail_ts")).collect())
    assert got == [(1, T0), (1, T0 + 1)]


def test_login_fail_episodes(spark):
    df = _logins(spark, [
        (1035, "fail", 42), (1035, "fail", 43), (1035, "fail", 44), (1035, "fail", 45),  # 45 > 42+2: new episode
        (5, "fail", 0), (5, "success", 1), (5, "fail", 2),                               # cancelled, then single
        (6, "fail", 0), (6, "fail", 2),                                                  # deadline inclusive
        (9, "fail", 0),
    ])
    got = sorted((r.user_id, r.first_fail_ts, r.last_fail_ts, r.fails) for r in logins.fail_episodes(df).select(
        "user_id", secs("first_fail_ts"), secs("last_fail_ts"), "fails").collect())
    assert got == [(6, T0, T0 + 2, 2), (1035, T0 + 42, T0 + 44, 3)]


# ---------------------------------------------------------------- orders
ORDER = "event_id bigint, order_id bigint, event_type string, tx_id string, ts_sec bigint"


def test_order_payment_status(spark):
    rows = [(1, 34729, "create", None, T0), (2, 34729, "pay", "sd76f87d6", T0 + 100),
            (3, 34756, "create", None, T0), (4, 34756, "pay", "x", T0 + 1038),
            (5, 34767, "create", None, T0),
            (6, 34768, "pay", "y", T0 + 5),
            (7, 1, "create", None, T0), (8, 1, "pay", "z", T0 + 899)]
    df = frame(spark, ORDER, rows)
    st = {r.order_id: r.status for r in orders.payment_status(df).collect()}
    assert st == {34729: "payed", 34756: "payed timeout", 34767: "pay timeout", 34768: "pay_without_create",
                  1: "payed"}
    to = {r.order_id: r.timeout_ts for r in orders.timeouts(df).select("order_id", secs("timeout_ts")).collect()}
    assert to == {34756: T0 + 900, 34767: T0 + 900}


# ---------------------------------------------------------------- pay / receipt
RECEIPT = "event_id bigint, tx_id string, pay_channel string, ts_sec bigint"


def _pays_receipts(spark):
    pays = frame(spark, ORDER, [(1, 1, "pay", "a", T0), (2, 2, "pay", "b", T0), (3, 3, "pay", "c", T0),
                                (4, 4, "pay", "d", T0), (5, 5, "create", None, T0), (6, 6, "pay", "", T0)])
    recs = frame(spark, RECEIPT, [(10, "a", "wechat", T0 - 3), (11, "b", "alipay", T0 + 5),
                                  (12, "c", "wechat", T0 - 4), (13, "d", "wechat", T0 + 6), (14, "e", "wechat", T0)])
    return pays, recs


def test_interval_join_bounds_inclusive(spark):
    pays, recs = _pays_receipts(spark)
    got = sorted(r.tx_id for r in payments.interval_join(pays, recs).collect())
    assert got == ["a", "b"]


def test_interval_join_emits_every_pair(spark):
    pays = frame(spark, ORDER, [(1, 1, "pay", "a", T0), (2, 2, "pay", "a", T0 + 1)])
    recs = frame(spark, RECEIPT, [(10, "a", "w", T0 + 1), (11, "a", "w", T0 + 2), (12, "a", "w", T0 + 100)])
    assert payments.interval_join(pays, recs).count() == 4


def test_reconcile_statuses(spark):
    pays, recs = _pays_receipts(spark)
    out = payments.reconcile(pays, recs, tolerance="5 seconds")
    got = sorted((r.tx_id, r.status) for r in out.collect())
    assert got == [("a", "matched"), ("b", "matched"), ("c", "matched"),
                   ("d", "pay_without_receipt"), ("d", "receipt_without_pay"), ("e", "receipt_without_pay")]


def test_reconcile_duplicates_are_one_to_one(spark):
    pays = frame(spark, ORDER, [(1, 1, "pay", "a", T0), (2, 2, "pay", "a", T0 + 1)])
    recs = frame(spark, RECEIPT, [(10, "a", "w", T0 + 2)])
    got = sorted((r.order_id, r.status) for r in payments.reconcile(pays, recs).collect())
    assert got == [(1, "matched"), (2, "pay_without_receipt")]


# ---------------------------------------------------------------- late rows
def test_late_rows(spark):
    # arrival order = event_id; the row at 100 s arrives after one at 1000 s
    rows = [(1, "GET", "/a", 0, 0), (2, "GET", "/a", 1000, 1), (3, "GET", "/a", 100, 2),
            (4, "GET", "/a", 990, 3), (5, "POST", "/b", 100, 4)]
    df = spark.createDataFrame(rows, "event_id bigint, method string, url string, t bigint, a bigint").select(
        "event_id", "method", "url", from_epoch_seconds(F.lit(T0) + F.col("t")).alias("event_time"),
        from_epoch_seconds(F.lit(T0) + F.col("a")).alias("arrival_ts"))
    late = lateness.late_rows(df, size="60 seconds", slide="5 seconds", bound="1 second", lateness="10 seconds")
    assert sorted(r.event_id for r in late.collect()) == [3]
    assert lateness.late_rows(df, size="60 seconds", slide="5 seconds", bound="1 second", lateness="10 seconds",
                              method=None).count() == 2


def test_render_rankings(spark):
    h = 1_558_429_200
    rows = [(i, 1, item, 0, "pv", h + 10 + i) for i, item in enumerate([7, 7, 8])]
    df = frame(spark, "event_id bigint, user_id bigint, item_id bigint, category_id int, behavior string, "
                      "ts_sec bigint", rows)
    ranked = topn.hot_items(df, n=5, size="1 hour", slide="5 minutes")
    text = topn.render_rankings(ranked, "item_id").where(secs("window_end") == h + 3600).first().text
    assert text == "window end 2019-05-21 10:00:00.0: 1. item_id=7 (2); 2. item_id=8 (1)"
