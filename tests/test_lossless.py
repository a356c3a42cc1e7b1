"""NULL keys, default parameters, plan shapes, and the readers end to end."""

import datetime as dt
import itertools
import random

import pytest
from conftest import SF001
from pyspark.sql import functions as F
from tidemark import catalog
from tidemark.functions.timecols import floor_div, from_epoch_millis, from_epoch_seconds
from tidemark.operators import blacklist, counts, lateness, logins, orders, payments, topn, uniques
from tidemark.sources import adapters, files
from tidemark.streaming import sinks
from tidemark.streaming.replay import PairInOrder, PaymentTimeout

T0 = 1_511_658_000


def at(s, t0=T0):
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=t0 + s)


def market(spark, rows):
    return spark.createDataFrame(rows, "behavior string, channel string, t long").select(
        "behavior", "channel", from_epoch_seconds(F.col("t")).alias("ts"))


def test_null_groups_survive_both_window_plans(spark):
    df = market(spark, [(None, "wechat", T0), ("CLICK", None, T0 + 1), ("UNINSTALL", "wechat", T0), (None, "wechat", T0 + 2)])
    fine = counts.channel_behavior_counts(df)  # default 1 h / 5 s: the step plan
    assert {(r.channel, r.behavior, r.c) for r in fine.groupBy("channel", "behavior").agg(
        F.max("cnt").alias("c")).collect()} == {("wechat", None, 2), (None, "CLICK", 1)}
    assert fine.count() == 720 * 2
    same = counts.channel_behavior_counts(df, strategy="expand")
    assert fine.schema == same.schema and fine.exceptAll(same).isEmpty() and same.exceptAll(fine).isEmpty()


def test_window_type_follows_the_time_column(spark):
    df = market(spark, [("CLICK", "a", T0)])
    for kind in ("timestamp", "timestamp_ntz"):
        for plan in ("step", "expand"):
            out = counts.channel_behavior_counts(df.withColumn("ts", F.col("ts").cast(kind)), strategy=plan)
            assert dict(out.dtypes)["window_start"] == kind


def test_steady_traffic_is_cut_at_day_edges(spark):
    rows = [("CLICK", "a", T0 + 3600 * h) for h in range(60)]
    fine = counts.channel_behavior_counts(market(spark, rows), "1 hour", "1 minute", strategy="step")
    wide = counts.channel_behavior_counts(market(spark, rows), "1 hour", "1 minute", strategy="expand")
    assert fine.exceptAll(wide).isEmpty() and fine.count() == wide.count() == 60 * 60


def test_province_null_and_url_null(spark):
    clicks = spark.createDataFrame([(1, 1, None, T0), (2, 1, "p", T0)], "event_id long, user_id long, province string, t long")
    clicks = clicks.withColumn("ts", from_epoch_seconds(F.col("t")))
    assert counts.province_ad_counts(clicks).where("province IS NULL").count() == 720
    log = spark.createDataFrame([("GET", None, T0), ("GET", "/a", T0)], "method string, url string, t long").withColumn(
        "event_time", from_epoch_seconds(F.col("t")))
    assert counts.url_window_counts(log).where("url IS NULL").count() == 120


def test_blacklist_null_ad(spark):
    clicks = spark.createDataFrame([(i, 7, None, T0 + i) for i in range(4)], "event_id long, user_id long, ad_id long, t long")
    clicks = clicks.withColumn("ts", from_epoch_seconds(F.col("t")))
    assert blacklist.blacklist_warnings(clicks, max_click=3).count() == 1
    assert sorted(r.event_id for r in blacklist.allowed_clicks(clicks, max_click=3).collect()) == [0, 1]


def login_rows(spark, rows):
    return spark.createDataFrame([(i, u, k, T0 + s) for i, (u, k, s) in enumerate(rows)],
                                 "event_id long, user_id long, event_type string, t long").withColumn(
        "ts", from_epoch_seconds(F.col("t")))


def test_a_missing_login_type_is_no_fail(spark):
    df = login_rows(spark, [(1, "fail", 0), (1, None, 1), (1, "fail", 2), (None, "fail", 0), (None, "fail", 1)])
    assert [(r.user_id, r.fails) for r in logins.fail_episodes(df).collect()] == [(None, 2)]
    assert [r.user_id for r in logins.fail_pairs(df).collect()] == [None]


def test_reconcile_keeps_null_and_empty_ids(spark):
    ddl = "event_id long, order_id long, tx_id string, t long"
    pays = spark.createDataFrame([(1, 1, "a", T0), (2, 2, None, T0)], ddl).withColumn("ts", from_epoch_seconds(F.col("t")))
    recs = spark.createDataFrame([(5, "a", "w", T0 + 1), (6, None, "w", T0), (7, None, "v", T0)],
                                 "event_id long, tx_id string, pay_channel string, t long").withColumn(
        "ts", from_epoch_seconds(F.col("t")))
    for width in (None, 60_000_000):
        got = payments.reconcile(pays, recs, bucket_us=width).collect()
        assert sorted((r.tx_id or "", r.status) for r in got) == [
            ("", "receipt_without_pay"), ("", "receipt_without_pay"), ("a", "matched")]
        assert payments.unmatched_receipts(pays, recs, bucket_us=width).count() == 2
        assert payments.unmatched_pays(pays, recs, bucket_us=width).count() == 0


def order_rows(spark, rows):
    return spark.createDataFrame([(i, o, k, T0 + s) for i, (o, k, s) in enumerate(rows)],
                                 "event_id long, order_id long, event_type string, t long").withColumn(
        "ts", from_epoch_seconds(F.col("t")))


ORDERS = [(1, "create", 0), (1, "create", 2000), (1, "pay", 2010), (2, "modify", 0), (2, None, 1), (3, "pay", 0),
          (3, "pay", 5), (4, "pay", 10), (4, "create", 10), (5, "create", 0), (None, "create", 0)]


def test_each_create_has_its_status(spark):
    want = [(1, 0, "payed timeout"), (1, 2000, "payed"), (2, None, "other_event"), (3, None, "pay_without_create"),
            (4, 10, "payed"), (5, 0, "pay timeout"), (None, 0, "pay timeout")]
    for width in (None, 60_000_000):
        got = orders.payment_status(order_rows(spark, ORDERS), bucket_us=width).collect()
        rows = [(r.order_id, None if r.create_ts is None else (r.create_ts - at(0)).seconds, r.status) for r in got]
        assert sorted(rows, key=str) == sorted(want, key=str)
        assert orders.timeouts(order_rows(spark, ORDERS), bucket_us=width).count() == 3


def test_stream_fold_gives_the_same_order_statuses():
    p = PaymentTimeout(900_000_000, None)
    rows = [(s * 1_000_000, i, k == "create", k == "pay") for i, (o, k, s) in enumerate(ORDERS) if o == 4]
    out, state, _ = p.fold((4,), None, rows, 11_000_000)
    assert [x[3] for x in out] == ["payed"]
    out, state, _ = p.fold((3,), None, [(0, 1, False, True), (5, 2, False, True)], 10)
    assert [x[3] for x in out] == ["pay_without_create"]
    out, state, timers = p.fold((1,), None, [(0, 1, True, False)], 10)
    assert out == [] and timers == [900_000_000]
    out, state, _ = p.fold((1,), state, [], 900_000_001)
    assert [x[3] for x in out] == ["pay timeout"]
    out, state, _ = p.fold((1,), state, [(10 ** 13, 9, False, True)], 10 ** 13 + 1)  # however late
    assert [x[3] for x in out] == ["payed timeout"]


def test_integer_division_is_exact(spark):
    got = spark.createDataFrame([(9007199254740995,), (-3,)], "x long").select(floor_div(F.col("x"), 2)).collect()
    assert [r[0] for r in got] == [4503599627370497, -2]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai"])
def test_reader_times_do_not_shift_with_the_zone(spark, zone, tmp_path):
    (tmp_path / "log").write_text("1.2.3.4 7 - 17/05/2015:10:05:03 +0000 GET /a\n")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.range(1).select(from_epoch_seconds(F.lit(T0)).alias("a"), from_epoch_millis(F.lit(T0 * 1000)).alias("b")).first()
        assert row.a == row.b == dt.datetime(2017, 11, 26, 1, 0)
        assert files.read_access_log(spark, str(tmp_path)).first().event_time == dt.datetime(2015, 5, 17, 10, 5, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def csv(tmp_path, text):
    (tmp_path / "rows.csv").write_text(text)
    return str(tmp_path)


def test_behavior_file_to_operators(spark, tmp_path):
    df = files.read_user_behavior(spark, csv(tmp_path, f"1,10,5,pv,{T0}\n1,11,5,pv,{T0 + 1}\n2,10,5,buy,{T0 + 2}\nx,y\n"))
    assert [r._corrupt_record for r in df.collect() if r._corrupt_record] == ["x,y"]
    good = df.where("_corrupt_record IS NULL")
    assert topn.hot_items(good).where("rank = 1").count() > 0
    assert [r.uv for r in uniques.uv_running(good).orderBy("event_id").collect()] == [1, 1, 2]


def test_click_file_to_blacklist(spark, tmp_path):
    df = files.read_ad_clicks(spark, csv(tmp_path, "".join(f"9,3,beijing,b,{T0 + i}\n" for i in range(4))))
    assert blacklist.blacklist_warnings(df, max_click=3).count() == 1
    assert blacklist.allowed_clicks(df, max_click=3).count() == 2


def test_login_file_to_detectors(spark, tmp_path):
    df = files.read_logins(spark, csv(tmp_path, f"5402,83.1.1.1,fail,{T0}\n5402,83.1.1.1,fail,{T0 + 1}\n5402,83.1.1.1,success,{T0 + 2}\n"))
    assert logins.fail_pairs(df).count() == logins.fail_runs(df).count() == 1
    assert logins.fail_episodes(df).count() == 0


def test_order_and_receipt_files_to_reconcile(spark, tmp_path):
    (tmp_path / "o").mkdir()
    (tmp_path / "r").mkdir()
    o = files.read_order_events(spark, csv(tmp_path / "o", f"1,create,,{T0}\n1,pay,ewr,{T0 + 2}\n2,create,,{T0}\n"))
    r = files.read_receipts(spark, csv(tmp_path / "r", f"ewr,alipay,{T0 + 4}\n,wechat,{T0}\n"))
    assert {x.order_id: x.status for x in orders.payment_status(o).collect()} == {1: "payed", 2: "pay timeout"}
    got = payments.reconcile(o.where("event_type = 'pay'"), r).collect()
    assert sorted(x.status for x in got) == ["matched", "receipt_without_pay"]


def test_market_file_to_counts(spark, tmp_path):
    df = files.read_market_behavior(spark, csv(tmp_path, f"1,CLICK,wechat,{T0 * 1000}\n2,UNINSTALL,wechat,{T0 * 1000}\n"))
    assert counts.channel_behavior_counts(df).count() == 720
    now = counts.channel_behavior_counts(df.withColumn("now", F.current_timestamp()), ts="now")  # processing time
    assert now.agg(F.max("cnt")).first()[0] == 1


def test_log_file_to_late_rows(spark, tmp_path):
    line = "1.2.3.4 7 - 17/05/2015:10:{}:00 +0000 GET /a\n"
    (tmp_path / "log").write_text(line.format("05") + line.format("50") + line.format("06") + line.format("49"))
    late = lateness.late_rows(files.read_access_log(spark, str(tmp_path)), arrival=None).collect()
    assert [r.event_time.minute for r in late] == [6]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_sort_aggregate_over_raw_rows(spark):
    for name in ("uv_running", "login_fail_pairs", "hot_items_topn"):
        assert "SortAggregate" not in plan_of(catalog.QUERIES[name](spark, SF001)), name
    plan = plan_of(catalog.QUERIES["uv_bitmap_hourly"](spark, SF001))
    assert plan.rindex("HashAggregate") > plan.rindex("SortAggregate")  # below it: distinct bits


def test_panes_are_counted_before_they_are_spread(spark):
    plan = plan_of(catalog.QUERIES["hot_items_topn"](spark, SF001))
    assert plan.rindex("HashAggregate") > plan.rindex("Generate")


def test_reconcile_meets_in_one_exchange(spark):
    ev = adapters.events(spark, SF001)
    plan = plan_of(payments.reconcile(adapters.pay_events(ev), adapters.receipts(ev)))
    assert plan.count("Exchange ") == 1 and plan.count("FileScan") == 2


def test_split_by_refuses_kinds_without_a_path(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "kind string, v int")
    with pytest.raises(ValueError, match="without a path"):
        sinks.split_by("kind", {"a": str(tmp_path / "a")})(df, 0)
    sinks.split_by("kind", {"a": str(tmp_path / "a")}, other=str(tmp_path / "o"))(df, 0)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_upsert_keeps_other_keys_of_a_window(spark, tmp_path):
    def rows(*x):
        return spark.createDataFrame([(at(3600), k, c) for k, c in x], "window_end timestamp_ntz, k string, c int")

    with pytest.raises(ValueError, match="grouping columns"):
        sinks.upsert_windows(str(tmp_path / "bad"))(rows(("a", 1), ("b", 2)), 0)
    write = sinks.upsert_windows(str(tmp_path / "t"), keys=["k"])
    write(rows(("a", 1), ("b", 2)), 0)
    write(rows(("a", 5)), 1)
    assert {(r.k, r.c) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {("a", 5), ("b", 2)}


class DictState(dict):
    """A map state in memory."""

    containsKey, getValue, removeKey, updateValue = dict.__contains__, dict.__getitem__, dict.__delitem__, dict.__setitem__

    def iterator(self):
        return iter(list(self.items()))


def test_pairing_fold_equals_plain_numbering():
    """Rows arriving in four steps of the watermark give the pairs of numbering both sides at once."""
    rng = random.Random(5)
    for _ in range(50):
        rows = sorted((rng.randrange(200), i, rng.random() < 0.5, f"w{i}") for i in range(rng.randrange(1, 20)))
        fold, state, got, low = PairInOrder(15), None, [], 0
        fold.waiting = DictState()
        for limit in (40, 90, 150, 1000):
            out, state, _ = fold.fold(("t",), state, [r[:4] for r in rows if low <= r[0] < limit], limit)
            got, low = got + out, limit
        pays, receipts = [r for r in rows if r[2]], [r for r in rows if not r[2]]
        want = []
        for p, r in itertools.zip_longest(pays, receipts):
            if p and r and abs(p[0] - r[0]) <= 15:
                want.append(("t", p[3], p[0], r[0], r[3], "matched"))
                continue
            want += [("t", p[3], p[0], None, None, "pay_without_receipt")] if p else []
            want += [("t", None, None, r[0], r[3], "receipt_without_pay")] if r else []
        assert sorted(got, key=str) == sorted(want, key=str)
        assert not fold.waiting  # nothing left waiting


def test_partner_after_its_time_to_live():
    """A pay whose time is over is reported and leaves the map; its receipt, later, stays alone and is the same pair's."""
    fold = PairInOrder(10)
    fold.waiting = DictState()
    out, state, timers = fold.fold(("t",), None, [(100, 1, True, "o1")], 105)
    assert out == [] and list(fold.waiting) == [(1, True)] and timers == [111]
    out, state, timers = fold.fold(("t",), state, [], 111)
    assert out == [("t", "o1", 100, None, None, "pay_without_receipt")] and not fold.waiting and timers == []
    out, state, _ = fold.fold(("t",), state, [(112, 2, False, "r1"), (113, 3, True, "o2"), (114, 4, False, "r2")], 120)
    assert out == [("t", None, None, 112, "r1", "receipt_without_pay"), ("t", "o2", 113, 114, "r2", "matched")]
    assert not fold.waiting and state[:2] == (2, 2)


def test_reconcile_spreads_hot_and_missing_tx_ids(spark):
    """A third of the receipts without an id, a third of the pays under one id: the rows of the plain numbering."""
    rng = random.Random(9)
    side = lambda n, base: [(base + i, rng.choice(["hot", f"t{rng.randrange(200)}"]) if i % 3 else rng.choice([None, "", "hot"]),
                             rng.randrange(6 * 3600)) for i in range(n)]
    frame = lambda rows, extra, name: spark.createDataFrame(rows, "event_id long, tx_id string, t long").select(
        "event_id", "tx_id", from_epoch_seconds(F.col("t")).alias("ts"), extra.alias(name))
    pays = frame(side(600, 0), F.col("event_id"), "order_id")
    receipts = frame(side(600, 10_000), F.lit("wechat"), "pay_channel")
    assert payments.hot_tx_ids(payments._sides(pays, receipts), 100) == ["hot"]
    for fn in (payments.reconcile, payments.unmatched_pays, payments.unmatched_receipts):
        spread, plain = fn(pays, receipts, "5 minutes", hot_rows=100), fn(pays, receipts, "5 minutes")
        assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
    named = receipts.where("tx_id <> ''").count() + pays.where("tx_id <> ''").count()
    out = payments.reconcile(pays, receipts, "5 minutes", hot_rows=100)
    assert out.where("tx_id IS NULL OR tx_id = ''").count() == receipts.count() - receipts.where("tx_id <> ''").count()
    both = out.where("status = 'matched'").count()
    assert out.where("tx_id <> ''").count() + both == named
    # receipts without an id are dealt by their event id
    unnamed = payments._sides(pays, receipts).where("NOT coalesce(tx_id <> '', false)")
    assert unnamed.select("_own").distinct().count() == unnamed.count() > 100


def test_statuses_of_hot_and_missing_order_ids(spark):
    """A third of the events without an order id, a third under one id: the rows of the plain window."""
    rng = random.Random(12)
    rows = [(i, [None, 7, rng.randrange(100, 200)][i % 3], rng.choice(["create", "pay", "modify"]), rng.randrange(4 * 3600))
            for i in range(900)]
    ev = spark.createDataFrame(rows, "event_id long, order_id long, event_type string, t long").select(
        "event_id", "order_id", "event_type", from_epoch_seconds(F.col("t")).alias("ts"))
    assert set(orders.hot_keys(ev, "order_id", 200)) == {7, None} and orders.hot_keys(ev, "order_id", 400) == []
    spread, plain = orders.payment_status(ev, "5 minutes", hot_rows=200), orders.payment_status(ev, "5 minutes")
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty() and plain.where("order_id IS NULL").count() > 50
