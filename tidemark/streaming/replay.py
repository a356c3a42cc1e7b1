"""Ordered-replay stateful processors (C1-C7, W11-W13 streaming forms).

Every detector here is a fold over one key's rows in event-time order.  A
stream delivers rows out of order (within the watermark delay), so each
processor buffers a key's new rows in ``ListState`` and folds only the rows
the watermark has passed: no row with an earlier time can still arrive for
them.  The fold state lives in ``ValueState``; event-time timers wake a key
when its buffered rows or its own deadline (episode end, payment timeout,
end of business day) fall behind the watermark.  The result equals the batch
operator on the same rows, late rows (older than the watermark) excepted.

Spark hash-partitions the stream by the grouping key, so keys are spread
over all tasks; a key's buffer is bounded by its rows within the delay.
Runs on ``transformWithStateInPandas`` (RocksDB state store).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.timecols import business_day
from ..plans.sliding import duration_us
from ..sources.schemas import CREATE, PAY, PAY_TIMEOUT, PAY_WITHOUT_CREATE, PAYED, PAYED_TIMEOUT

DAY_US = 86_400_000_000


def _after_ms(us: int) -> int:
    """First millisecond timer that fires only once the watermark is past ``us``."""
    return us // 1000 + 1


def _at_ms(us: int) -> int:
    """First millisecond timer that fires once the watermark has reached ``us``."""
    return -((-us) // 1000)


def _py(v):
    """numpy scalar -> Python value (state rows must hold plain Python types)."""
    if v is None or (isinstance(v, float) and v != v):
        return None
    return v.item() if hasattr(v, "item") else v


class _Replay(StatefulProcessor):
    """Buffer rows until the watermark passes them, then ``fold`` them in (ts_us, event_id) order.

    Subclasses set ``FIELDS`` (input columns; the first two are ``ts_us`` and
    ``event_id``), ``BUF`` / ``STATE`` (DDL of a buffered row / the fold
    state), ``OUT`` (output column names) and implement ``fold``.  Times are
    epoch microseconds; ``fold`` returns timers as microsecond instants it
    must be woken *at or after*.  Watermarks and timers are milliseconds.
    """

    FIELDS: Sequence[str] = ()
    BUF = ""
    STATE = ""
    OUT: Sequence[str] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", self.BUF)
        self.st = handle.getValueState("st", self.STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        new = []
        for pdf in rows:
            for r in pdf[list(self.FIELDS)].itertuples(index=False, name=None):
                r = tuple(_py(v) for v in r)
                if r[0] >= wm:  # older rows are late: dropped, as Spark's own operators do
                    new.append(r)
        if new:
            self.buf.appendList(new)
            self.handle.registerTimer(_after_ms(min(r[0] for r in new)))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        buf = list(self.buf.get()) if self.buf.exists() else []
        ready = sorted((r for r in buf if r[0] < limit), key=lambda r: (r[0], r[1]))
        rest = [r for r in buf if r[0] >= limit]
        state = self.st.get() if self.st.exists() else None
        if not ready and state is None:
            return
        out, state, timers = self.fold(key, state, ready, limit)
        if ready:
            if rest:
                self.buf.put(rest)
            else:
                self.buf.clear()
        if rest:
            self.handle.registerTimer(_after_ms(min(r[0] for r in rest)))
        for t in timers:
            self.handle.registerTimer(_at_ms(t))
        if state is None:
            self.st.clear()
        else:
            self.st.update(state)
        if out:
            yield pd.DataFrame(out, columns=list(self.OUT)).astype(object)

    def fold(self, key, state, rows, limit):  # pragma: no cover - abstract
        raise NotImplementedError

    def close(self) -> None:
        pass


def _replay(df: DataFrame, keys: Sequence[str], processor: _Replay, out_ddl: str) -> DataFrame:
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=out_ddl, outputMode="Append", timeMode="EventTime")


def _us(col: str = "ts"):
    return F.unix_micros(F.col(col).cast("timestamp")).alias("ts_us")


def _from_us(col: str):
    return F.timestamp_micros(F.col(col)).cast("timestamp_ntz")


def _watermarked(df: DataFrame, delay: str | None) -> DataFrame:
    """``delay=None``: the input already carries a watermark on ``ts`` (declare it on the raw
    stream, before filters, so rows a detector ignores still advance event time)."""
    if delay is None:
        return df
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


# ---------------------------------------------------------------- logins
class FailEpisodes(_Replay):
    """A fail opens an episode until first + window; fails join, a success cancels;
    at the deadline the episode is reported when it holds >= ``min_fails``."""

    FIELDS = ("ts_us", "event_id", "fail")
    BUF = "ts_us BIGINT, event_id BIGINT, fail BOOLEAN"
    STATE = "open BOOLEAN, deadline BIGINT, n BIGINT, first BIGINT, last BIGINT"
    OUT = ("user_id", "first_us", "last_us", "fails")

    def __init__(self, window_us: int, min_fails: int):
        self.window_us, self.min_fails = window_us, min_fails

    def fold(self, key, state, rows, limit):
        uid = key[0]
        is_open, deadline, n, first, last = state or (False, 0, 0, 0, 0)
        out = []
        for t, _, fail in rows:
            if is_open and t > deadline:
                if n >= self.min_fails:
                    out.append((uid, first, last, n))
                is_open = False
            if is_open:
                if fail:
                    n, last = n + 1, t
                else:
                    is_open = False
            elif fail:
                is_open, deadline, n, first, last = True, t + self.window_us, 1, t, t
        if is_open and deadline < limit:
            if n >= self.min_fails:
                out.append((uid, first, last, n))
            is_open = False
        if not is_open:
            return out, None, []
        return out, (True, deadline, n, first, last), [deadline + 1]


class FailRuns(_Replay):
    """``n`` consecutive fails whose first and last are < ``within`` apart
    (``<=`` when inclusive); every overlapping run is reported."""

    FIELDS = ("ts_us", "event_id", "fail")
    BUF = "ts_us BIGINT, event_id BIGINT, fail BOOLEAN"
    STATE = "trail ARRAY<BIGINT>"
    OUT = ("user_id", "first_us", "last_us", "fails")

    def __init__(self, n: int, within_us: int, inclusive: bool):
        self.n, self.within_us, self.inclusive = n, within_us, inclusive

    def _ok(self, gap: int) -> bool:
        return gap <= self.within_us if self.inclusive else gap < self.within_us

    def fold(self, key, state, rows, limit):
        uid = key[0]
        trail = list(state[0]) if state else []
        out = []
        for t, _, fail in rows:
            if not fail:
                trail = []
                continue
            trail = (trail + [t])[-self.n:]
            if len(trail) == self.n and self._ok(t - trail[0]):
                out.append((uid, trail[0], t, self.n))
        # keep the last n-1 fails that can still open a run with a future row (ts >= limit)
        trail = [x for x in trail[-(self.n - 1):] if self._ok(limit - x)] if self.n > 1 else []
        return out, ((trail,) if trail else None), []


def _logins(logins: DataFrame, delay: str) -> DataFrame:
    return _watermarked(logins, delay).select(
        "user_id", "ts", _us(), "event_id", F.coalesce(F.col("event_type") == "fail", F.lit(False)).alias("fail"))


_FAIL_OUT = "user_id BIGINT, first_us BIGINT, last_us BIGINT, fails BIGINT"


def _fail_result(df: DataFrame) -> DataFrame:
    return df.select("user_id", _from_us("first_us").alias("first_fail_ts"),
                     _from_us("last_us").alias("last_fail_ts"), "fails")


def login_fail_episodes(logins: DataFrame, window: str = "2 seconds", min_fails: int = 2,
                        delay: str | None = None) -> DataFrame:
    """(user_id, first_fail_ts, last_fail_ts, fails) - streaming ``logins.fail_episodes``."""
    proc = FailEpisodes(duration_us(window), min_fails)
    return _fail_result(_replay(_logins(logins, delay), ["user_id"], proc, _FAIL_OUT))


def login_fail_runs(logins: DataFrame, n: int = 2, within: str = "5 seconds", inclusive: bool = False,
                    delay: str | None = None) -> DataFrame:
    """Streaming ``logins.fail_runs``; ``n=2, inclusive=True`` is ``fail_pairs``."""
    proc = FailRuns(n, duration_us(within), inclusive)
    return _fail_result(_replay(_logins(logins, delay), ["user_id"], proc, _FAIL_OUT))


# ---------------------------------------------------------------- orders
class PaymentTimeout(_Replay):
    """Every create waits for the first pay at or after it: ``payed`` when it comes < timeout later,
    ``pay timeout`` once the watermark passes create + timeout, and ``payed timeout`` for a pay after that;
    an order paid before any create is ``pay_without_create``, once.

    State is kept for late pays: for ever, or ``retention`` past the last deadline (a still later pay is then
    ``pay_without_create``).
    """

    FIELDS = ("ts_us", "event_id", "is_create", "is_pay")
    BUF = "ts_us BIGINT, event_id BIGINT, is_create BOOLEAN, is_pay BOOLEAN"
    STATE = "waiting ARRAY<BIGINT>, overdue ARRAY<BIGINT>, last_create BIGINT, bare BOOLEAN"
    OUT = ("order_id", "create_us", "pay_us", "status")

    def __init__(self, timeout_us: int, retention_us: int | None):
        self.timeout_us, self.retention_us = timeout_us, retention_us

    def fold(self, key, state, rows, limit):
        oid = key[0]
        waiting, overdue, last, bare = state or ([], [], None, False)
        waiting, overdue = list(waiting or []), list(overdue or [])
        out = []
        for t, _, is_create, is_pay in sorted(rows, key=lambda r: (r[0], not r[2], r[1])):
            if is_create:
                waiting.append(t)
                last = t
            elif is_pay and (waiting or overdue):
                for c in overdue + waiting:
                    out.append((oid, c, t, PAYED if t - c < self.timeout_us else PAYED_TIMEOUT))
                waiting, overdue = [], []
            elif is_pay and last is None and not bare:
                out.append((oid, None, t, PAY_WITHOUT_CREATE))
                bare = True
        for c in [c for c in waiting if c + self.timeout_us <= limit]:
            out.append((oid, c, None, PAY_TIMEOUT))
            waiting.remove(c)
            overdue.append(c)
        timers = [c + self.timeout_us for c in waiting]
        if self.retention_us is not None and last is not None:
            end = last + self.timeout_us + self.retention_us
            if end < limit:
                return out, None, []
            timers.append(end + 1)
        if last is None and not bare:
            return out, None, []
        return out, (waiting, overdue, last, bare), timers


def order_payment_events(orders: DataFrame, timeout: str = "15 minutes", retention: str | None = None,
                         delay: str | None = None) -> DataFrame:
    """(order_id, create_ts, pay_ts, status) as they become final; an order that times out and is
    paid later yields ``pay timeout`` and then ``payed timeout``."""
    ev = _watermarked(orders, delay).select(
        "order_id", "ts", _us(), "event_id", F.coalesce(F.col("event_type") == CREATE, F.lit(False)).alias("is_create"),
        F.coalesce(F.col("event_type") == PAY, F.lit(False)).alias("is_pay"))
    proc = PaymentTimeout(duration_us(timeout), None if retention is None else duration_us(retention))
    out = _replay(ev, ["order_id"], proc, "order_id BIGINT, create_us BIGINT, pay_us BIGINT, status STRING")
    return out.select("order_id", _from_us("create_us").alias("create_ts"), _from_us("pay_us").alias("pay_ts"),
                      "status")


# ---------------------------------------------------------------- blacklist
class ClickCounter(_Replay):
    """Number each (user, ad[, day]) click in time order; emit clicks up to ``max_click``
    (the last one is the warning).  With a day key, state is dropped when the business day ends."""

    FIELDS = ("ts_us", "event_id", "province", "city", "day_end_us")
    BUF = "ts_us BIGINT, event_id BIGINT, province STRING, city STRING, day_end_us BIGINT"
    STATE = "clicks BIGINT, day_end_us BIGINT"

    def __init__(self, max_click: int, keys: Sequence[str]):
        self.max_click = max_click
        self.OUT = (*keys, "event_id", "ts_us", "province", "city", "click_no")

    def fold(self, key, state, rows, limit):
        clicks, day_end = state or (0, None)
        out = []
        for t, eid, province, city, d_end in rows:
            clicks += 1
            day_end = d_end
            if clicks <= self.max_click:
                out.append((*key, eid, t, province, city, clicks))
        if day_end is not None and day_end <= limit:
            return out, None, []
        return out, (clicks, day_end), ([day_end] if day_end is not None else [])


def ad_click_numbers(clicks: DataFrame, max_click: int = 100, daily_reset: bool = True,
                     utc_offset_hours: int = 8, delay: str | None = None) -> DataFrame:
    """(user_id, ad_id[, day], event_id, ts, province, city, click_no, kind) for clicks up to
    ``max_click``: kind ``allowed`` below it, ``warning`` at it; later clicks are dropped."""
    off_us = utc_offset_hours * 3_600_000_000
    ev = _watermarked(clicks, delay).withColumn("ts_us", _us())
    keys = ["user_id", "ad_id"]
    if daily_reset:
        day_end = (F.floor((F.col("ts_us") + off_us) / DAY_US) + 1) * DAY_US - off_us
        ev = ev.withColumn("day", business_day(F.col("ts").cast("timestamp_ntz"), utc_offset_hours)).withColumn(
            "day_end_us", day_end.cast("bigint"))
        keys.append("day")
    else:
        ev = ev.withColumn("day_end_us", F.lit(None).cast("bigint"))
    ev = ev.select(*keys, "ts", "ts_us", "event_id", "province", "city", "day_end_us")
    key_ddl = "user_id BIGINT, ad_id BIGINT" + (", day DATE" if daily_reset else "")
    out = _replay(ev, keys, ClickCounter(max_click, keys),
                  f"{key_ddl}, event_id BIGINT, ts_us BIGINT, province STRING, city STRING, click_no BIGINT")
    kind = F.when(F.col("click_no") < max_click, F.lit("allowed")).otherwise(F.lit("warning"))
    return out.select(*keys, "event_id", _from_us("ts_us").alias("ts"), "province", "city",
                      "click_no", kind.alias("kind"))


# ---------------------------------------------------------------- pay / receipt
class PairInOrder(_Replay):
    """J2, one to one: the n-th pay of a tx id with its n-th receipt when they are at most ``tolerance`` apart.

    A row waits in a map state under (n, side) until its partner has come or the watermark has passed its range, its
    time to live; every row is reported once.  A row's partner is one look-up, however many rows of the tx id wait.
    The two counters of a tx id are kept, so that later rows go on numbering.
    """

    # ``what``: a pay's order id as text, a receipt's channel.
    FIELDS = ("ts_us", "event_id", "is_pay", "what")
    BUF = "ts_us BIGINT, event_id BIGINT, is_pay BOOLEAN, what STRING"
    STATE = "pays BIGINT, receipts BIGINT, next_expiry BIGINT"
    OUT = ("tx_id", "order_id", "pay_us", "receipt_us", "pay_channel", "status")

    def __init__(self, tolerance_us: int):
        self.tolerance_us = tolerance_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getMapState("waiting", "n BIGINT, is_pay BOOLEAN", "ts_us BIGINT, what STRING")

    @staticmethod
    def _alone(tx, is_pay, t, what):
        if is_pay:
            return (tx, what, t, None, None, "pay_without_receipt")
        return (tx, None, None, t, what, "receipt_without_pay")

    def fold(self, key, state, rows, limit):
        tx = key[0]
        pays, receipts, expiry = state or (0, 0, None)
        out = []
        for t, _, is_pay, what in rows:
            if is_pay:
                pays += 1
                n, seen = pays, receipts
            else:
                receipts += 1
                n, seen = receipts, pays
            if n > seen:  # its partner has not come
                self.waiting.updateValue((n, is_pay), (t, what))
                expiry = t + self.tolerance_us + 1 if expiry is None else min(expiry, t + self.tolerance_us + 1)
                continue
            other = (n, not is_pay)
            partner = self.waiting.getValue(other) if self.waiting.containsKey(other) else None
            if partner is None:  # reported when its time was over
                out.append(self._alone(tx, is_pay, t, what))
                continue
            self.waiting.removeKey(other)
            if abs(partner[0] - t) <= self.tolerance_us:
                pay, receipt = ((t, what), partner) if is_pay else (partner, (t, what))
                out.append((tx, pay[1], pay[0], receipt[0], receipt[1], "matched"))
            else:
                out += [self._alone(tx, not is_pay, *partner), self._alone(tx, is_pay, t, what)]
        if expiry is not None and expiry <= limit:
            left, over = [], []
            for (n, is_pay), (t, what) in self.waiting.iterator():
                (over if t + self.tolerance_us < limit else left).append(((n, is_pay), t, what))
            for (n, is_pay), t, what in over:
                self.waiting.removeKey((n, is_pay))
                out.append(self._alone(tx, is_pay, t, what))
            expiry = min((t + self.tolerance_us + 1 for _, t, _ in left), default=None)
        return out, (pays, receipts, expiry), [] if expiry is None else [expiry]


def reconcile(pays: DataFrame, receipts: DataFrame, tolerance: str = "5 seconds", delay: str | None = None) -> DataFrame:
    """(tx_id, order_id, pay_ts, receipt_ts, pay_channel, status) - streaming ``payments.reconcile``, one to one.

    Rows of a NULL or empty tx id match nothing: pays are dropped, receipts reported at once, without state.
    """
    named = F.col("tx_id").isNotNull() & (F.col("tx_id") != "")
    p = _watermarked(pays.where(named), delay).select(
        "tx_id", "ts", _us(), "event_id", F.lit(True).alias("is_pay"), F.col("order_id").cast("string").alias("what"))
    receipts = _watermarked(receipts, delay)
    r = receipts.where(named).select(
        "tx_id", "ts", _us(), "event_id", F.lit(False).alias("is_pay"), F.col("pay_channel").alias("what"))
    out = _replay(p.unionByName(r), ["tx_id"], PairInOrder(duration_us(tolerance)),
                  "tx_id STRING, order_id STRING, pay_us BIGINT, receipt_us BIGINT, pay_channel STRING, status STRING")
    out = out.select("tx_id", F.col("order_id").cast("bigint").alias("order_id"), _from_us("pay_us").alias("pay_ts"), _from_us("receipt_us").alias("receipt_ts"),
                     "pay_channel", "status")
    unnamed = receipts.where(~F.coalesce(named, F.lit(False))).select(
        "tx_id", F.lit(None).cast("bigint").alias("order_id"), F.lit(None).cast(dict(out.dtypes)["pay_ts"]).alias("pay_ts"),
        _us().alias("receipt_us"), "pay_channel", F.lit("receipt_without_pay").alias("status"))
    return out.unionByName(unnamed.withColumn("receipt_ts", _from_us("receipt_us")).drop("receipt_us"))
