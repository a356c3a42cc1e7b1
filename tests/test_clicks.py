"""The click blacklist of a stream in batches equals the batch operator; windows by arrival time."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import blacklist
from tidemark.streaming import sinks
from tidemark.streaming.board import WindowBoard
from tidemark.streaming.clicks import ClickBoard

S = 1_000_000


def folder(name):
    return tempfile.mkdtemp(prefix=f"tidemark-{name}-", dir="/tmp")


def frame(spark, rows):
    return spark.createDataFrame(rows, "event_id long, user_id long, ad_id long, us long").select(
        "event_id", "user_id", "ad_id", F.lit("p").alias("province"), F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"))


@pytest.mark.parametrize("daily", [True, False])
def test_hot_key_and_out_of_order_rows(spark, daily):
    rng, root, n = random.Random(6), folder("clicks"), 5
    rows = []
    for i in range(900):  # one (user, ad) holds a third of the clicks; three days
        hot = i % 3 == 0
        rows.append((i, 1 if hot else rng.choice([None, *range(2, 30)]), 1 if hot else rng.randrange(3), i * 288 * S + rng.randrange(5) * S))
    rows.sort(key=lambda r: r[3] + rng.randrange(-1_500_000, 1_500_000))
    board = ClickBoard(f"{root}/state", f"{root}/out", n, daily, delay="3 seconds", compact_every=2)
    last = (10**6, -1, -1, 10**6 * S)
    for k in range(5):
        part = rows[k * 180:(k + 1) * 180] + ([last] if k == 4 else [])
        board(frame(spark, part), k)
        if k in (1, 4):
            board(frame(spark, part), k)  # replayed
    out = spark.read.parquet(f"{root}/out").where("user_id IS NULL OR user_id >= 0")
    batch = frame(spark, rows)
    warn = blacklist.blacklist_warnings(batch, n, daily).select("event_id")
    allowed = blacklist.allowed_clicks(batch, n, daily).select("event_id")
    for kind, want in (("warning", warn), ("allowed", allowed)):
        got = out.where(F.col("kind") == kind).select("event_id")
        assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())
    numbers = {r.event_id: r.click_no for r in out.collect()}
    assert set(numbers.values()) == set(range(1, n + 1))
    version = board.counts.version(spark)
    assert len(version.parts) <= 3 and board.counts.read(spark, version).agg(F.max("clicks")).first()[0] == (None if daily else n)  # days that are over are gone


def test_first_batches_without_rows(spark):
    root = folder("none")
    board = ClickBoard(f"{root}/state", f"{root}/out", 2)
    board(frame(spark, []), 0)
    board(frame(spark, [(1, 1, 1, 5 * S), (2, 1, 1, 6 * S)]), 1)
    board(frame(spark, []), 2)
    assert [r.event_id for r in spark.read.parquet(f"{root}/out").collect()] == [1]


def test_windows_by_arrival_time(spark):
    """A8 in processing time: a manual clock; rows count where their batch arrived, and a replayed batch keeps its time."""
    root, ticks = folder("arrival"), iter([100.0, 103.0, 111.0, 50.0, 131.0])
    board = WindowBoard(f"{root}/t", "arrival", ["channel"], "10 seconds", "5 seconds")
    write = sinks.at_arrival(board, f"{root}/clock", clock=lambda: next(ticks))
    batch = lambda *c: spark.createDataFrame([(x,) for x in c], "channel string")
    write(batch("a", "a"), 0)
    write(batch("b"), 1)
    write(batch("a"), 2)
    write(batch("a"), 2)  # replayed: takes no tick
    write(batch("b"), 3)  # the clock went back: 111 once more
    write(batch("end"), 4)
    got = sorted((r.channel, r.e, r.cnt) for r in board.closed_windows(spark).select(
        "channel", (F.unix_micros(F.col("window_end").cast("timestamp")) / S).cast("int").alias("e"), "cnt").collect())
    assert got == [("a", 105, 2), ("a", 110, 2), ("a", 115, 1), ("a", 120, 1), ("b", 105, 1), ("b", 110, 1), ("b", 115, 1), ("b", 120, 1)]


def test_arrival_time_of_a_running_stream(spark):
    root = folder("running")
    spark.createDataFrame([("a",), ("b",)], "channel string").coalesce(1).write.parquet(f"{root}/in")
    seen = []
    write = sinks.at_arrival(lambda df, n: seen.extend(df.collect()), f"{root}/clock")
    stream = spark.readStream.schema("channel string").parquet(f"{root}/in")
    sinks.run_to_end([sinks.foreach_batch(stream, write, f"arrival-{os.path.basename(root)}")])
    assert sorted(r.channel for r in seen) == ["a", "b"] and len({r.arrival for r in seen}) == 1
