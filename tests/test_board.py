"""Windows of a stream from panes: early, on time, corrected, closed; restarts, replays, bounded files."""

import os
import random
import tempfile
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import counts
from tidemark.plans.sliding import duration_us
from tidemark.streaming import sinks
from tidemark.streaming import windows as sw
from tidemark.streaming.board import WindowBoard
from tidemark.streaming.sources import event_time, read_parquet_stream
from tidemark.streaming.table import UpsertTable, Version, VersionedTable

S = 1_000_000
DDL = "us long, url string, method string"


def batch_of(spark, rows):
    return (spark.createDataFrame(rows, DDL)
            .select(F.timestamp_micros("us").alias("event_time"), "url", "method"))


def folder(name):
    return tempfile.mkdtemp(prefix=f"tidemark-{name}-", dir="/tmp")


def us(ts):
    return F.unix_micros(F.col(ts).cast("timestamp"))


class Model:
    """The same windows, one dictionary of counts per window, batch by batch."""

    def __init__(self, size, slide, bound, lateness, top_n):
        self.size, self.slide, self.bound, self.lateness, self.top_n = size, slide, bound, lateness, top_n
        self.counts, self.fired, self.closed, self.version = defaultdict(Counter), set(), {}, Counter()
        self.max, self.late, self.log = None, [], []

    def ranked(self, end):
        rows = sorted(((u, c) for u, c in self.counts[end].items()), key=lambda x: (-x[1], x[0]))[: self.top_n]
        return [(end, k + 1, u, c) for k, (u, c) in enumerate(rows)]

    def step(self, rows):
        wm = None if self.max is None else self.max - self.bound
        over = lambda end, wait: wm is not None and end - 1000 + wait <= wm
        touched = set()
        for t, url, method in rows:
            if method != "GET":
                continue
            pane = t // self.slide * self.slide
            if over(pane + self.size, self.lateness):
                self.late.append(t)
                continue
            for end in range(pane + self.slide, pane + self.size + 1, self.slide):
                if not over(end, self.lateness):
                    self.counts[end][url] += 1
                    touched.add(end)
        if rows:
            self.max = max([t for t, _, _ in rows] + ([] if self.max is None else [self.max]))
        wm = None if self.max is None else self.max - self.bound
        for end in sorted(self.counts):
            due = over(end, 0)
            if due and (end not in self.fired or end in touched) and end not in self.closed:
                self.version[end] += 1
                self.log += [(*r, self.version[end], "corrected" if end in self.fired else "on_time") for r in self.ranked(end)]
                self.fired.add(end)
        for end in sorted(self.fired):
            if over(end, self.lateness) and end not in self.closed:
                self.closed[end] = [(*r, self.version[end]) for r in self.ranked(end)]


@pytest.mark.parametrize("seed,size,slide,bound,lateness", [
    (1, "10 minutes", "5 seconds", "1 second", "60 seconds"), (2, "10 seconds", "5 seconds", "3 seconds", "0 seconds"),
    (3, "1 minute", "1 minute", "2 seconds", "30 seconds")])
def test_board_equals_a_plain_fold(spark, seed, size, slide, bound, lateness):
    rng, root = random.Random(seed), folder("board")
    sizes = [duration_us(x) for x in (size, slide, bound, lateness)]
    model = Model(*sizes, top_n=2)
    board = WindowBoard(f"{root}/t", "event_time", ["url"], size, slide, bound, lateness, where=F.col("method") == "GET",
                        top_n=2, late_path=f"{root}/late", log_path=f"{root}/log", compact_every=2)
    now = 1_000_000 * S
    for n in range(5):
        rows = []
        for _ in range(rng.randrange(5, 40)):
            now += rng.randrange(0, 20 * S)
            behind = rng.choice([0, 0, rng.randrange(3 * S), rng.randrange(60 * S), rng.randrange(900 * S)])
            rows.append((now - behind, rng.choice("abc"), rng.choice(["GET", "GET", "POST"])))
        board(batch_of(spark, rows), n)
        model.step(rows)
    closed = sorted(tuple(r) for r in board.closed_windows(spark).select(
        us("window_end"), "rank", "url", "cnt", "version").collect())
    assert closed == sorted(r for rows in model.closed.values() for r in rows)
    still = sorted(tuple(r) for r in board.open_windows(spark).select(us("window_end"), "rank", "url", "cnt", "version").collect())
    assert still == sorted((*r, model.version[e]) for e in model.fired - set(model.closed) for r in model.ranked(e))
    log = sorted(tuple(r) for r in spark.read.parquet(f"{root}/log").select(
        us("window_end"), "rank", "url", "cnt", "version", "state").collect())
    assert log == sorted(model.log)
    late = sorted(r[0] for r in spark.read.parquet(f"{root}/late").select(us("event_time")).collect())
    assert late == sorted(model.late)
    assert any(r[-1] == "corrected" for r in model.log) or seed != 1


def test_late_row_changes_a_ranking_until_the_window_closes(spark):
    root = folder("refire")
    board = WindowBoard(f"{root}/t", "event_time", ["url"], "10 seconds", "5 seconds", "1 second", "60 seconds", top_n=1,
                        late_path=f"{root}/late", early=True)

    def ranking(end):
        rows = board.open_windows(spark).where(us("window_end") == end * S).select("url", "cnt", "version", "state").collect()
        return [tuple(r) for r in rows]

    board(batch_of(spark, [(3 * S, "b", "GET")]), 0)
    assert ranking(5) == [("b", 1, 1, "early")]
    board(batch_of(spark, [(8 * S, "b", "GET")]), 1)
    assert ranking(5) == [("b", 1, 2, "on_time")]
    board(batch_of(spark, [(4 * S, "a", "GET"), (4 * S, "a", "GET"), (50 * S, "c", "GET")]), 2)  # 4 s late
    assert ranking(5) == [("a", 2, 3, "corrected")]
    board(batch_of(spark, [(70 * S, "c", "GET")]), 3)  # window 5 closes at 65 + 1 s
    assert ranking(5) == []
    board(batch_of(spark, [(2 * S, "b", "GET")] * 9), 4)  # over 60 s late for window 5, not for window 10
    closed = board.closed_windows(spark).where(us("window_end") == 5 * S).select("url", "cnt", "version").collect()
    assert [tuple(r) for r in closed] == [("a", 2, 3)]
    assert ranking(10) == [("b", 11, 4, "corrected")]
    board(batch_of(spark, [(90 * S, "c", "GET")]), 5)
    board(batch_of(spark, [(2 * S, "b", "GET")]), 6)  # late for both
    assert spark.read.parquet(f"{root}/late").count() == 1


def test_replayed_batch_and_bounded_files(spark):
    root = folder("replay")
    board = WindowBoard(f"{root}/t", "event_time", ["url"], "10 seconds", "5 seconds", lateness="5 seconds", compact_every=3)
    for n in range(10):
        rows = [((100 + 4 * n + k) * S, "ab"[k % 2], "GET") for k in range(5)]
        board(batch_of(spark, rows), n)
        if n in (4, 7):
            before = sorted(map(str, board.closed_windows(spark).collect())), sorted(map(str, board.open_windows(spark).collect()))
            board(batch_of(spark, rows), n)  # the driver died after the commit
            assert before == (sorted(map(str, board.closed_windows(spark).collect())),
                              sorted(map(str, board.open_windows(spark).collect())))
    want = counts.url_window_counts(batch_of(spark, [((100 + 4 * n + k) * S, "ab"[k % 2], "GET") for n in range(10)
                                                    for k in range(5)]), "10 seconds", "5 seconds")
    got = board.closed_windows(spark).unionByName(board.open_windows(spark).drop("state"))
    last = (100 + 4 * 9 + 4) * S // (5 * S) * 5 * S
    show = lambda df: sorted((r[0], r[1], r[2]) for r in df.select(us("window_end"), "url", "cnt").collect())
    assert show(got) == [r for r in show(want) if r[0] <= last]
    assert got.groupBy("window_end", "url").count().where("count > 1").isEmpty()
    version = board.panes.version(spark)
    assert len(version.parts) <= 4 and board.panes.read(spark, version).count() <= 14
    for table in (board.panes, board.current):
        assert len(os.listdir(f"{table.path}/versions")) <= 6
        assert len(os.listdir(f"{table.path}/parts")) <= 10


def write_files(spark, rows, path, files):
    for k in range(files):
        part = rows[k * len(rows) // files: (k + 1) * len(rows) // files]
        batch_of(spark, part).coalesce(1).write.mode("append").parquet(path)


def test_streams_of_one_hour_by_five_seconds(spark):
    """Rows up to 3 s out of order; both stream forms equal the batch counts; state rows per input row are bounded."""
    rng, root = random.Random(5), folder("hour")
    flush = 10_000_000 * S
    rows = sorted([(rng.randrange(0, 5400 * S), rng.choice(["x", "y", None]), "GET") for _ in range(6000)],
                  key=lambda r: r[0] + rng.randrange(-1_500_000, 1_500_000))
    write_files(spark, rows, f"{root}/in", 3)
    batch_of(spark, [(flush, "flush", "GET")]).coalesce(1).write.mode("append").parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    stream = read_parquet_stream(spark, f"{root}/in", schema, max_files_per_trigger=1)
    want = counts.url_window_counts(batch_of(spark, rows), "1 hour", "5 seconds")
    want = want.select("url", us("window_end").alias("e"), "cnt")

    board = WindowBoard(f"{root}/t", "event_time", ["url"], "1 hour", "5 seconds", bound="3 seconds")
    sinks.run_to_end([sinks.foreach_batch(stream, board, f"board-{os.path.basename(root)}")])
    got = board.closed_windows(spark).select("url", us("window_end").alias("e"), "cnt")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert board.panes.read(spark).groupBy("url", "_pane").count().count() <= len(rows)

    chained = sw.pane_window_counts(event_time(stream, "event_time", "3 seconds"), "event_time", ["url"], "1 hour", "5 seconds")
    q = sinks.to_files(chained, f"{root}/chained", f"chained-{os.path.basename(root)}")
    sinks.run_to_end([q])
    got = spark.read.parquet(f"{root}/chained").where(us("window_end") < flush).select("url", us("window_end").alias("e"), "cnt")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    state = max(sum(op.numRowsTotal for op in p.stateOperators) for p in q.recentProgress)
    assert state <= 2 * len(rows)


def test_versions_are_whole_for_a_reader(spark):
    table = VersionedTable(folder("versions"), keep=2)
    assert table.version(spark) is None and table.read(spark) is None
    first = table.write_part(spark.range(3), 0)
    assert table.version(spark) is None  # not committed yet
    table.commit(spark, Version(0, (first,), {"n": 3}))
    reader = table.read(spark)  # opened before the next commits
    table.commit(spark, Version(1, (first, table.write_part(spark.range(5), 1))))
    assert reader.count() == 3 and table.read(spark).count() == 8
    assert table.version(spark, before=1).meta == {"n": 3}
    table.commit(spark, Version(2, (table.write_part(spark.range(1), 2),)))
    table.commit(spark, Version(3, (table.write_part(spark.range(2), 3),)))
    assert table.version(spark, before=2) is None and table.read(spark).count() == 2
    assert len(os.listdir(f"{table.path}/parts")) == 2
    with pytest.raises(ValueError):
        VersionedTable("x", keep=1)


def test_upserts_keep_sub_second_windows_apart_and_close(spark):
    path = folder("upsert")
    table = UpsertTable(path, ["window_end", "k"], "window_end", retention_us=10 * S, compact_every=2)
    assert table.live(spark) is None and table.closed(spark) is None

    def put(n, rows):
        df = spark.createDataFrame(rows, "us long, k string, cnt long")
        table(df.select(F.timestamp_micros("us").alias("window_end"), "k", "cnt"), n)

    live = lambda: sorted((r[0], str(r[1]), r[2]) for r in table.live(spark).select(us("window_end"), "k", "cnt").collect())
    put(0, [(1_200_000, "a", 1), (1_700_000, "a", 2), (1_700_000, None, 3)])
    put(1, [(1_700_000, None, 4)])
    assert live() == [(1_200_000, "a", 1), (1_700_000, "None", 4), (1_700_000, "a", 2)]
    put(1, [(1_700_000, None, 4)])  # replayed
    assert len(live()) == 3
    put(2, [(30 * S, "a", 5)])
    assert live() == [(30 * S, "a", 5)]
    assert sorted(r.cnt for r in table.closed(spark).collect()) == [1, 2, 4]
    put(2, [(30 * S, "a", 5)])
    assert sorted(r.cnt for r in table.closed(spark).collect()) == [1, 2, 4] and live() == [(30 * S, "a", 5)]
    with pytest.raises(ValueError, match="several rows"):
        put(3, [(30 * S, "a", 5), (30 * S, "a", 6)])
    for n in range(3, 9):
        put(n, [((30 + n) * S, "a", n)])
    assert len(table.table.version(spark).parts) <= 3


def test_rankings_from_an_upsert_table(spark):
    """``latest_top_n`` and ``uv_running_totals`` over a table of few files instead of the whole log."""
    top, uv = UpsertTable(folder("top"), ["window_end", "url"], compact_every=2), UpsertTable(
        folder("uv"), ["window_end", "chunk"], compact_every=2)
    for n in range(6):
        rows = [(60 * S, "a", n), (60 * S, "b", 3), (120 * S, "a", 2 * n)]
        df = spark.createDataFrame(rows, "us long, url string, cnt long").withColumn("window_end", F.timestamp_micros("us")).drop("us")
        top(df, n)
        uv(df.select("window_end", F.hash("url").alias("chunk"), F.col("cnt").alias("n")), n)
    got = sorted((r.rank, r.url, r.cnt) for r in sw.latest_top_n(top.live(spark), "url", 1).collect())
    assert got == [(1, "a", 5), (1, "a", 10)]
    assert sorted(r.uv for r in sw.uv_running_totals(uv.live(spark)).collect()) == [8, 10]
    assert len(top.table.version(spark).parts) <= 3
