"""Rows up to a few seconds out of order, with the reference's 1-3 s bounds; streams equal the batch operators."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import logins, payments, uniques
from tidemark.streaming import replay, sinks
from tidemark.streaming import windows as sw
from tidemark.streaming.sources import event_time, read_parquet_stream

S = 1_000_000
DDL = "event_id long, user_id long, event_type string, us long"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL).select(
        "event_id", "user_id", "event_type", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"))


@pytest.fixture(scope="module")
def env(spark):
    """Rows sorted by time plus up to 2 s, so neighbours are swapped within and across the files."""
    rng, root = random.Random(21), tempfile.mkdtemp(prefix="tidemark-order-", dir="/tmp")
    rows = [(i, rng.randrange(6), rng.choice(["fail", "fail", "success"]), rng.randrange(900 * 2) * S // 2) for i in range(700)]
    rows.sort(key=lambda r: r[3] + rng.randrange(2 * S))
    assert any(a[3] > b[3] for a, b in zip(rows, rows[1:]))
    for k in range(4):
        frame(spark, rows[k * 175:(k + 1) * 175]).coalesce(1).write.mode("append").parquet(f"{root}/in")
    for day in (1, 2, 3):
        flush = [(10**6 + 2 * day + k, -1, "success", day * 86_400 * S) for k in range(2)]
        frame(spark, flush).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = read_parquet_stream(spark, f"{root}/in", frame(spark, rows).schema, max_files_per_trigger=1)
    return {"root": root, "stream": stream, "batch": frame(spark, rows), "spark": spark}


def run(env, df, name):
    path = os.path.join(env["root"], name)
    sinks.run_to_end([sinks.to_files(df, path, f"{name}-{os.path.basename(env['root'])}")])
    return env["spark"].read.parquet(path)


def same(a, b):
    cols = b.columns
    text = lambda df: sorted(str(tuple(r)) for r in df.select(*[F.col(c).cast("string") for c in cols]).collect())
    assert text(a) == text(b) and b.count() > 10


def test_login_patterns_with_two_and_three_second_bounds(env):
    real = F.col("user_id") >= 0
    same(run(env, replay.login_fail_episodes(env["stream"], "2 seconds", 2, delay="2 seconds"), "episodes").where(real),
         logins.fail_episodes(env["batch"], "2 seconds", 2))
    same(run(env, replay.login_fail_runs(env["stream"], 2, "5 seconds", delay="3 seconds"), "runs").where(real),
         logins.fail_runs(env["batch"], 2, "5 seconds"))


def test_distinct_users_with_a_two_second_bound(env):
    stream = event_time(env["stream"].withColumn("behavior", F.lit("pv")), "ts", "2 seconds")
    got = run(env, sw.uv_counts(stream, "10 seconds"), "uv").withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    same(got.where("window_end < '1970-01-01 12:00:00'"), uniques.uv_exact(env["batch"], "10 seconds"))


def test_reconcile_with_a_two_second_bound(env):
    def sides(df):
        tx = F.concat(F.lit("t"), F.floor(F.col("event_id") / 4).cast("string"))
        pays = df.where("event_id % 2 = 0").select("event_id", tx.alias("tx_id"), F.col("event_id").alias("order_id"), "ts")
        return pays, df.where("event_id % 2 = 1").select("event_id", tx.alias("tx_id"), F.lit("c").alias("pay_channel"), "ts")

    got = run(env, replay.reconcile(*sides(env["stream"]), "5 minutes", delay="2 seconds"), "reconcile")
    real = F.coalesce("pay_ts", "receipt_ts") < F.lit("1970-01-01 12:00:00").cast("timestamp_ntz")
    same(got.where(real), payments.reconcile(*sides(env["batch"]), "5 minutes"))
