"""Order statuses of a stream equal the batch operator's; the stream plan has no Python."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import orders as batch
from tidemark.streaming import orders, sinks
from tidemark.streaming.sources import event_time, read_parquet_stream

S = 1_000_000
FLUSH = -1


@pytest.fixture(scope="module")
def env(spark):
    """Orders with several creates and pays, unknown events, no creates, NULL kinds; files up to 3 s out of order."""
    rng, rows = random.Random(11), []
    for order in range(300):
        t = rng.randrange(0, 3 * 3600 * S)
        for _ in range(rng.randrange(1, 5)):
            rows.append((len(rows), order if order else None, rng.choice(["create", "create", "pay", "pay", "modify", None]), t))
            t += rng.randrange(0, 1500 * S)
    rows.sort(key=lambda r: r[3] + rng.randrange(-1_500_000, 1_500_000))
    root = tempfile.mkdtemp(prefix="tidemark-orders-", dir="/tmp")
    frame = lambda part: spark.createDataFrame(part, "event_id long, order_id long, event_type string, us long").select(
        "event_id", "order_id", "event_type", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"))
    for k in range(4):
        frame(rows[k * len(rows) // 4: (k + 1) * len(rows) // 4]).coalesce(1).write.mode("append").parquet(f"{root}/in")
    for day in (10, 20, 30):
        kinds = ["create", "pay", "modify"]
        frame([(10**6 + day + i, FLUSH, kinds[i], day * 86400 * S) for i in range(3)]).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = event_time(read_parquet_stream(spark, f"{root}/in", frame(rows).schema, max_files_per_trigger=1), "ts", "3 seconds")
    return {"root": root, "stream": stream, "batch": frame(rows), "spark": spark}


def run(env, df, name):
    path = os.path.join(env["root"], name)
    sinks.run_to_end([sinks.to_files(df, path, f"{name}-{os.path.basename(env['root'])}")])
    rows = env["spark"].read.parquet(path).where(~F.col("order_id").eqNullSafe(FLUSH))
    return sorted((tuple(map(str, r)) for r in rows.collect()))


def shown(df):
    return sorted(tuple(map(str, r)) for r in df.select(
        "order_id", *[F.col(c).cast("timestamp").alias(c) for c in ("create_ts", "pay_ts")], "status").collect())


def test_final_statuses_equal_the_batch_form(env):
    got = run(env, orders.payment_status(env["stream"], "5 minutes", "2 hours"), "final")
    want = shown(batch.payment_status(env["batch"], "5 minutes"))
    assert got == want
    assert {r[3] for r in want} == {"payed", "pay timeout", "payed timeout", "pay_without_create", "other_event"}


def test_alerts_equal_pairs_in_range(env):
    got = run(env, orders.payment_alerts(env["stream"], "5 minutes", "2 hours"), "alerts")
    named = env["batch"]
    c = named.where("event_type = 'create'").select("order_id", F.col("ts").alias("create_ts"))
    p = named.where("event_type = 'pay'").select("order_id", F.col("ts").alias("pay_ts"))
    gap = (F.unix_micros(F.col("pay_ts").cast("timestamp")) - F.unix_micros(F.col("create_ts").cast("timestamp"))) / S
    near = c.join(p, "order_id").withColumn("gap", gap).where("gap >= 0 AND gap < 300").withColumn("status", F.lit("payed"))
    late = c.join(p, "order_id").withColumn("gap", gap).where("gap >= 300 AND gap < 7500").withColumn("status", F.lit("payed timeout"))
    with_id = lambda x: x.withColumn("o", F.coalesce("order_id", F.lit(-9)))
    never = with_id(c).join(with_id(near).select("o", "create_ts").distinct(), ["o", "create_ts"], "left_anti").select(
        "order_id", "create_ts", F.lit(None).cast("timestamp_ntz").alias("pay_ts"), F.lit("pay timeout").alias("status"))
    want = shown(near.drop("gap").unionByName(late.drop("gap")).unionByName(never))
    assert got == want


def test_plans_have_no_python(env):
    for df in (orders.payment_status(env["stream"]), orders.payment_alerts(env["stream"])):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    with pytest.raises(ValueError):
        orders.payment_status(env["stream"], "2 hours", "1 hour")
