"""Sketch estimates against exact distinct counts."""

import pytest
from pyspark.sql import functions as F

from tidemark import catalog
from tidemark.operators import uniques
from tidemark.sources import adapters as ad

SF = "/root/testdata/sf0.01"


def test_hourly_estimates_are_near_the_exact_counts(spark):
    exact = {r.window_end: r.uv for r in catalog.QUERIES["uv_hourly"](spark, SF).collect()}
    got = {r.window_end: r.uv for r in catalog.QUERIES["uv_sketch_hourly"](spark, SF).collect()}
    assert got.keys() == exact.keys()
    assert all(abs(got[k] - exact[k]) <= 1 + 0.05 * exact[k] for k in exact)  # about three standard errors


def test_days_united_from_hours(spark):
    behavior = ad.user_behavior(ad.events(spark, SF))
    w = F.window("ts", "1 day", "1 hour")
    exact = {r.e: r.uv for r in behavior.groupBy(w.alias("w")).agg(F.count_distinct("user_id").alias("uv")).select(
        F.col("w.end").alias("e"), "uv").collect()}
    got = {r.window_end: r.uv for r in catalog.QUERIES["uv_sketch_daily"](spark, SF).collect()}
    assert got.keys() == exact.keys() and max(exact.values()) > 100
    assert all(abs(got[k] - exact[k]) <= 1 + 0.05 * exact[k] for k in exact)


def test_sketches_merge_and_keep_their_size(spark):
    users = spark.range(200_000).select(F.col("id").alias("user_id"), F.lit("pv").alias("behavior"),
                                        F.timestamp_seconds(F.col("id") % 7200).cast("timestamp_ntz").alias("ts"))
    sketches = uniques.uv_sketches(users)
    assert sketches.count() == 2 and max(len(r.sketch) for r in sketches.collect()) < 8192
    both = uniques.uv_from_sketches(sketches, "2 hours").first().uv
    assert abs(both - 200_000) <= 0.05 * 200_000
    nulls = users.limit(5).withColumn("user_id", F.lit(None).cast("long"))
    assert [r.uv for r in uniques.uv_from_sketches(uniques.uv_sketches(nulls), "1 hour").collect()] == [0]
    with pytest.raises(ValueError):
        uniques.uv_from_sketches(sketches, "90 minutes")
