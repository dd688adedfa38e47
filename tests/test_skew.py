from pyspark.sql import functions as F
"""A key holding a third of all rows: results must stay exact."""

import numpy as np
import pandas as pd
import pytest

from staffwise.operators import agg as A
from staffwise.operators import windows as W
from staffwise.operators.ordering import By


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(11)
    n = 3000
    key = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 200, n))
    val = rng.normal(100, 30, n).round(2)
    val[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"k": key.astype("int64"), "v": val, "row": np.arange(n, dtype="int64")})
    sdf = spark.createDataFrame(pdf.astype({"v": object}).where(pdf.notna(), None), "k long, v double, row long")
    return pdf, sdf


def test_quantiles_hot_group_spread_over_segments(skewed):
    pdf, sdf = skewed
    got = {r["k"]: r for r in A.exact_quantiles(sdf, "v", [0.0, 0.1, 0.5, 0.9, 1.0], ["k"], partitions=8).collect()}
    for k in (0, 1, 2):
        vals = pdf.loc[pdf.k == k, "v"].dropna().to_numpy()
        expect = np.percentile(vals, [0, 10, 50, 90, 100])
        assert got[k]["n"] == len(vals)
        assert np.allclose([got[k][f"q{i}"] for i in range(5)], expect, rtol=0, atol=1e-9)
    whole = A.exact_quantiles(sdf, "v", [0.25, 0.75], partitions=8).first()
    assert np.allclose([whole["q0"], whole["q1"]], np.percentile(pdf.v.dropna(), [25, 75]))


def test_dedupe_and_backfill_hot_key(skewed):
    pdf, sdf = skewed
    last = {r["k"]: r["row"] for r in W.dedupe(sdf, ["k"], [By("v"), By("row")], keep="last").collect()}
    expect = pdf.sort_values(["v", "row"], na_position="last", kind="mergesort").drop_duplicates("k", keep="last")
    assert last == dict(zip(expect.k, expect.row))
    back = W.latest_attribute(sdf, "k", "v", [By("row")], out="v_last")
    hot = back.filter("k = 0").select("v_last").distinct().collect()
    assert len(hot) == 1 and hot[0][0] == pdf.loc[(pdf.k == 0) & pdf.v.notna(), "v"].iloc[-1]


def test_headcount_hot_group(skewed):
    pdf, sdf = skewed
    got = {r["k"]: r["headcount"] for r in A.headcount(sdf, "row", ["k"]).collect()}
    assert got[0] == 1000 and sum(got.values()) == len(pdf)


def test_snapshot_diff_hot_key_is_not_paired(spark):
    import datetime as dt

    from staffwise.operators.diff import snapshot_diff

    m1, m2 = dt.date(2024, 1, 31), dt.date(2024, 2, 29)
    hot = [(0, m1, f"a{i}", i % 3) for i in range(300)] + [(0, m2, f"a{i + 150}", i % 3) for i in range(300)]
    cold = [(k, m, "x", 1) for k in range(1, 50) for m in (m1, m2)]
    df = spark.createDataFrame(hot + cold, "k int, eom date, f string, g int")
    out = snapshot_diff(df, "k", "eom", ["f", "g"])
    # all-pairs would be 90,000 rows per field; per-field value counts are linear
    assert out.count() == 300  # f: 150 removed + 150 added values; g: each value 100 old, 100 new
    assert {r["change"] for r in out.collect()} == {"value_added", "value_removed"}
    assert out.filter("k != 0").count() == 0  # unchanged single-row keys give nothing


@pytest.mark.parametrize("max_window_rows", [100, 100_000])  # prefix-count path / bounded window path
def test_day_runs_hot_key_day_positions(spark, max_window_rows):
    import datetime as dt

    day = dt.date(2024, 3, 1)
    hot = [("hot", day, f"r{i:05d}") for i in range(3000)] + [("hot", day, "r00007")] * 5  # copies too
    rest = [("hot", dt.date(2024, 2, 29), "prev")] + [(f"k{i}", day, "x") for i in range(50)]
    df = spark.createDataFrame(hot + rest, "k string, d date, note string")
    out = W.day_runs(df, "k", "d", max_window_rows=max_window_rows).filter("k = 'hot' AND d = DATE'2024-03-01'")
    streaks = sorted(r["streak"] for r in out.collect())
    full = sorted(map(tuple, W.day_runs(df, "k", "d", max_window_rows=max_window_rows).collect()), key=repr)
    other = W.day_runs(df, "k", "d", max_window_rows=100 if max_window_rows > 100 else 100_000)
    assert full == sorted(map(tuple, other.collect()), key=repr)  # both ways give the same rows on all columns
    # the previous day starts the run (streak 0); the 3005 rows of the hot day follow it
    assert streaks == list(range(1, 3006))
    assert out.filter("gap_days = 1").count() == 1 and out.filter("gap_days = 0").count() == 3004


def test_join_back_of_a_hot_key_is_split(spark):
    """With a third of the rows on one key and broadcasts off, adaptive
    execution splits the join back of the per-key choices."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = (spark.range(0, 150_000, 1, 12).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000))
              .withColumn("v", F.xxhash64("id")).withColumn("pad", F.sha2(F.col("id").cast("string"), 256)))
        out = W.equals_group_max(df, "k", "v", "top")
        assert out.filter("top").count() >= 4000
        out.write.format("noop").mode("overwrite").save()
        rows = out.select("k", "pad", "top")
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
