import datetime as dt

from pyspark.sql import functions as F

from staffwise.functions import dates as D
from staffwise.streaming.file_drops import ingest_file_drops


def test_file_drops_processed_once(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    import os

    os.makedirs(src)
    for i, day in enumerate(["31/01/2024", "29/02/2024"]):
        with open(f"{src}/d{i}.csv", "w") as fh:
            fh.write(f"persno,todays_date\n{i},{day}\n{i + 10},{day}\n")

    def transform(df):
        return df.withColumn("todays_date", D.parse_date("todays_date")).withColumn("eom", D.end_of_month("todays_date"))

    sink = f"{tmp_dir}/out"
    q = ingest_file_drops(spark, src, "persno string, todays_date string", sink, f"{tmp_dir}/progress", transform,
                          options={"header": "true"}, partition_by=["eom"])
    q.awaitTermination()
    assert spark.read.parquet(sink).count() == 4
    with open(f"{src}/d2.csv", "w") as fh:
        fh.write("persno,todays_date\n7,31/03/2024\n")
    q = ingest_file_drops(spark, src, "persno string, todays_date string", sink, f"{tmp_dir}/progress", transform,
                          options={"header": "true"}, partition_by=["eom"])
    q.awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == 5
    assert out.filter(F.col("eom") == dt.date(2024, 3, 31)).count() == 1


RUN = """
import sys
sys.path.insert(0, sys.argv[1])
from staffwise.session import local_session
from staffwise.streaming.file_drops import ingest_file_drops
spark, top = local_session("2"), sys.argv[2]
ingest_file_drops(spark, top + "/in", "k string, v int", top + "/out", top + "/progress", options={"header": "true"}).awaitTermination()
"""


def test_file_drops_over_two_applications(spark, tmp_dir):
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.makedirs(f"{tmp_dir}/in")
    for i in range(2):
        with open(f"{tmp_dir}/in/f{i}.csv", "w") as fh:
            fh.write(f"k,v\na{i},{i}\n")
        if i:  # the first file has been archived meanwhile
            os.rename(f"{tmp_dir}/in/f0.csv", f"{tmp_dir}/f0.csv")
        subprocess.run([sys.executable, "-c", RUN, repo, tmp_dir], check=True, capture_output=True, timeout=200)
    out = spark.read.parquet(f"{tmp_dir}/out").collect()
    assert sorted((r["k"], r["v"], r["batch_id"]) for r in out) == [("a0", 0, 0), ("a1", 1, 1)]


def test_replayed_batch_does_not_duplicate(spark, tmp_dir):
    from staffwise.streaming.file_drops import write_epoch

    batch = spark.createDataFrame([("1", dt.date(2024, 1, 31)), ("2", dt.date(2024, 1, 31))], "persno string, eom date")
    sink = f"{tmp_dir}/sink"
    write_epoch(batch, 0, sink, ["eom"])
    write_epoch(batch, 0, sink, ["eom"])  # the same batch run again after a failure
    write_epoch(batch.filter(F.col("persno") == "1"), 1, sink, ["eom"])
    out = spark.read.parquet(sink)
    assert sorted((r["batch_id"], r["persno"]) for r in out.collect()) == [(0, "1"), (0, "2"), (1, "1")]


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["eom", "r_name", "src", "headcount", "joiners", "avg_tenure"]
    assert df.count() > 0
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    from staffwise.plans.driver_queries import QUERIES

    assert set(QUERIES) - set(o) == {"classify_compare", "kmeans_pick", "attrition_importances", "attrition_clusters"}


def test_results_stable_across_partition_counts(spark):
    import __spark_entry__ as e

    sf = "/root/testdata/sf0.001"
    names = ["snapshot_diff", "dedupe_last", "gaps_islands", "layer_depth"]
    first = {n: sorted(map(tuple, e.queries()[n](spark, sf).collect()), key=repr) for n in names}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for n in names:
            assert sorted(map(tuple, e.queries()[n](spark, sf).collect()), key=repr) == first[n]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
