"""
one test per ID), each on a few edge rows: nulls, ties, empty input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staffwise.functions import dates as D
from staffwise.functions import flags as FL
from staffwise.functions import text as TX
from staffwise.operators import agg as A
from staffwise.operators import clean as C
from staffwise.operators import joins as J
from staffwise.operators import reshape as R
from staffwise.operators import rules as Q
from staffwise.operators import windows as W

d = dt.date


def rows(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)


def col_values(spark, values, expr, t="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {t}")
    return [r[0] for r in df.select(expr).collect()]


# --- 2.2 projections and cleaning -------------------------------------------

def test_drop_rows_with_nulls_any_and_subset(spark):  # P6
    df = spark.createDataFrame([(1, "a", None), (2, None, 3.0), (3, "c", 4.0), (None, None, None)],
                               "k int, s string, v double")
    assert rows(C.drop_rows_with_nulls(df), "k") == [(3,)]
    assert rows(C.drop_rows_with_nulls(df, ["s"]), "k") == [(1,), (3,)]


def test_tag_constants(spark):  # P15
    df = spark.createDataFrame([(1,), (2,)], "k int")
    out = C.tag(df, source="daily", version=2)
    assert out.columns == ["k", "source", "version"]
    assert rows(out, "k", "source", "version") == [(1, "daily", 2), (2, "daily", 2)]


def test_presence_equality_and_int_flags(spark):  # P21 P26 P27 P30
    df = spark.createDataFrame([("a", "a", True), ("a", "b", False), (None, "b", None), ("-", None, True)],
                               "x string, y string, b boolean")
    got = df.select(FL.is_present("x").alias("p"), FL.equal_flag("x", "y").alias("e"),
                    FL.bool_to_int("b").alias("i"), FL.sentinel_to_null("x", "-").alias("s")).collect()
    assert [tuple(r) for r in got] == [(True, True, 1, "a"), (True, False, 0, "a"),
                                       (False, None, None, None), (True, None, 1, None)]


def test_scale_and_map_values(spark):  # P29 P32
    assert col_values(spark, [50.0, None, -5.0], FL.scale("x", 0.01), "double") == [0.5, None, -0.05]
    mapping = {"M": "Male", "F": "Female"}
    got = col_values(spark, ["M", "f", None, "X"], FL.map_values("x", mapping))
    assert got == ["Male", None, None, None]
    got = col_values(spark, ["m", " F "], FL.map_values("x", mapping, key_transform=lambda c: F.upper(F.trim(c))))
    assert got == ["Male", "Female"]


# --- 2.3 filters --------------------------------------------------------------

def test_current_snapshot_global_latest(spark):  # F6
    df = spark.createDataFrame([(1, d(2024, 1, 31)), (2, d(2024, 2, 29)), (3, d(2024, 2, 29)), (4, None)],
                               "k int, dt date")
    assert rows(W.current_snapshot(df, "dt"), "k") == [(2,), (3,)]


def test_duplicates_only_null_keys_count_as_equal(spark):  # F8
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "b"), (5, "b")], "r int, k string")
    assert rows(W.duplicates_only(df, ["k"]), "r") == [(1,), (2,), (4,), (5,)]


def test_filter_predicates(spark):  # F1-F5, F7
    df = spark.createDataFrame([(1, "ACTIVE", 5.0, "x@corp"), (2, "left", None, None), (3, "ACTIVE", 0.0, "y@ext"),
                                (4, None, 9.0, "z@corp")], "k int, status string, v double, mail string")
    got = df.filter((F.col("status") == "ACTIVE") & F.col("v").isNotNull() & (F.col("v") > 0)
                    | F.col("mail").endswith("@corp") & F.col("status").isNull())
    assert rows(got, "k") == [(1,), (4,)]
    assert rows(df.filter(~F.col("status").isin("left") | F.col("status").isNull()), "k") == [(1,), (3,), (4,)]


# --- 2.4 joins ----------------------------------------------------------------

def test_first_snapshot_rows_ties_kept(spark):  # J7
    df = spark.createDataFrame([(1, d(2024, 1, 31), "a"), (1, d(2024, 1, 31), "b"), (1, d(2024, 2, 29), "c"),
                                (2, d(2024, 2, 29), "d"), (3, None, "e")], "k int, dt date, v string")
    assert rows(J.first_snapshot_rows(df, "k", "dt"), "v") == [("a",), ("b",), ("d",)]


def test_two_key_left_join_and_fanout(spark):  # J8 J9
    left = spark.createDataFrame([(1, "x", 10), (1, "y", 20), (2, "x", 30)], "a int, b string, v int")
    right = spark.createDataFrame([(1, "x", "r1"), (1, "x", "r2"), (2, "z", "r3")], "a int, b string, w string")
    j = left.join(right, ["a", "b"], "left")
    assert rows(j, "v", "w") == [(10, "r1"), (10, "r2"), (20, None), (30, None)]


# --- 2.5 aggregates -------------------------------------------------------------

def test_distinct_counts_overall_and_grouped(spark):  # A2 A3
    df = spark.createDataFrame([("a", 1, "p"), ("a", 1, "q"), ("b", None, "p"), ("b", 2, None)], "g string, x int, y string")
    assert rows(A.distinct_counts(df), "n_g", "n_x", "n_y") == [(2, 2, 2)]
    assert rows(A.distinct_counts(df, by=["g"]), "g", "n_x", "n_y") == [("a", 1, 2), ("b", 1, 1)]


def test_grouped_sum_mean_min_max_count(spark):  # A4-A7 A11
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, 5.0)], "g string, v double")
    out = df.groupBy("g").agg(F.sum("v").alias("s"), F.avg("v").alias("m"), F.min("v").alias("lo"),
                              F.max("v").alias("hi"), F.count("v").alias("n"), F.count(F.lit(1)).alias("rows"))
    assert rows(out, "g", "s", "m", "lo", "hi", "n", "rows") == sorted(
        [("a", 4.0, 2.0, 1.0, 3.0, 2, 3), ("b", None, None, None, None, 0, 1), (None, 5.0, 5.0, 5.0, 5.0, 1, 1)], key=repr)


def test_value_counts_order_and_nulls(spark):  # A8
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), (None,), (None,), ("c",), ("a",)], "x string")
    assert [tuple(r) for r in A.value_counts(df, "x").collect()] == [("a", 2), ("b", 2), ("c", 1)]


# --- 2.7 / 2.8 sorts, samples and sets ----------------------------------------

def test_top_n_and_sample(spark):  # L1 L2 L3
    df = spark.range(0, 1000).withColumn("v", (F.col("id") * 7) % 101)
    top = df.orderBy(F.col("v").desc(), F.col("id")).limit(3).collect()
    assert [(r["v"], r["id"]) for r in top] == [(100, 72), (100, 173), (100, 274)]  # 7 * id = 100 (mod 101) <=> id = 72 (mod 101)
    s = df.sample(fraction=0.2, seed=3)
    n = s.count()
    assert 100 < n < 300 and s.count() == n  # seeded: same rows again
    assert A.sample_n(df, 50).count() == A.sample_n(df, 50).select("id").distinct().count() == 50
    assert A.sample_n(df, 5000).count() == 1000
    near = A.distinct_counts(df, ["id", "v"], approx=True).first()
    assert abs(near["n_id"] - 1000) < 80 and abs(near["n_v"] - 101) < 10


def test_union_distinct_and_distinct(spark):  # U2 U3
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "v string, k int")
    assert rows(R.union_distinct(a, b), "k", "v") == [(1, "x"), (2, None), (3, "y")]
    assert rows(a.distinct(), "k", "v") == [(1, "x"), (2, None)]


# --- 2.10 scalar functions ------------------------------------------------------

def test_parse_timestamp_formats(spark):  # D2
    got = col_values(spark, ["31/01/2024 13:45", "2024-02-01 08:00", "bad", None],
                     D.parse_timestamp("x", ["dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm"]))
    assert got == [dt.datetime(2024, 1, 31, 13, 45), dt.datetime(2024, 2, 1, 8, 0), None, None]


def test_date_parts_month_start_and_day_diff(spark):  # D7 D13 D15
    df = spark.createDataFrame([(d(2024, 2, 29), d(2024, 1, 1)), (None, d(2024, 1, 1)), (d(2023, 12, 1), d(2024, 1, 1))],
                               "e date, s date")
    got = df.select(D.month_of("e"), D.year_of("e"), D.month_start("e"), D.day_diff("e", "s")).collect()
    assert [tuple(r) for r in got] == [(2, 2024, d(2024, 2, 1), 59), (None, None, None, None),
                                       (12, 2023, d(2023, 12, 1), -31)]


def test_utc_now_is_session_zone_independent(spark):  # D14
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        a = spark.range(1).select(D.utc_now()).first()[0]
        spark.conf.set("spark.sql.session.timeZone", "Asia/Singapore")
        b = spark.range(1).select(D.utc_now()).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert abs((b - a).total_seconds()) < 60


def test_text_parts_upper_and_append(spark):  # T1 T5 T8
    df = spark.createDataFrame([(" ab-cd ", "a.b.c"), (None, "a"), ("x", None)], "s string, p string")
    got = df.select(TX.clean_upper("s").alias("u"), TX.first_part("p", "."), *TX.split_to_columns("p", ".", ["p1", "p2", "p3", "p4"]),
                    TX.append_text(F.col("s"), F.col("p")).alias("cat")).collect()
    assert [tuple(r) for r in got] == [("AB-CD", "a", "a", "b", "c", None, " ab-cd a.b.c"),
                                       (None, "a", "a", None, None, None, "a"),
                                       ("X", None, None, None, None, None, "x")]


# --- 2.12 rules ------------------------------------------------------------------

def test_validation_table_one_pass(spark):  # Q4
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "c")], "k int, v string")
    checks = {"rows": F.count(F.lit(1)), "null_v": F.sum(F.col("v").isNull().cast("int")),
              "dup_k": F.count(F.lit(1)) - F.count_distinct("k")}
    assert [tuple(r) for r in Q.validation_table(df, checks).collect()] == [("rows", 3.0), ("null_v", 1.0), ("dup_k", 1.0)]
    empty = df.filter("k > 10")
    assert [tuple(r) for r in Q.validation_table(empty, {"rows": F.count(F.lit(1))}).collect()] == [("rows", 0.0)]


@pytest.mark.parametrize("how,expected", [("all", ["k", "some"]), ("any", ["k"])])
def test_drop_null_columns_on_empty_and_sparse(spark, how, expected):  # P4 P5
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "k int, none_ string, some string")
    assert C.drop_null_columns(df, how=how).columns == expected


def test_bounded_broadcast_checks_rows_and_bytes(spark):  # J1 broadcast="checked"
    small = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    wide = spark.createDataFrame([(1, "x" * 5000), (2, "y" * 5000)], "k int, v string")
    assert J.bounded_broadcast(small) is not small  # hinted
    assert J.bounded_broadcast(small, max_rows=1) is small  # too many rows: left to the planner
    assert J.bounded_broadcast(wide, max_bytes=8000) is wide  # two rows, but ~10 kB
    assert J.bounded_broadcast(wide, max_bytes=20000) is not wide
    out = J.lookup(spark.createDataFrame([(1,), (3,)], "k int"), small, "k", broadcast="checked")
    assert rows(out, "k", "v") == [(1, "a"), (3, None)]
